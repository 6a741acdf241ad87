"""Connected components by alternating large-star and small-star steps.

Each step is a partial aggregate and a join; a hub's neighbours are never
gathered.  The edges between steps are written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def _least(pairs: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): m the smallest of u and its neighbours."""
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    low = common.rekeyed(low, ["u"], "k_").select("k_u", "m")
    return common.rekeyed(pairs, ["u"], "k_").join(low, "k_u").drop("k_u")


def _two(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """Several (u, v) edges out of each row, in one pass over ``df``."""
    made = F.array(*[F.struct(F.col(a).alias("u"), F.col(b).alias("v")) for a, b in pairs])
    return df.select(F.explode(made).alias("e")).select("e.u", "e.v")


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0])


def components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of longs -> (node, label): the smallest node of each
    node's component.  Nodes without edges are not listed."""
    edges = edges.where(F.col("u") != F.col("v"))
    edges = common.written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                           "cc-edges")
    state = _state(edges)
    while state[0]:
        large = _least(_two(edges, ("u", "v"), ("v", "u"))).where(F.col("v") > F.col("u"))
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Every u has neighbours below it only; itself goes along.
        small = _two(_least(large), ("v", "m"), ("u", "m")).where(F.col("u") != F.col("v")).distinct()
        edges = common.written(small, "cc-edges")
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.groupBy("u").agg(F.min("v").alias("label")).select(F.col("u").alias("node"), "label")
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
