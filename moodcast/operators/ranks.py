"""Mann-Whitney U test between named pairs of samples.

Rows collapse to one row per distinct value with a count per group (so
a value shared by millions of rows is one row), all groups are ordered
once, and running counts of smaller values per group give every pair's
mid-ranks.  The ordering is cut into value ranges, so no task holds more
than one of them.  U, the tie term and the normal
approximation come from one aggregate over the value table; small
samples without ties take the exact distribution.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from fractions import Fraction
from functools import lru_cache

import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import special
from ..session import ship_package
from . import joins

EXACT_MAX = 8


def exact_two_sided(u: float, n1: int, n2: int) -> float:
    """2 * P(U >= u) under H0, U the Mann-Whitney count of samples of n1
    and n2 without ties.

    U counts as a partition into at most m = min(n1, n2) parts of at most
    n = max(n1, n2); its distribution function is a fixed sum of binomial
    polynomials: with prod_{i<=m} (1 - q^(n+i)) opened into 2^m signed
    powers, each term needs the number of partitions of at most r into
    parts of at most m, a quasi-polynomial in r.  So the cost depends on
    m <= EXACT_MAX only, not on n.
    """
    m, n = min(n1, n2), max(n1, n2)
    if m == 0:
        return 1.0
    k = math.ceil(u - 1e-9)
    below = m * n - k  # P(U >= k) = P(U <= mn - k) by symmetry
    if below < 0:
        return 0.0
    signed: dict[int, int] = {0: 1}
    for i in range(1, m + 1):
        for power, sign in list(signed.items()):
            if power + n + i <= below:
                signed[power + n + i] = signed.get(power + n + i, 0) - sign
    count = sum(sign * _partitions_up_to(below - power, m) for power, sign in signed.items() if sign)
    return float(min(Fraction(1), Fraction(2 * count, math.comb(m + n, m))))


@lru_cache(maxsize=None)
def _partition_numerator(m: int) -> tuple[int, tuple[int, ...]]:
    """1 / ((1-q) prod_{i<=m} (1-q^i)) = numerator / (1 - q^c)^(m+1), c the
    least common multiple of 1..m: (c, numerator)."""
    c = math.lcm(*range(1, m + 1))
    poly = [1]
    for step in (1, *range(1, m + 1)):
        # times (1 - q^c) / (1 - q^step): a run of ones at every step-th place
        out = [0] * (len(poly) + c - step)
        for at in range(0, c, step):
            for j, v in enumerate(poly):
                out[at + j] += v
        poly = out
    return c, tuple(poly)


def _partitions_up_to(r: int, m: int) -> int:
    """Partitions of 0..r into parts of at most m."""
    c, numerator = _partition_numerator(m)
    return sum(v * math.comb((r - j) // c + m, m) for j, v in enumerate(numerator)
               if v and j <= r and (r - j) % c == 0)


@F.pandas_udf(T.DoubleType())
def _exact_p(u: pd.Series, n1: pd.Series, n2: pd.Series, tmax: pd.Series) -> pd.Series:
    # Spark evaluates the UDF on every pair row, whatever the branch that
    # uses it, so its conditions must be here as well.
    return pd.Series([exact_two_sided(float(a), int(b), int(c)) if min(b, c) <= EXACT_MAX and t <= 1 else None
                      for a, b, c, t in zip(u, n1, n2, tmax)], dtype="float64")


#: Most ranges of the value table, by quantiles of the distinct values, and
#: the distinct values that one range is to hold.
RANGES, RANGE_ROWS = 1024, 1 << 16


def value_ranges(wide: DataFrame, value: str, rows: int, ranges: int = RANGES) -> DataFrame:
    """``wide`` with __range, which rises with the value and follows from
    it alone: few values are one range; many are cut at their approximate
    quantiles, and a value's range is found by binary search in the JVM."""
    n = min(ranges, -(-rows // RANGE_ROWS))
    placed = wide.withColumn("__key", F.col(value).cast("double"))
    if n < 2:
        return placed.withColumn("__range", F.lit(0.0)).drop("__key")
    cuts = placed.where(~F.isnan("__key")).approxQuantile("__key", [i / n for i in range(1, n)], 0.1 / n)
    inner = sorted({c for c in cuts if math.isfinite(c)})
    if not inner:
        return placed.withColumn("__range", F.lit(0.0)).drop("__key")
    # NaN, the largest value, gets a range of its own behind all others.
    bucketizer = Bucketizer(splits=[-math.inf, *inner, math.inf], inputCol="__key", outputCol="__range", handleInvalid="keep")
    return bucketizer.transform(placed).drop("__key")


def running_below(wide: DataFrame, value: str, counts: list[str], ranges: int = RANGES) -> DataFrame:
    """For each distinct value, add __below_<c> = sum of column c over all
    smaller values, for every count column c.

    The values are cut into ranges: each range has its own running sums, and
    one row per range gives the sums below it.  A recomputed partition puts
    every value into the same range.  The value table is kept and counted
    while the query is built, as its size decides on the ranges.
    """
    first = Window.unboundedPreceding
    wide = joins.keep(wide)
    placed = value_ranges(wide, value, wide.count(), ranges)
    totals = placed.groupBy("__range").agg(*[F.sum(c).alias(f"__tot_{c}") for c in counts])
    lower = Window.orderBy("__range").rowsBetween(first, -1)  # one row per range
    offsets = totals.select("__range", *[F.coalesce(F.sum(f"__tot_{c}").over(lower), F.lit(0.0)).alias(f"__off_{c}")
                                         for c in counts])
    inside = Window.partitionBy("__range").orderBy(value).rowsBetween(first, -1)
    within = placed.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0.0)).alias(f"__in_{c}") for c in counts])
    out = within.join(F.broadcast(offsets), "__range")  # at most ``ranges`` rows
    return out.select(*wide.columns, *[(F.col(f"__off_{c}") + F.col(f"__in_{c}")).alias(f"__below_{c}")
                                       for c in counts])


def mann_whitney(df: DataFrame, group: str, value: str, pairs: Sequence[tuple[str, str]],
                 by: Sequence[str] = (), exact: bool = True) -> DataFrame:
    """group1, group2, u_stat (for group1), p_value (two-sided) per pair.

    The rows become one row per distinct value with a count column per
    group (one aggregate), every group's running count of smaller values
    is computed over that one ordering, and one aggregate then gives each
    pair its rank sum, sizes and tie term:
    R1 = sum_v n1(v) * (below1(v) + below2(v) + (n1(v) + n2(v) + 1) / 2).
    """
    if by:
        raise ValueError("mann_whitney compares named groups; filter to one test first")
    spark = SparkSession.getActiveSession() or df.sparkSession
    ship_package(spark)
    groups = sorted({g for pair in pairs for g in pair})
    col_of = {g: f"__n{i}" for i, g in enumerate(groups)}
    counts = [F.sum(F.when(F.col(group) == F.lit(g), F.lit(1.0)).otherwise(F.lit(0.0))).alias(col_of[g])
              for g in groups]
    wide = (df.where(F.col(value).isNotNull() & F.col(group).isin(groups))
            .groupBy(value).agg(*counts))
    ranked = running_below(wide, value, list(col_of.values()))
    stats = []
    for i, (a, b) in enumerate(pairs):
        na, nb = F.col(col_of[a]), F.col(col_of[b])
        t = na + nb
        mid = F.col(f"__below_{col_of[a]}") + F.col(f"__below_{col_of[b]}") + (t + 1.0) / 2.0
        stats += [F.sum(na).alias(f"__p{i}_n1"), F.sum(nb).alias(f"__p{i}_n2"),
                  F.sum(na * mid).alias(f"__p{i}_r1"), F.sum(t * t * t - t).alias(f"__p{i}_ties"),
                  F.max(t).alias(f"__p{i}_tmax")]
    one = ranked.agg(*stats)
    rows = F.explode(F.array(*[
        F.struct(F.lit(a).alias("group1"), F.lit(b).alias("group2"),
                 F.col(f"__p{i}_n1").alias("__n1"), F.col(f"__p{i}_n2").alias("__n2"),
                 F.col(f"__p{i}_r1").alias("__r1"), F.col(f"__p{i}_ties").alias("__ties"),
                 F.col(f"__p{i}_tmax").alias("__tmax"))
        for i, (a, b) in enumerate(pairs)]))
    s = one.select(rows.alias("__s")).select("__s.*")
    nn = F.col("__n1") + F.col("__n2")
    s = (s.withColumn("u_stat", F.col("__r1") - F.col("__n1") * (F.col("__n1") + 1.0) / 2.0)
         .withColumn("__u", F.greatest(F.col("u_stat"), F.col("__n1") * F.col("__n2") - F.col("u_stat")))
         .withColumn("__sigma", F.sqrt(F.col("__n1") * F.col("__n2") / 12.0
                                       * ((nn + 1.0) - F.try_divide(F.col("__ties"), nn * (nn - 1.0)))))
         .withColumn("__z", F.try_divide(F.col("__u") - F.col("__n1") * F.col("__n2") / 2.0 - 0.5,
                                         F.col("__sigma"))))
    s = special.apply_spark(s, special.normal_two_sided_steps("__z", "p_asym", special.SPARK))
    if exact:
        use_exact = (F.least(F.col("__n1"), F.col("__n2")) <= EXACT_MAX) & (F.col("__tmax") <= 1)
        s = s.withColumn("p_value", F.when(use_exact, _exact_p(F.col("__u"), F.col("__n1"), F.col("__n2"),
                                                           F.col("__tmax")))
                         .otherwise(F.col("p_asym")))
    else:
        s = s.withColumn("p_value", F.col("p_asym"))
    return s.select("group1", "group2", "u_stat", "p_value")
