"""Per-group regression reduced to sufficient statistics in one aggregate.

Linear: central moments (``covar_pop``, ``var_pop``, ``avg``) per group in
one pass; slope, intercept, r, the two-sided p and standard errors follow
from one row per group.  Polynomial: the points of a group, as rows of a
Chebyshev basis on the group's x range, are reduced to a triangular QR
factor block by block; factors merge like sums do (stacked and factored
again), so a group of any size ends as one small matrix, and no normal
equations square the condition of the fit.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import special
from ..session import ship_package
from . import joins


def linregress(df: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares line of ``y`` on ``x`` per group.

    Columns: by..., n, slope, intercept, r_value, p_value, stderr,
    intercept_stderr.  A group whose x does not vary gets NULL fit
    columns; n = 2 gives p = 0 (or 1 when both y are equal).
    """
    pts = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    mom = pts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(x).cast("double")).alias("__mx"),
        F.avg(F.col(y).cast("double")).alias("__my"),
        F.var_pop(F.col(x).cast("double")).alias("__vx"),
        F.var_pop(F.col(y).cast("double")).alias("__vy"),
        F.covar_pop(F.col(x).cast("double"), F.col(y).cast("double")).alias("__cxy"),
    )
    return finish_linregress(mom, by)


def finish_linregress(mom: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """From (n, __mx, __my, __vx, __vy, __cxy) per group to the fit."""
    ok = F.col("__vx") > 0
    slope = F.when(ok, F.col("__cxy") / F.col("__vx"))
    r = F.when(ok & (F.col("__vy") > 0),
               F.greatest(F.lit(-1.0), F.least(F.lit(1.0),
                          F.col("__cxy") / F.sqrt(F.col("__vx") * F.col("__vy")))))
    r = F.when(ok, F.coalesce(r, F.lit(0.0)))
    out = (mom.withColumn("slope", slope)
           .withColumn("intercept", F.col("__my") - F.col("slope") * F.col("__mx"))
           .withColumn("r_value", r)
           .withColumn("__df", F.col("n") - 2))
    out = special.apply_spark(out, special.t_two_sided_steps("r_value", "__df", "__p", special.SPARK))
    p = (F.when(~ok | (F.col("n") < 2), F.lit(None).cast("double"))
         .when(F.col("n") == 2, F.when(F.col("__vy") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
         .otherwise(F.col("__p")))
    se = F.when(ok & (F.col("n") > 2), F.sqrt(
        (F.lit(1.0) - F.col("r_value") * F.col("r_value")) * F.col("__vy") / F.col("__vx") / F.col("__df")))
    se = F.when(F.col("n") == 2, F.when(ok, F.lit(0.0))).otherwise(se)
    out = (out.withColumn("p_value", p)
           .withColumn("stderr", se)
           .withColumn("intercept_stderr", F.col("stderr") * F.sqrt(F.col("__vx") + F.col("__mx") * F.col("__mx"))))
    return out.select(*by, "n", "slope", "intercept", "r_value", "p_value", "stderr", "intercept_stderr")


def with_line(df: DataFrame, fit: DataFrame, x: str, by: Sequence[str] = (),
              out: str = "lin_predict") -> DataFrame:
    """slope * x + intercept with each group's coefficients (counted broadcast)."""
    if not by:
        raise ValueError("give the group columns the fit was made by")
    coef = fit.select(*by, F.col("slope").alias("__b1"), F.col("intercept").alias("__b0"))
    joined = df.join(joins.bounded(coef), list(by), "left")
    return joined.withColumn(out, F.col("__b1") * F.col(x) + F.col("__b0")).drop("__b1", "__b0")


# ----------------------------------------------------------------------
# Polynomial fits.
# ----------------------------------------------------------------------


def _scaled(df: DataFrame, x: str, by: Sequence[str]) -> DataFrame:
    """Add __z, the group's x mapped to [-1, 1] (0 when x does not vary)."""
    rng = df.groupBy(*by).agg(F.min(F.col(x).cast("double")).alias("__lo"),
                              F.max(F.col(x).cast("double")).alias("__hi"))
    j = df.join(joins.bounded(rng), list(by))
    width = F.col("__hi") - F.col("__lo")
    z = F.when(width > 0, (F.lit(2.0) * F.col(x) - F.col("__lo") - F.col("__hi")) / width).otherwise(F.lit(0.0))
    return j.withColumn("__z", z)


#: Factors of one group that one task merges at a time, and groups whose
#: factors a task holds before it hands them on.
MERGE_WAYS = 64
HELD_GROUPS = 4096


def _merged_r(blocks: list[np.ndarray], width: int) -> np.ndarray:
    """The triangular factor of blocks of rows, as a width x width matrix."""
    r = np.linalg.qr(np.vstack(blocks), mode="r")
    out = np.zeros((width, width))
    out[:len(r)] = r[:width]
    return out


def _factors(degree: int, by: list[str]):
    """Points (by..., __z, __y) to (by..., r, n), one row per group and task."""
    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple[np.ndarray, int]] = {}

        def handed_on() -> pd.DataFrame:
            rows = [(*k, r.ravel(), n) for k, (r, n) in held.items()]
            held.clear()
            return pd.DataFrame(rows, columns=[*by, "r", "n"])

        for points in batches:
            for key, part in points.groupby(by, dropna=False, sort=False):
                rows = np.column_stack((np.polynomial.chebyshev.chebvander(part["__z"].to_numpy(float), degree),
                                        part["__y"].to_numpy(float)))
                key = tuple(None if pd.isna(k) else k for k in key)
                old = held.get(key)
                held[key] = (_merged_r([rows] if old is None else [old[0], rows], degree + 2),
                             len(rows) + (old[1] if old else 0))
            if len(held) >= HELD_GROUPS:
                yield handed_on()
        if held:
            yield handed_on()

    return blocks


def _merge(degree: int, by: list[str]):
    def merge(part: pd.DataFrame) -> pd.DataFrame:
        size = degree + 2
        r = _merged_r([np.asarray(x, float).reshape(size, size) for x in part["r"]], size)
        return pd.DataFrame([(*[part[b].iloc[0] for b in by], r.ravel(), int(part["n"].sum()))], columns=[*by, "r", "n"])

    return merge


def solve_triangular(r: np.ndarray, degree: int) -> tuple[np.ndarray, int]:
    """Least-squares coefficients from a factor of [basis | y], and the
    rank; directions at rounding level only are left out."""
    size = degree + 2
    r = r.reshape(size, size)
    coef, _, rank, _ = np.linalg.lstsq(r[:, :-1], r[:, -1], rcond=size * np.finfo(float).eps)
    return coef, int(rank)


def _solved(degree: int):
    def solve(r: pd.Series) -> pd.DataFrame:
        got = [solve_triangular(np.asarray(x, float), degree) for x in r]
        return pd.DataFrame({"coef": [c.tolist() for c, _ in got], "rank": [k for _, k in got]})

    solve.__annotations__ = {"r": pd.Series, "return": pd.DataFrame}
    return solve


def polyfit(df: DataFrame, x: str, y: str, degree: int, by: Sequence[str] = ()) -> DataFrame:
    """Least-squares polynomial of ``y`` on ``x`` per group.

    Returns by..., n, rank, lo, hi, coef (Chebyshev coefficients on
    [lo, hi]).  Every task reduces its points of a group to one factor;
    a group's factors are merged in two rounds, so a group that many
    tasks share is never one task's work.
    """
    if not by:
        raise ValueError("give at least one group column")
    ship_package(df.sparkSession)
    by = list(by)
    pts = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    rng = pts.groupBy(*by).agg(F.min(F.col(x).cast("double")).alias("lo"), F.max(F.col(x).cast("double")).alias("hi"))
    pts = _scaled(pts, x, by).select(*by, "__z", F.col(y).cast("double").alias("__y"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pts.select(*by).schema)
    factors = pts.mapInPandas(_factors(degree, by), f"{kinds}, r array<double>, n long")
    salted = factors.withColumn("__way", F.pmod(F.spark_partition_id(), F.lit(MERGE_WAYS)))
    schema = f"{kinds}, r array<double>, n long"
    merged = salted.groupBy(*by, "__way").applyInPandas(_merge(degree, by), schema)
    merged = merged.groupBy(*by).applyInPandas(_merge(degree, by), schema)
    fit = merged.withColumn("__s", F.pandas_udf(_solved(degree), "coef array<double>, rank int")("r"))
    fit = fit.select(*[F.col(b).alias(f"__{b}") for b in by], "n", F.col("__s.rank").alias("rank"),
                     F.col("__s.coef").alias("coef"))
    same = [rng[b].eqNullSafe(fit[f"__{b}"]) for b in by]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return rng.join(fit, cond).select(*by, "n", "rank", "lo", "hi", "coef")


def with_poly(df: DataFrame, fit: DataFrame, x: str, degree: int, by: Sequence[str] = (),
              out: str = "poly_predict") -> DataFrame:
    """Evaluate each group's polynomial at x (Clenshaw, JVM expressions)."""
    coef = fit.select(*by, F.col("lo").alias("__lo"), F.col("hi").alias("__hi"), F.col("coef").alias("__c"))
    if not by:
        raise ValueError("give the group columns the fit was made by")
    j = df.join(joins.bounded(coef), list(by), "left")
    width = F.col("__hi") - F.col("__lo")
    j = j.withColumn("__z", F.when(width > 0, (F.lit(2.0) * F.col(x) - F.col("__lo") - F.col("__hi")) / width)
                     .otherwise(F.lit(0.0)))
    j = j.selectExpr("*", "0.0D AS __q" + str(degree + 2), "0.0D AS __q" + str(degree + 1))
    for k in range(degree, 0, -1):
        j = j.selectExpr("*", f"__c[{k}] + 2.0D * __z * __q{k + 1} - __q{k + 2} AS __q{k}")
    j = j.selectExpr("*", f"__c[0] + __z * __q1 - __q2 AS `{out}`")
    return j.drop("__lo", "__hi", "__c", "__z", *[f"__q{k}" for k in range(1, degree + 3)])


def fit_series(df: DataFrame, x: str, y: str, degree: int, by: Sequence[str],
               lin_out: str = "lin_predict", poly_out: str = "poly_predict") -> DataFrame:
    """Each point with its group's straight-line and polynomial fits.

    Each set of coefficients is one row per group, joined to the points.
    """
    fit = polyfit(df, x, y, degree, by)
    lines = with_line(df, linregress(df, x, y, by), x, by, lin_out)
    return with_poly(lines, fit, x, degree, by, poly_out)
