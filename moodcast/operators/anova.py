"""One-way ANOVA and Tukey's HSD from per-group moments.

Each sample collapses to (n, mean, var) per group in one aggregate with
partial (map-side) aggregation, so a group holding most rows costs no
more than any other.  Everything after that runs on k rows per test.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import special
from ..functions.studentized import qtukey, tukey_sf
from ..session import ship_package
from . import joins


def group_moments(df: DataFrame, group: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """by..., group, n, mean, var, and the sums of the whole and the
    fractional parts of the values: the first is exact up to 2^53, so an
    offset common to all values costs the second no digits."""
    v = F.col(value).cast("double")
    m = (df.where(F.col(value).isNotNull())
         .groupBy(*by, group)
         .agg(F.count(F.lit(1)).alias("n"), F.sum(F.floor(v).cast("double")).alias("whole"),
              F.sum(v - F.floor(v)).alias("part"), F.coalesce(F.var_samp(v), F.lit(0.0)).alias("var")))
    return m.withColumn("mean", F.col("whole") / F.col("n") + F.col("part") / F.col("n"))


def one_way_anova(df: DataFrame, group: str, value: str, by: Sequence[str] = ()) -> DataFrame:
    """by..., k, n, f_stat, p_value, df_between, df_within.

    One pass over the rows gives each group's moments; the test's totals
    and then SSW = sum (n - 1) var and SSB = sum n (mean - grand mean)^2
    come from those few rows, the means taken from a whole number near
    the grand mean.
    """
    m = group_moments(df, group, value, by)
    total = m.groupBy(*by).agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("__N"), F.sum("whole").alias("__whole"),
                               F.sum("part").alias("__part"), F.sum((F.col("n") - 1) * F.col("var")).alias("__ssw"))
    total = total.withColumn("__near", F.floor(F.col("__whole") / F.col("__N")).cast("double"))

    def from_near(whole: str, part: str, n: str):
        return (F.col(whole) - F.col("__near") * F.col(n)) / F.col(n) + F.col(part) / F.col(n)

    off = from_near("whole", "part", "n") - from_near("__whole", "__part", "__N")
    ss = (joins.attach(m, total, by).groupBy(*by, "k", F.col("__N"), "__ssw")
          .agg(F.sum(F.col("n") * off * off).alias("__ssb")).withColumnRenamed("__N", "n"))
    ss = (ss
          .withColumn("df_between", F.col("k") - 1)
          .withColumn("df_within", F.col("n") - F.col("k"))
          .withColumn("f_stat", F.try_divide(F.try_divide(F.col("__ssb"), F.col("df_between")),
                                             F.try_divide(F.col("__ssw"), F.col("df_within")))))
    ss = special.apply_spark(ss, special.f_upper_steps("f_stat", "df_between", "df_within", "p_value",
                                                       special.SPARK))
    return ss.select(*by, "k", "n", "f_stat", "p_value", "df_between", "df_within")


@F.pandas_udf(T.DoubleType())
def _tukey_p(q: pd.Series, k: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(a) else tukey_sf(float(a), int(b), float(c))
                      for a, b, c in zip(q, k, df)], dtype="float64")


@F.pandas_udf(T.DoubleType())
def _tukey_crit(alpha: pd.Series, k: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([qtukey(1.0 - float(a), int(b), float(c)) if c > 0 else None
                      for a, b, c in zip(alpha, k, df)], dtype="float64")


def tukey_hsd(df: DataFrame, group: str, value: str, alpha: float = 0.05,
              by: Sequence[str] = ()) -> DataFrame:
    """Tukey-Kramer pairwise comparison.

    by..., group1, group2, meandiff (group2 - group1), p_adj, lower,
    upper, reject; pairs in name order.  One pass gives per-group
    (n, mean, var); one small aggregate per test gathers the group
    summaries in name order with k, N and the pooled sum of squares.  Each
    group then meets those after it, row by row, as every pair is wanted.
    The studentised-range quantile is computed once per test and the tail
    once per pair, in a pandas UDF.
    """
    ship_package(df.sparkSession)
    m = group_moments(df, group, value, by)
    stats = F.struct(F.col(group).alias("g"), "n", "mean")
    per_test = m.groupBy(*by).agg(
        F.array_sort(F.collect_list(stats)).alias("__gs"), F.count(F.lit(1)).alias("__k"),
        F.sum("n").alias("__N"), F.sum((F.col("n") - 1) * F.col("var")).alias("__ssw"))
    per_test = (per_test.withColumn("__dfw", F.col("__N") - F.col("__k"))
                .withColumn("__mse", F.try_divide(F.col("__ssw"), F.col("__dfw")))
                .withColumn("__crit", _tukey_crit(F.lit(alpha), F.col("__k"), F.col("__dfw"))))
    keep = [*by, "__k", "__dfw", "__mse", "__crit"]
    each = per_test.select(*keep, "__gs", F.posexplode("__gs").alias("__i", "__a"))
    later = F.slice("__gs", F.col("__i") + 2, F.size("__gs"))
    pp = each.select(*keep, "__a", F.explode(later).alias("__b")).select(
        *keep, F.struct(F.col("__a").alias("a"), F.col("__b").alias("b")).alias("__p"))
    se = F.sqrt(F.col("__mse") / 2.0 * (1.0 / F.col("__p.a.n") + 1.0 / F.col("__p.b.n")))
    out = (pp
           .withColumn("group1", F.col("__p.a.g"))
           .withColumn("group2", F.col("__p.b.g"))
           .withColumn("meandiff", F.col("__p.b.mean") - F.col("__p.a.mean"))
           .withColumn("__se", se)
           .withColumn("__q", F.try_divide(F.abs(F.col("meandiff")), F.col("__se")))
           .withColumn("p_adj", _tukey_p(F.col("__q"), F.col("__k"), F.col("__dfw")))
           .withColumn("lower", F.col("meandiff") - F.col("__crit") * F.col("__se"))
           .withColumn("upper", F.col("meandiff") + F.col("__crit") * F.col("__se"))
           .withColumn("reject", F.col("__q") > F.col("__crit")))
    return out.select(*by, "group1", "group2", "meandiff", "p_adj", "lower", "upper", "reject")
