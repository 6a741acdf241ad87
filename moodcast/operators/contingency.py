"""Contingency tables and Pearson's chi-square test on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import special
from . import joins


def pivot(df: DataFrame, row: str, col: str, col_values: Sequence, weight: str | None = None,
          by: Sequence[str] = ()) -> DataFrame:
    """Wide table: one row per row value, one column per column value."""
    w = F.col(weight) if weight else F.lit(1)
    sums = [F.sum(F.when(F.col(col) == F.lit(v), w).otherwise(F.lit(0))).cast("long").alias(str(v))
            for v in col_values]
    return df.where(F.col(col).isin(list(col_values))).groupBy(*by, row).agg(*sums)


def expected(df: DataFrame, row: str, col: str, col_values: Sequence, weight: str | None = None,
             by: Sequence[str] = ()) -> DataFrame:
    """Long cells with observed and expected counts and the table's dof.

    One aggregate builds the wide table (a row per row value, a column per
    listed column value); a row total is a sum across that row, and the
    column totals, grand total and row count of each test are one small
    aggregate attached to every row (a scalar subquery for a single
    table, a counted broadcast per test otherwise).  No window and no
    task holding a whole table.
    """
    m = len(col_values)
    w = F.col(weight) if weight else F.lit(1)
    sums = [F.sum(F.when(F.col(col) == F.lit(v), w).otherwise(F.lit(0))).cast("double").alias(f"__c{i}")
            for i, v in enumerate(col_values)]
    wide = df.where(F.col(col).isin(list(col_values))).groupBy(*by, row).agg(*sums)
    wide = wide.withColumn("__r", sum((F.col(f"__c{i}") for i in range(m)), F.lit(0.0)))
    tot = wide.groupBy(*by).agg(*[F.sum(f"__c{i}").alias(f"__tot{i}") for i in range(m)],
                                F.sum("__r").alias("__n"), F.count(F.lit(1)).alias("__rows"))
    wide = joins.attach(wide, tot, by)
    cells = F.explode(F.array(*[
        F.struct(F.lit(v).alias(col), F.col(f"__c{i}").cast("long").alias("observed"),
                 F.col(f"__tot{i}").alias("__ct")) for i, v in enumerate(col_values)]))
    long = wide.select(*by, row, "__r", "__n", "__rows", cells.alias("__cell")).select(
        *by, row, "__cell.*", "__r", "__n", "__rows")
    return (long.withColumn("dof", ((F.col("__rows") - 1) * (m - 1)).cast("long"))
            .withColumn("expected", F.try_divide(F.col("__r") * F.col("__ct"), F.col("__n"))))


def chi2_test(df: DataFrame, row: str, col: str, col_values: Sequence, weight: str | None = None,
              by: Sequence[str] = (), correction: bool = True) -> DataFrame:
    """Pearson chi-square: by..., chi2, p_value, dof.

    With one degree of freedom and ``correction`` the Yates continuity
    correction moves each observed count half a unit (at most the whole
    gap) towards its expected count.  dof = 0 gives chi2 = 0 and p = 1.
    """
    e = expected(df, row, col, col_values, weight, by)
    o = F.col("observed").cast("double")
    gap = F.col("expected") - o
    adj = o + F.signum(gap) * F.least(F.lit(0.5), F.abs(gap)) if correction else o
    o_used = F.when(F.col("dof") == 1, adj).otherwise(o)
    term = F.try_divide((o_used - F.col("expected")) ** 2, F.col("expected"))
    stat = (e.withColumn("__term", term)
            .groupBy(*by).agg(F.sum("__term").alias("__chi2"), F.max("dof").alias("dof")))
    stat = stat.withColumn("chi2", F.when(F.col("dof") == 0, F.lit(0.0)).otherwise(F.col("__chi2")))
    stat = special.apply_spark(stat, special.chi2_upper_steps("chi2", "dof", "p_value", special.SPARK))
    return stat.select(*by, "chi2", "p_value", "dof")
