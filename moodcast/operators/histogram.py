"""Histograms of several series over one shared set of equal bins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def shared_histogram(df: DataFrame, series: str, value: str, bins: int = 10) -> DataFrame:
    """series, bin, bin_lo, bin_hi, count - every bin of every series.

    Bins split [min, max] of all series together into ``bins`` equal
    widths; each is half-open except the last, which holds the maximum
    (a value on an edge goes to the bin above it).  With min = max the
    range is widened by 0.5 each side.  The counts are one conditional
    aggregate, so empty bins
    are zeros.  One scalar subquery gives both ends of the range, so the
    input is read twice in all.
    """
    v = F.col(value).cast("double")
    rng = df.select(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()
    pts = (df.where(F.col(value).isNotNull())
           .select(F.col(series), v.alias("__v"), rng.alias("__r"))
           .withColumn("__lo", F.when(F.col("__r.hi") > F.col("__r.lo"), F.col("__r.lo"))
                       .otherwise(F.col("__r.lo") - 0.5))
           .withColumn("__hi", F.when(F.col("__r.hi") > F.col("__r.lo"), F.col("__r.hi"))
                       .otherwise(F.col("__r.hi") + 0.5)))
    lo, hi = F.col("__lo"), F.col("__hi")
    step = (hi - lo) / F.lit(float(bins))

    def edge(i):
        return F.when(i >= bins, hi).otherwise(lo + i.cast("double") * step)

    guess = F.least(F.floor((F.col("__v") - lo) * (F.lit(float(bins)) / (hi - lo))).cast("int"), F.lit(bins - 1))
    b = (pts.withColumn("__g", guess)
         .withColumn("__g", F.when(F.col("__v") < edge(F.col("__g")), F.col("__g") - 1).otherwise(F.col("__g")))
         .withColumn("__g", F.when((F.col("__g") < bins - 1) & (F.col("__v") >= edge(F.col("__g") + 1)),
                                   F.col("__g") + 1).otherwise(F.col("__g"))))
    counts = b.groupBy(series).agg(F.first("__lo").alias("__lo"), F.first("__hi").alias("__hi"),
                                   *[F.count_if(F.col("__g") == i).alias(f"__b{i}") for i in range(bins)])
    cells = F.explode(F.array(*[F.struct(F.lit(i).alias("bin"), F.col(f"__b{i}").alias("count"))
                                for i in range(bins)]))
    out = counts.select(series, "__lo", "__hi", cells.alias("__c")).select(series, "__lo", "__hi", "__c.*")
    return out.select(series, "bin", edge(F.col("bin")).alias("bin_lo"),
                      edge(F.col("bin") + 1).alias("bin_hi"), "count")
