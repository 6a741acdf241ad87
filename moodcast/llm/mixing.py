"""Mixing sources to target weights by weighted fair queueing.

Every document of a source is put in an order shuffled by a hash of its
key.  Its virtual finish time is the number of tokens of its source up to
and including it, divided by the source's target; a second and further
pass over a source goes on where the pass before ended.  All documents of
all sources are queued by virtual finish time and the queue is cut where
the total budget is spent, so that sources advance in proportion to their
targets.

No source or stretch of the queue is gathered in one task: running sums
are taken inside value ranges (of the shuffle hash, and of the finish
time) and the totals of the ranges before are added from small tables
with one row per range.  The ranges follow from values, so a recomputed
partition gives the same sums.

Defined results: every row is a document of its own, also where ids are
null or repeated (a mix takes rows alike in id, source and text together);
null ids and null sources are ordinary keys; a text without words has size
0 and is never taken; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

# Fixed values of the contract.
WEIGHT_CYCLE = (5.0, 2.0, 1.0)
BUDGET_RATIO = 1.5
MAX_PASSES = 2

#: Ranges of the shuffle hash in each source, and of the finish time.
HASH_RANGES = 4096
TIME_RANGES = 16384


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(common.WORD_PATTERN)), F.lit(0)).cast("long")


def cycle_weight(rank: Column, cycle: tuple[float, ...] = WEIGHT_CYCLE) -> Column:
    return F.element_at(F.array(*map(F.lit, cycle)), (rank % len(cycle) + 1).cast("int"))


def source_targets(sizes: DataFrame, budget_ratio: float = BUDGET_RATIO, max_passes: int = MAX_PASSES,
                   cycle: tuple[float, ...] = WEIGHT_CYCLE) -> DataFrame:
    """(source, size) rows -> (source, source_size, target).

    The targets share ``budget_ratio`` of all sizes by weight, stop at
    ``max_passes`` times the source's size, and the excess is shared again
    among the sources below their stop.  Water filling in closed form: a
    source stops when the common level (budget per weight) passes
    ``cap / weight``, so with the sources sorted by that ratio the level is
    the first at which the rest of the budget fits the rest of the weights.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on; the order is by code point, null last.
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    per = per.withColumn("weight", cycle_weight(F.row_number().over(order) - 1, cycle))
    per = per.withColumn("cap", F.col("source_size") * float(max_passes))
    per = per.withColumn("ratio", F.col("cap") / F.col("weight"))
    by_ratio = Window.orderBy("ratio", F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = (per.withColumn("spent", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("used", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
           .withColumn("budget", F.sum("source_size").over(everything) * budget_ratio)
           .withColumn("weights", F.sum("weight").over(everything)))
    per = per.withColumn("level", (F.col("budget") - F.col("spent")) / (F.col("weights") - F.col("used")))
    # The first source that the level does not fill fixes it for all after;
    # computed past that source, the level only falls.
    per = per.withColumn("final", F.max(F.when(F.col("level") <= F.col("ratio"), F.col("level"))).over(everything))
    target = F.when(F.col("final").isNull(), F.col("cap")).otherwise(
        F.least("cap", F.col("final") * F.col("weight")))
    return per.select("source", "source_size", target.alias("target"))


def _ranged_sum(df: DataFrame, part: list[str], bucket: str, order: list[Column], value: str, out: str) -> DataFrame:
    """Running sum of ``value`` in ``part`` by (bucket, order): inside each
    range a window, before it the total of the lower ranges."""
    totals = df.groupBy(*part, bucket).agg(F.sum(value).alias("range_sum"))
    lower = Window.partitionBy(*part).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*[F.col(c).alias(f"t_{c}") for c in [*part, bucket]],
                           F.coalesce(F.sum("range_sum").over(lower), F.lit(0)).alias("below"))
    inside = Window.partitionBy(*part, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = [df[c].eqNullSafe(F.col(f"t_{c}")) for c in [*part, bucket]]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    return (df.join(totals, cond).withColumn(out, F.sum(value).over(inside) + F.col("below"))
            .drop("below", *[f"t_{c}" for c in [*part, bucket]]))


def queue(docs: DataFrame, budget_ratio: float = BUDGET_RATIO, max_passes: int = MAX_PASSES,
          cycle: tuple[float, ...] = WEIGHT_CYCLE, seed: int = 17) -> DataFrame:
    """Documents (doc_id, source, size, and what else tells them apart) with source_size, target, finish
    (virtual finish time of the first pass) and passes (times taken)."""
    one = docs
    targets = source_targets(one, budget_ratio, max_passes, cycle)
    # Null-safe join on the source: one row per source on that side.
    t = targets.withColumnRenamed("source", "t_source")
    one = one.join(t, one["source"].eqNullSafe(t["t_source"])).drop("t_source")
    mine = [F.col(c) for c in one.columns if c not in ("source", "source_size", "target", "size")]
    shuffle = F.xxhash64(F.lit(seed), *[x for c in mine for x in (c.isNull(), c)])
    one = (one.withColumn("mix_hash", shuffle)
           .withColumn("mix_range", F.shiftrightunsigned("mix_hash", 64 - HASH_RANGES.bit_length() + 1)))
    run = _ranged_sum(one, ["source"], "mix_range", [F.col("mix_hash"), F.col("doc_id"), F.col("size")], "size", "upto")
    run = run.withColumn("finish", F.when(F.col("target") > 0, F.col("upto") / F.col("target")))
    # The cut: the queue of all passes by finish time, its total so far.
    run = common.written(run.drop("mix_range"), "mix-queue")
    step = F.col("source_size") / F.col("target")
    entry = (run.where((F.col("size") > 0) & F.col("finish").isNotNull())
             .select("doc_id", "source", "size", "mix_hash",
                     F.explode(F.transform(F.sequence(F.lit(0), F.lit(max_passes - 1)),
                                           lambda p: F.struct(p.alias("pass"), (F.col("finish") + p * step).alias("at"))))
                     .alias("e"))
             .select("doc_id", "source", "size", "mix_hash", "e.pass", "e.at")
             .withColumn("bucket", F.floor(F.col("at") * TIME_RANGES / max_passes)))
    sums = entry.groupBy("bucket").agg(F.sum("size").alias("bucket_size"))
    so_far = Window.orderBy("bucket")  # TIME_RANGES rows at most
    budget = run.groupBy("source").agg(F.first("target").alias("target")).agg(F.sum("target")).collect()[0][0] or 0.0
    edge = (sums.withColumn("total", F.sum("bucket_size").over(so_far))
            .where(F.col("total") > budget)
            .agg(F.min_by(F.struct("bucket", (F.col("total") - F.col("bucket_size")).alias("below")),
                          "bucket").alias("edge")))
    first = edge.collect()[0]["edge"]
    if first is None:
        return run.withColumn("passes", F.when(F.col("finish").isNotNull() & (F.col("size") > 0),
                                               F.lit(max_passes)).otherwise(0))
    # Only the entries of the range that holds the cut are put in order.
    order = ["at", "pass", "mix_hash", "source", "doc_id", "size"]
    inside = Window.orderBy(*[F.col(c).asc_nulls_first() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    last = (entry.where(F.col("bucket") == first["bucket"])
            .withColumn("total", F.sum("size").over(inside) + first["below"])
            .where(F.col("total") <= budget)
            .agg(F.max("at").alias("at")).collect()[0]["at"])
    cut = last if last is not None else first["bucket"] * max_passes / TIME_RANGES
    taken = sum((F.when(F.col("finish") + p * step <= F.lit(cut), 1).otherwise(0)
                 for p in range(1, max_passes)), F.when(F.col("finish") <= F.lit(cut), 1).otherwise(0))
    return run.withColumn("passes", F.when(F.col("size") > 0, F.coalesce(taken, F.lit(0))).otherwise(0))


def mix(docs: DataFrame, budget_ratio: float = BUDGET_RATIO, max_passes: int = MAX_PASSES,
        cycle: tuple[float, ...] = WEIGHT_CYCLE, seed: int = 17) -> DataFrame:
    """The mix: the rows of ``docs`` that are taken, with ``mix_size``,
    ``mix_target``, ``mix_finish`` and ``mix_passes`` (how often the row's
    document is taken), range-sorted by virtual finish time."""
    # Rows alike in id, source and text are taken together, all others by themselves.
    mark = common.row_hash(F.col("text"))
    sized = docs.select("doc_id", "source", mark.alias("mark"), n_words(F.col("text")).alias("one"))
    sized = sized.groupBy("doc_id", "source", "mark").agg(F.sum("one").alias("size"), F.max("one").alias("one"))
    q = queue(sized.drop("one"), budget_ratio, max_passes, cycle, seed).where(F.col("passes") > 0)
    q = q.select(F.col("doc_id").alias("q_doc"), F.col("source").alias("q_source"), F.col("mark").alias("q_mark"),
                 F.col("target").alias("mix_target"), F.col("finish").alias("mix_finish"), F.col("passes").alias("mix_passes"))
    rows = docs.select(common.row_struct(docs).alias("mix_row"), mark.alias("mark"), n_words(F.col("text")).alias("mix_size"))
    out = rows.join(q, (F.col("mark") == F.col("q_mark")) & F.col("mix_row.doc_id").eqNullSafe(F.col("q_doc"))
                    & F.col("mix_row.source").eqNullSafe(F.col("q_source")))
    added = {c: F.col(c) for c in ("mix_size", "mix_target", "mix_finish", "mix_passes")}
    return out.select(*common.unpacked(docs, "mix_row", added)).orderBy("mix_finish", "doc_id")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, one row per document."""
    sized = docs.select("doc_id", "source", common.row_hash(F.col("text")).alias("mark"), n_words(F.col("text")).alias("size"))
    return queue(sized).select("doc_id", "source", "size", "source_size", "target",
                               (F.col("size") * F.col("passes")).cast("long").alias("taken"),
                               F.col("finish").alias("virtual_finish"), "passes")
