"""Hard negatives by segment summary filtering.

Every vector is stored with summaries: for each of its segments (of 64, 16
and 4 components) the mean and the deviation, scaled by the root of the
segment's width.  The inner product of two segments is the product of
their means, plus or minus at most the product of their deviations, so the
summaries bound a score from both sides.  A search goes from wide segments
to narrow ones, and only pairs that no bound rules out are scored exactly.

Anchors are searched against all rows in blocks.  A block's anchors (at
most ``BLOCK_BYTES``, checked before they are fetched) are sent to all
tasks, and one pass over the rows finds their positives, a second one the
negatives below them.  A task keeps the ``POSITIVES`` or ``NEGATIVES`` best
of each anchor so far, which also raise the bound, and hands those on; the
few of all tasks are ranked in Spark.  Each block's hits are appended to a
written table, and its anchors are given up before the next block's.

Defined results: rows with a null label, a null vector, or a component
that is null, not finite or too large to be scaled take no part; a shorter
vector counts as zero in the components it lacks, an empty one everywhere.
A row's id tells it from an anchor: rows of the anchor's own id are no
positives of it.  Anchors alike in id, label and vector are one anchor;
other repeated rows count each.  A null id is no anchor, keeps its label
and comes last among equal scores.  Equal scores and ids are ordered by
the rows' contents.  Scores are exact; beyond the range of a long they are
the nearest long.  Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodcast.session import scratch_path

from . import common

SCALE = 256
#: Anchors are the rows whose id is divisible by this.
QUERY_STEP = 100
POSITIVES, NEGATIVES = 5, 5
#: A negative's score is at least so many hundredths of the positive's.
LEAST_SHARE = 80

#: Components of a segment, from the first bound to the last.
WIDTHS = (64, 16, 4)
#: What the rounding of a bound may come to, as a share of the lengths' product.
SLACK = 1e-10
#: Bytes of a block of anchors: of its vectors and summaries.
BLOCK_BYTES = 32 << 20
#: Anchors and rows that are held against each other at once.
ANCHORS, ROWS = 512, 2048
#: A tile with fewer open pairs than one in so many is scored pair by pair.
SPARSE = 16

_NONE = np.iinfo(np.int64).min
_TOP = np.iinfo(np.int64).max
_PACKED = "id long, label long, vec binary, sums binary"


def summary(v: np.ndarray) -> np.ndarray:
    """Means, then deviations, of each width's segments of a padded vector,
    both times the root of the width."""
    out = []
    for w in WIDTHS:
        s = v.reshape(-1, w)
        out += [s.mean(axis=1) * w ** 0.5, s.std(axis=1) * w ** 0.5]
    return np.concatenate(out)


def _pack_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        kept, vecs, sums = [], [], []
        for i, v in enumerate(rows["embedding"]):
            with np.errstate(over="ignore", invalid="ignore"):
                v = np.floor(SCALE * np.asarray(v, np.float64))
                if not np.isfinite(v).all():
                    continue
                v = np.concatenate((v, np.zeros(-len(v) % WIDTHS[0] if len(v) else WIDTHS[0])))
                kept.append(i)
                vecs.append(v.tobytes())
                sums.append(summary(v).tobytes())
        yield pd.DataFrame({"id": rows["id"].to_numpy()[kept], "label": rows["label"].to_numpy()[kept],
                            "vec": vecs, "sums": sums}).astype({"id": "Int64"})


def packed(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding, label) that take part, with their label as
    it counts, their scaled vector and its summaries, as a written table."""
    common.prepare(rows.sparkSession)
    n = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (n + 1) % 10).otherwise(n)
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = rows.where(n.isNotNull() & F.col("embedding").isNotNull() & sound)
    some = some.select(F.col("vec_id").cast("long").alias("id"), label.alias("label"),
                       F.col("embedding").cast("array<double>").alias("embedding"))
    own = F.xxhash64("label", "vec")
    return common.written(some.mapInPandas(_pack_batches, _PACKED).withColumn("own", own), "hn-rows")


class Side:
    """Rows of one vector length: ids, labels, scaled vectors, summaries."""

    def __init__(self, ids: np.ndarray, null: np.ndarray, label: np.ndarray, own: np.ndarray, vec: np.ndarray, sums: np.ndarray):
        self.ids, self.null, self.label, self.own, self.vec, self.sums = ids, null, label, own, vec, sums

    def __len__(self) -> int:
        return len(self.ids)

    def part(self, some: object) -> Side:
        return Side(self.ids[some], self.null[some], self.label[some], self.own[some], self.vec[some], self.sums[some])

    def level(self, k: int, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Means and deviations of width k in the first ``length`` components."""
        at = 2 * sum(self.vec.shape[1] // w for w in WIDTHS[:k])
        n, used = self.vec.shape[1] // WIDTHS[k], length // WIDTHS[k]
        return self.sums[:, at:at + used], self.sums[:, at + n:at + n + used]


def sides(columns: list[pa.Array]) -> list[Side]:
    """Columns id, label, own, vec, sums of some rows, by vector length."""
    ids, label, own = [c.to_numpy(zero_copy_only=False) for c in (columns[0].fill_null(_TOP), columns[1], columns[2])]
    null = columns[0].is_null().to_numpy(zero_copy_only=False)
    size = np.array([len(v) for v in columns[3].to_pylist()], np.int64)
    out = []
    for s in np.unique(size):
        at = np.flatnonzero(size == s)
        blocks = [np.frombuffer(b"".join(c.take(pa.array(at)).to_pylist()), np.float64).reshape(len(at), -1) for c in columns[3:]]
        out.append(Side(ids[at], null[at], label[at], own[at], *blocks))
    return out


def open_pairs(a: Side, b: Side, low: np.ndarray, high: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """The pairs of ``mask`` that the bounds leave: a's scores are wanted
    from ``low`` to ``high``.  Each level looks only at the rows and columns
    that the one before has left."""
    length = min(a.vec.shape[1], b.vec.shape[1])
    mask = mask.copy()
    for k in range(len(WIDTHS)):
        i, j = np.flatnonzero(mask.any(axis=1)), np.flatnonzero(mask.any(axis=0))
        if not len(i):
            break
        (ma, da), (mb, db) = [[x[at] for x in s.level(k, length)] for s, at in ((a, i), (b, j))]
        with np.errstate(over="ignore", invalid="ignore"):
            na, nb = [np.sqrt(SLACK * (m ** 2 + d ** 2).sum(axis=1, keepdims=True)) for m, d in ((ma, da), (mb, db))]
            middle, reach = ma @ mb.T, np.hstack((da, na)) @ np.hstack((db, nb)).T
            # Bounds that are no numbers rule nothing out.
            mask[np.ix_(i, j)] &= ~(middle + reach < low[i, None]) & ~(middle - reach > high[i, None])
    return mask


def exact(a: np.ndarray, b: np.ndarray, pairs: bool = False) -> np.ndarray:
    """Inner products of whole-numbered rows, each with each or pairwise,
    as longs."""
    length = min(a.shape[1], b.shape[1])
    a, b = a[:, :length], b[:, :length]
    if not a.size or not b.size or np.abs(a).max() * np.abs(b).max() * length < 2 ** 53:
        return (np.einsum("ij,ij->i", a, b) if pairs else a @ b.T).astype(np.int64)
    a, b = [np.array([[int(x) for x in r] for r in m], object) for m in (a, b)]
    s = (a * b).sum(axis=1) if pairs else a @ b.T
    return np.clip(s, -_TOP, _TOP).astype(np.int64)


def scores(a: Side, b: Side, mask: np.ndarray) -> np.ndarray:
    """Exact scores of the pairs of ``mask``; none elsewhere."""
    out = np.full(mask.shape, _NONE)
    if mask.sum() * SPARSE < mask.size:
        i, j = np.nonzero(mask)
        out[i, j] = exact(a.vec[i], b.vec[j], pairs=True)
        return out
    return np.where(mask, exact(a.vec, b.vec), out)


class Best:
    """The first ``most`` of each group so far, by score, id and content."""

    def __init__(self, groups: int, most: int):
        self.most = most
        self.floor = np.full(groups, _NONE)
        self.rows = [np.zeros(0, np.int64)] * 5  # group, score, null, id, own

    def add(self, group: np.ndarray, s: np.ndarray, b: Side) -> None:
        """Scores (groups, rows of b); none where there is no pair."""
        if s.shape[1] > self.most:
            least = np.partition(s, s.shape[1] - self.most, axis=1)[:, s.shape[1] - self.most]
        else:
            least = np.full(len(s), _NONE)
        i, j = np.nonzero((s >= np.maximum(least, self.floor[group])[:, None]) & (s > _NONE))
        if not len(i):
            return
        new = [group[i], s[i, j], b.null[j].astype(np.int64), b.ids[j], b.own[j]]
        rows = [np.concatenate(x) for x in zip(self.rows, new, strict=True)]
        order = np.lexsort((rows[4], rows[3], rows[2], -rows[1], rows[0]))
        first = np.searchsorted(rows[0][order], rows[0][order])
        nth = np.arange(len(order)) - first
        self.rows = [x[order][nth < self.most] for x in rows]
        nth = nth[nth < self.most]
        full = nth == self.most - 1
        self.floor[self.rows[0][full]] = self.rows[1][full]


def _emitted(best: Best, keys: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    group, s, null, ids, own = best.rows
    cols = [k[group] for k in keys]
    return pa.RecordBatch.from_arrays([*[pa.array(c) for c in cols], pa.array(s), pa.array(ids, mask=null.astype(bool)),
                                       pa.array(own)], names)


def _tiles(anchors: list[Side]) -> Iterator[tuple[int, Side]]:
    """Tiles of anchors, each with the number of its first one."""
    at = 0
    for a in anchors:
        for k in range(0, len(a), ANCHORS):
            yield at + k, a.part(slice(k, k + ANCHORS))
        at += len(a)


def _positive_search(anchors: object) -> object:
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = anchors.value
        best = Best(sum(map(len, held)), POSITIVES)
        for batch in batches:
            for rows in sides(batch.columns):
                for at, a in _tiles(held):
                    for label in np.intersect1d(a.label, rows.label):
                        mine = np.flatnonzero(a.label == label)
                        one, other = a.part(mine), rows.part(rows.label == label)
                        mask = (one.ids[:, None] != other.ids) | other.null
                        high = np.full(len(one), _TOP)
                        mask = open_pairs(one, other, best.floor[at + mine].astype(float), high, mask)
                        best.add(at + mine, scores(one, other, mask), other)
        yield _emitted(best, [np.arange(len(best.floor))], ["anchor", "score", "id", "own"])
    return search


def _negative_search(anchors: object, wanted: object) -> object:
    """``wanted``: for each anchor POSITIVES lowest and highest scores."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, (low, high) = anchors.value, wanted.value
        best = Best(low.size, NEGATIVES)
        for batch in batches:
            for rows in sides(batch.columns):
                for at, a in _tiles(held):
                    here = slice(at, at + len(a))
                    floor = np.maximum(low[here], best.floor.reshape(low.shape)[here])
                    least = np.where(low[here] > high[here], np.inf, floor).min(axis=1)
                    mask = open_pairs(a, rows, least, high[here].max(axis=1).astype(float), a.label[:, None] != rows.label)
                    s = scores(a, rows, mask)
                    for nth in range(POSITIVES):
                        lo, hi = low[here, nth, None], high[here, nth, None]
                        group = np.arange(at, at + len(a)) * POSITIVES + nth
                        best.add(group, np.where((s >= lo) & (s <= hi), s, _NONE), rows)
        n = np.arange(low.size)
        yield _emitted(best, [n // POSITIVES, n % POSITIVES + 1], ["anchor", "nth", "score", "id", "own"])
    return search


def _first(found: DataFrame, by: list[str], most: int) -> DataFrame:
    """The first ``most`` rows of each group, numbered."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "own")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def _blocks(anchors: DataFrame) -> tuple[DataFrame, list[list[int]]]:
    """``anchors`` with a bucket, and the buckets of each block.  Buckets
    are small parts of a block, and their sizes are known before one is
    fetched."""
    size = F.octet_length("vec") + F.octet_length("sums") + 64
    total = anchors.agg(F.sum(size)).first()[0] or 0
    buckets = 16 * -(-total // BLOCK_BYTES)
    anchors = anchors.withColumn("bucket", F.pmod(F.xxhash64("id", "own"), F.lit(max(buckets, 1))))
    out: list[list[int]] = []
    room = 0
    for bucket, held in sorted(map(tuple, anchors.groupBy("bucket").agg(F.sum(size)).collect())):
        if held > room:
            out.append([])
            room = BLOCK_BYTES
        out[-1].append(bucket)
        room -= held
    return anchors, out


def _is_anchor(vec_id: Column) -> Column:
    return vec_id % QUERY_STEP == 0


def mine(rows: DataFrame) -> DataFrame:
    """Rows (vec_id, embedding, label) -> the negatives (rank, negative_id,
    negative_score) of each anchor (anchor_id) and positive (positive_rank,
    positive_id, positive_score)."""
    spark = rows.sparkSession
    table = packed(rows)
    searched = table.select("id", "label", "own", "vec", "sums")
    anchors, blocks = _blocks(common.written(searched.where(_is_anchor(F.col("id"))).dropDuplicates(["id", "own"]), "hn-anchors"))
    path = scratch_path(spark, "hn-hits")
    schema = ("anchor_id long, positive_rank int, positive_id long, positive_score long, "
              "rank int, negative_id long, negative_score long")
    spark.createDataFrame([], schema).write.parquet(path)
    for block in blocks:
        _mine_block(searched, anchors.where(F.col("bucket").isin(block)), path)
    return spark.read.schema(schema).parquet(path)


def _mine_block(searched: DataFrame, anchors: DataFrame, path: str) -> None:
    """Append the hits of one block of anchors to the table at ``path``."""
    spark = searched.sparkSession
    with common.batches_of(spark, ROWS):
        got = anchors.select(*searched.columns).toArrow()
        held = sides([got.column(c).combine_chunks() for c in searched.columns])
        ids = np.concatenate([a.ids for a in held])
        sent = [spark.sparkContext.broadcast(held)]
        found = searched.mapInArrow(_positive_search(sent[0]), "anchor long, score long, id long, own long")
        positives = common.written(_first(found, ["anchor"], POSITIVES), "hn-positives")
        # At most POSITIVES rows for each anchor of the block.
        low = np.full((len(ids), POSITIVES), _TOP)
        high = np.full((len(ids), POSITIVES), _NONE)
        known = positives.select("anchor", "rank", "score", "id").collect()
        for anchor, rank, score, _ in known:
            low[anchor, rank - 1] = -(-LEAST_SHARE * score // 100)
            high[anchor, rank - 1] = score
        sent.append(spark.sparkContext.broadcast((low, high)))
        found = searched.mapInArrow(_negative_search(*sent), "anchor long, nth long, score long, id long, own long")
        hits = _first(found, ["anchor", "nth"], NEGATIVES)
        named = spark.createDataFrame([(a, r, int(ids[a]), i, s) for a, r, s, i in known],
                                      "p_anchor long, p_nth long, anchor_id long, positive_id long, positive_score long")
        out = hits.join(F.broadcast(named), (F.col("anchor") == F.col("p_anchor")) & (F.col("nth") == F.col("p_nth")))
        out.select("anchor_id", F.col("nth").cast("int").alias("positive_rank"), "positive_id", "positive_score", "rank",
                   F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).write.mode("append").parquet(path)
        for b in sent:
            b.destroy()


def digest(rows: DataFrame) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id and both scores."""
    return mine(rows.select("vec_id", "embedding", "label")).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS alike, r.vec_id AS id,
         CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
  FROM rows a JOIN rows r ON a.vec_id IS DISTINCT FROM r.vec_id
  WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE alike
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
       s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.alike
 AND 80 * p.positive_score <= 100 * s.score AND 100 * s.score <= 100 * p.positive_score
QUALIFY rank <= 5
"""
