"""Near-duplicate documents by SimHash and meet-in-the-middle balls.

A document's fingerprint has a bit set where over half of its shingles'
hashes have it set.  Fingerprints link when at most ``RADIUS`` = 3 bits
differ, and documents belong to the connected components of the links.

Every distinct fingerprint emits the variants within half the radius: all
at one flipped bit (near), itself and those at two flipped bits (far).
Two bits need to be flipped only within one half of the 64, and only in
the low half where the number of set bits is even, in the high half where
it is odd.  That loses no link:

* at distance 1 or 3 one of the two is even and one is odd, and two of
  three bits are in the same half.  Whichever of the two owns that half
  flips them (at distance 1: none) and meets the other's flip of the one
  bit left;
* at distance 2 both flip one of the bits and meet.

So 561 variants do the work of 2081.  Variants are shuffled on their
value; one value holds each fingerprint once and so never more than its
own ball, whatever the number of documents.  A value's members are within
RADIUS of each of its near members, so a star around one of those joins
all of them.  The star's links are deduplicated and verified.  Variants
travel as their value and the number of the flip, which gives the
fingerprint back.

Defined results: a null or empty text, or one of white space only, has
fingerprint zero and links like any other; rows that share a ``doc_id``
are documents of their own; a component's id is the smallest ``doc_id`` in
it, null where all are null; other columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from . import common
from .components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64

#: Words of a text that are hashed at once.
CHUNK = 1 << 16
#: Variants of one Arrow batch.
ROWS = 1 << 16


def _flips() -> np.ndarray:
    """The flips by number: none, each bit, pairs in the low, in the high half."""
    bit = [1 << i for i in range(BITS)]
    half = BITS // 2
    pairs = [[bit[i] | bit[j] for i in range(at, at + half) for j in range(i + 1, at + half)] for at in (0, half)]
    return np.array([0, *bit, *pairs[0], *pairs[1]], np.uint64)


FLIPS = _flips()
_PAIRS = (len(FLIPS) - 1 - BITS) // 2
#: Numbers of the flips of even and of odd fingerprints.
EVEN = np.arange(1 + BITS + _PAIRS)
ODD = np.concatenate((EVEN[:1 + BITS], EVEN[1 + BITS:] + _PAIRS))


def fingerprint(text: str | None) -> int:
    """The fingerprint of one whole text, read in chunks of words."""
    left = (text or "").encode("utf-8", "surrogatepass").lower()
    total, n, before = np.zeros(BITS, np.int64), 0, []
    while left:
        words = left.split(None, CHUNK)
        left = words.pop() if len(words) > CHUNK else b""
        words = before + words
        before = words[len(words) - SHINGLE + 1:] if len(words) >= SHINGLE else words
        if len(words) < SHINGLE and (n or left or not words):
            continue
        line = b" ".join(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        start = np.cumsum(size + 1) - size - 1
        last = min(SHINGLE, len(words)) - 1
        ends = (start + size)[last:].tolist()
        shingles = [line[a:b] for a, b in zip(start.tolist(), ends, strict=False)]
        h = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), np.uint64, len(shingles))
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(shingles)
    return int(np.packbits(2 * total > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series(np.array([fingerprint(t if isinstance(t, str) else None) for t in texts], np.uint64).view(np.int64))


def _variant_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = batch.column(0).to_numpy().view(np.uint64)
        odd = (np.bitwise_count(own) & 1).astype(bool)
        for some, flips in ((own[~odd], EVEN), (own[odd], ODD)):
            made = (some[:, None] ^ FLIPS[flips]).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(made), pa.array(np.tile(flips, len(some)).astype(np.int16))],
                                             ["variant", "flip"])


def _stars(variant: np.ndarray, flip: np.ndarray) -> pa.RecordBatch:
    """Links of the groups of equal values in sorted ``variant``."""
    new = np.concatenate(([True], variant[1:] != variant[:-1]))
    single = new & np.concatenate((new[1:], [True]))
    variant, flip, new = variant[~single], flip[~single], new[~single]
    if not len(variant):
        return pa.RecordBatch.from_arrays([pa.array([], pa.int64())] * 2, ["u", "v"])
    start = np.flatnonzero(new)
    own = variant.view(np.uint64) ^ FLIPS[flip]
    near = (flip >= 1) & (flip <= BITS)
    # The centre: the near member of the largest flip number.
    centre = np.maximum.reduceat(np.where(near, flip, 0), start)[np.cumsum(new) - 1]
    u = variant.view(np.uint64) ^ FLIPS[centre]
    kept = (centre > 0) & (u != own)
    return pa.RecordBatch.from_arrays([pa.array(x[kept].view(np.int64)) for x in (u, own)], ["u", "v"])


def _star_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    variant, flip = np.zeros(0, np.int64), np.zeros(0, np.int16)
    for batch in batches:  # the last value of a batch may go on in the next one
        variant = np.concatenate((variant, batch.column(0).to_numpy()))
        flip = np.concatenate((flip, batch.column(1).to_numpy()))
        cut = np.searchsorted(variant, variant[-1]) if len(variant) else 0
        if cut:
            yield _stars(variant[:cut], flip[:cut])
            variant, flip = variant[cut:], flip[cut:]
    if len(variant):
        yield _stars(variant, flip)


def links(prints: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) -> verified links (u, v) that join all
    that are within RADIUS of each other."""
    spark = prints.sparkSession
    common.prepare(spark)
    with common.batches_of(spark, ROWS):
        # A fingerprint becomes hundreds of rows, so few go to each task.
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        made = prints.select("fp").repartition(parts, "fp").mapInArrow(_variant_batches, "variant long, flip short")
        met = made.repartition("variant").sortWithinPartitions("variant").mapInArrow(_star_batches, "u long, v long")
        met = met.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        return common.written(met.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= RADIUS), "sh-links")


def component_ids(prints: DataFrame) -> DataFrame:
    """(id, fp) of every document -> (fp, component): the smallest id in
    the component of each fingerprint."""
    nodes = common.written(prints.groupBy("fp").agg(F.min("id").alias("id")), "sh-nodes")
    label = components(links(nodes)).withColumnRenamed("label", "l")
    labelled = nodes.join(label, nodes["fp"] == label["node"], "left").select("fp", "id", F.coalesce("l", "fp").alias("l"))
    least = labelled.groupBy("l").agg(F.min("id").alias("component"))
    return labelled.drop("id").join(least, "l").select("fp", "component")


def _joined(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` (fp, ...) with ``component``; a hot fingerprint can be split."""
    found = common.rekeyed(found, ["fp"], "k_").select("k_fp", "component")
    return common.rekeyed(rows, ["fp"], "k_").join(found, "k_fp").drop("k_fp")


def _prints(docs: DataFrame) -> DataFrame:
    common.prepare(docs.sparkSession)
    return common.written(docs.select(F.col("doc_id").alias("id"), F.pandas_udf(_fingerprints, "long")("text").alias("fp")), "sh-prints")


def with_components(docs: DataFrame) -> DataFrame:
    """``docs`` with ``sh_fingerprint`` (long) and ``sh_component``, the
    smallest ``doc_id`` of the row's component."""
    found = component_ids(_prints(docs))
    rows = docs.select(common.row_struct(docs).alias("sh_row"), F.pandas_udf(_fingerprints, "long")("text").alias("fp"))
    added = {"sh_fingerprint": F.col("fp"), "sh_component": F.col("component")}
    return _joined(rows, found).select(*common.unpacked(docs, "sh_row", added))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every document."""
    prints = _prints(docs)
    return _joined(prints, component_ids(prints)).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"))
