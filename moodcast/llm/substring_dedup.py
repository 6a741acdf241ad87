"""Repeated passages by hashing of units of lines.

The units are the sentences of each line, and the tails of sentences from
a word with a capital on, so that a passage set into the middle of a
sentence is met too.  Units are normalised (ASCII lower case, one space
between words), named, and grouped globally; the earliest occurrence by
(doc_id, offset) stays and all others go.  Removed spans are kept as
offsets in code points of the original text.

Only (name, document, span) rows are shuffled, once to find the earliest
document of a name and once to meet it; names are counted before the
shuffle.  The texts meet their removed spans once, by document.

Defined results: a null or empty text has no units; units of fewer than
``MIN_CHARS`` code points or ``MIN_WORDS`` words are too common to count,
but go where they lie between two removed units; a repeat inside a
document goes as well; rows that share a ``doc_id`` are of one rank and
leave each other alone; a null ``doc_id`` ranks last; other columns pass
through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .words import hashed_words, mixed

MIN_CHARS = 25
MIN_WORDS = 4
#: Ids up to the last long that stand for null ones.
LAST, NULL_IDS = (1 << 63) - 1, 1 << 61

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_STEP = np.uint64(0x9E3779B97F4A7C15)
_FACTORS = (0xD1342543DE82EF95, 0xAF251AF3B0F025B5)  # odd


def _tail_sums(words: np.ndarray, first: np.ndarray, last: np.ndarray, factor: int) -> np.ndarray:
    """A hash of the word sequence first..last (inclusive) of each unit,
    the same at any place: differences of running sums."""
    up = np.full(len(words) + 1, factor, np.uint64)
    down = np.full(len(words) + 1, pow(factor, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * up[:-1])))
    return mixed((sums[last + 1] - sums[first]) * down[first] + (last - first).astype(np.uint64) * _STEP)


def _capital(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether a Latin, Greek or Cyrillic capital is at each byte offset."""
    a, b = data[at], data[np.minimum(at + 1, len(data) - 1)]
    return ((a >= 65) & (a <= 90) | (a == 0xC3) & (b >= 0x80) & (b <= 0x9E)
            | (a == 0xCE) & (b >= 0x91) & (b <= 0xA9) | (a == 0xD0) & (b >= 0x90) & (b <= 0xAF))


def units(texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """(text number, start, length, name, second name) of every unit of a
    batch, in order; offsets in code points."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    joined = b"\n".join(raw) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    first, last, words = hashed_words(np.frombuffer(joined.translate(_LOWER), np.uint8))
    if not len(words):
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 2
    points = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    lines = np.concatenate(([0], np.cumsum(data == 10)))
    mark = data[last - 1]
    ends = (mark == 46) | (mark == 33) | (mark == 63)
    ends[:-1] |= lines[first[1:]] > lines[last[:-1]]
    ends[-1] = True
    end_of = np.flatnonzero(ends)[np.searchsorted(np.flatnonzero(ends), np.arange(len(words)))]
    begins = np.concatenate(([True], ends[:-1])) | _capital(data, first)
    chars = np.concatenate(([0], np.cumsum(points[last] - points[first] + 1)))
    begin = np.flatnonzero(begins)
    end = end_of[begin]
    solid = (chars[end + 1] - chars[begin] - 1 >= MIN_CHARS) & (end - begin + 1 >= MIN_WORDS)
    begin, end = begin[solid], end[solid]
    size = np.array([len(b) + 1 for b in raw])
    text_at = np.cumsum(size) - size
    own = np.searchsorted(text_at, first[begin], "right") - 1
    start = points[first[begin]] - points[text_at[own]]
    return (own, start, points[last[end]] - points[first[begin]],
            *(_tail_sums(words, begin, end, f) for f in _FACTORS))


def _unit_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(n1, n2, did, thash, at); at packs start and length.  Repeats inside
    a text have null names: they go whatever other texts hold."""
    for rows in batches:
        own, start, length, n1, n2 = units([t if isinstance(t, str) else None for t in rows["text"]])
        apart = mixed(n1 + own.astype(np.uint64) * _STEP) ^ n2
        _, where = np.unique(apart, return_index=True)
        again = np.ones(len(own), bool)
        again[where] = False
        named = [pd.array(np.where(again, 0, n.view(np.int64)), "Int64") for n in (n1, n2)]
        for n in named:
            n[again] = pd.NA
        yield pd.DataFrame({"n1": named[0], "n2": named[1], "did": rows["did"].to_numpy()[own],
                            "thash": rows["thash"].to_numpy()[own], "at": start << 32 | length})


def merged(at: list[int], most_gap: int = MIN_CHARS) -> list[tuple[int, int]]:
    """Packed spans as disjoint (start, end); gaps shorter than a unit are
    closed."""
    out: list[list[int]] = []
    for a in sorted(at):
        lo, hi = a >> 32, (a >> 32) + (a & 0xFFFFFFFF)
        if out and lo - out[-1][1] < most_gap:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


_CUT = "text string, removed array<struct<start:long,end:long>>, n_chars long, n_removed long"


def _cut(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = []
    for t, s in zip(text, spans, strict=True):
        gone = merged([int(a) for a in s]) if s is not None else []
        whole = t if isinstance(t, str) else ""
        bounds = [0, *(p for span in gone for p in span), len(whole)]
        kept = "".join(whole[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
        out.append((kept if isinstance(t, str) else None, [{"start": a, "end": b} for a, b in gone], len(whole),
                    sum(b - a for a, b in gone)))
    return pd.DataFrame(out, columns=["text", "removed", "n_chars", "n_removed"])


def repeated_units(rows: DataFrame) -> DataFrame:
    """Rows (did, thash, text) -> (did, thash, spans) of texts that lose
    anything."""
    found = common.written(rows.mapInPandas(_unit_batches, "n1 long, n2 long, did long, thash long, at long"),
                           "ss-units")
    named = found.where(F.col("n1").isNotNull())
    heads = (named.groupBy("n1", "n2").agg(F.min("did").alias("head"), F.max("did").alias("last"))
             .where(F.col("last") > F.col("head")))
    heads = common.rekeyed(heads, ["n1", "n2"], "k_").select("k_n1", "k_n2", "head")
    gone = (common.rekeyed(named, ["n1", "n2"], "k_").join(heads, ["k_n1", "k_n2"])
            .where(F.col("did") > F.col("head")).select("did", "thash", "at"))
    inside = found.where(F.col("n1").isNull()).select("did", "thash", "at")
    return gone.unionByName(inside).groupBy("did", "thash").agg(F.collect_set("at").alias("spans"))


def dedup_passages(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` less its repeated units, and ``ss``: a struct
    of the removed spans, n_chars and n_removed."""
    common.prepare(docs.sparkSession)
    # Null ids rank last, each text by a hash of its own.
    own = F.lit(LAST) - F.xxhash64(F.lit("id"), F.col("text").isNull(), F.col("text")).bitwiseAND(F.lit(NULL_IDS - 1))
    did = F.coalesce(F.col("doc_id").cast("long"), own)
    thash = common.row_hash(F.col("text"))
    spans = repeated_units(docs.select(did.alias("did"), thash.alias("thash"), "text"))
    rows = docs.select(common.row_struct(docs).alias("ss_row"), did.alias("did"), thash.alias("thash"))
    cut = F.pandas_udf(_cut, _CUT)
    out = (rows.join(spans, ["did", "thash"], "left")
           .select("ss_row", cut(F.col("ss_row.text"), F.col("spans")).alias("ss_cut")))
    added = {"text": F.col("ss_cut.text"), "ss": F.struct("ss_cut.removed", "ss_cut.n_chars", "ss_cut.n_removed")}
    return out.select(*common.unpacked(docs, "ss_row", added))


def digest(docs: DataFrame) -> DataFrame:
    """One row per document: sizes, the removed spans and the kept text."""
    return dedup_passages(docs.select("doc_id", "text")).select(
        "doc_id", "ss.n_chars", "ss.n_removed", F.size("ss.removed").cast("long").alias("n_spans"), "ss.removed", "text")
