"""Repeated byte strings, by sorting a sampled cover of the suffixes.

A byte is removed when it lies in a ``LENGTH``-byte string that starts
anywhere else too.  As in the difference-cover construction, only a sample
of the suffixes is named first, and the rest are placed by their nearest
sampled suffix:

* cover: in every LENGTH-byte string the smallest hash of its GRAM-byte
  substrings is sampled.  Equal strings sample the same place, so the
  sample covers every pair of equal strings, as residues of a difference
  cover do, with one sampled suffix in about sixty instead of two in three;
* names: each sampled suffix is named by its gram, and once more together
  with the stretch of starting places that it stands for (their
  ``context``).  Unique grams end here, as no suffix that they stand for
  can have an equal; equal contexts settle all their suffixes at once;
* recursion: only contexts that differ under one repeated gram go on, one
  copy of each.  Their suffixes are merged by (gram, distance to the
  sampled place, prefix) and adjacent ones compared.

Names are 64-bit hashes, two per string.  Contexts of one gram meet in one
task only up to ``GROUP_CONTEXTS``; beyond, their suffixes are counted row
by row, which splits any number of them.

Defined results: a null text is empty; matches never cross documents, and
may lie in one document; rows that agree in ``doc_id`` and text are
documents of their own, so both lose what they share; texts shorter than
LENGTH bytes keep everything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .words import mixed

LENGTH = 200
GRAM = 56
WINDOW = LENGTH - GRAM + 1
#: Contexts of one gram that one task compares (about 300 bytes and 70
#: suffixes each), and bytes read at a time.
GROUP_CONTEXTS = 16_384
SLICE = 4 << 20

_RNG = np.random.default_rng(41)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_STEP = np.uint64(0x9E3779B97F4A7C15)
_INDEX_BITS = 28
#: Ids from the lowest long on that stand for null ones.
LOWEST, NULL_IDS = -(1 << 63), 1 << 61


def _composed(length: int, one: np.ndarray, join) -> np.ndarray:
    """The value of every substring of ``length`` from those of length 1,
    ``join(left, right, right's length)``, by doubling."""
    out, size, cur, k = None, 0, one, 1
    while True:
        if length & k:
            if out is None:
                out, size = cur, k
            else:
                n = max(min(len(out), len(cur) - size), 0)
                out, size = join(out[:n], cur[size:size + n], k), size + k
        if 2 * k > length:
            return out
        n = max(len(cur) - k, 0)
        cur, k = join(cur[:n], cur[k:k + n], k), 2 * k


def _poly(left: np.ndarray, right: np.ndarray, k: int) -> np.ndarray:
    return left * np.uint64(pow(_BASE, k, 1 << 64)) + right


def hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of every substring of ``length`` bytes."""
    if len(data) < length:
        return np.zeros(0, np.uint64)
    return mixed(_composed(length, _BYTE[data], _poly))


def covers(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """The sampled places of the strings from ``starts`` (rising): for each
    stretch of starts with one sampled place its first and last start, the
    place, the gram's name and the context's name."""
    gram = hashes(data, GRAM)
    # Order of the sample: the top bits of the name, then the place.
    packed = gram >> np.uint64(_INDEX_BITS) << np.uint64(_INDEX_BITS) | np.arange(len(gram), dtype=np.uint64)
    least = _composed(WINDOW, packed, lambda a, b, _: np.minimum(a, b))
    place = (least[starts] & np.uint64((1 << _INDEX_BITS) - 1)).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)
    at = np.flatnonzero(new)
    lo, hi = starts[at], starts[np.append(at[1:], len(starts)) - 1]
    place = place[at]
    whole = hashes(data, LENGTH)
    context = mixed(whole[lo] * _STEP + whole[hi] + ((hi - lo) * 256 + place - lo).astype(np.uint64) * _STEP)
    return lo, hi, place, gram[place], context


def _runs(text: bytes) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    """The covers of a text, slice by slice."""
    for at in range(0, max(len(text) - LENGTH + 1, 0), SLICE):
        data = np.frombuffer(text[at:at + SLICE + LENGTH - 1], np.uint8)
        yield at, covers(data, np.arange(len(data) - LENGTH + 1))


def _encoded(rows: pd.DataFrame) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in rows["text"]]


def _run_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(did, thash, gram, context, at): at packs the first start, the
    distance to the sampled place and the number of further starts."""
    for rows in batches:
        texts = _encoded(rows)
        size = np.array([len(b) for b in texts], np.int64)
        done = np.flatnonzero(size >= LENGTH)
        small = done[size[done] <= SLICE]
        parts = []
        group: list[int] = []
        total = 0
        # Short texts together, up to a slice; long ones by themselves.
        for i in [*small.tolist(), -1]:
            if i < 0 or total + size[i] > SLICE:
                if group:
                    start = np.cumsum([0] + [int(size[g]) for g in group[:-1]])
                    data = np.frombuffer(b"".join(texts[g] for g in group), np.uint8)
                    n = size[group] - LENGTH + 1
                    starts = np.arange(n.sum()) + np.repeat(start - (np.cumsum(n) - n), n)
                    lo, hi, place, gram, context = covers(data, starts)
                    own = np.searchsorted(start, lo, "right") - 1
                    parts.append((np.array(group)[own], gram, context, lo - start[own], place - lo, hi - lo))
                group, total = [], 0
            if i >= 0:
                group.append(i)
                total += int(size[i])
        for i in done[size[done] > SLICE]:
            for at, (lo, hi, place, gram, context) in _runs(texts[i]):
                parts.append((np.full(len(lo), i), gram, context, lo + at, place - lo, hi - lo))
        did, thash = rows["did"].to_numpy(), rows["thash"].to_numpy()
        for own, gram, context, lo, to_place, more in parts:
            yield pd.DataFrame({"did": did[own], "thash": thash[own], "gram": gram.view(np.int64),
                                "context": context.view(np.int64), "at": lo << 16 | to_place << 8 | more})


def _context_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The bytes of the wanted contexts of each text."""
    for rows in batches:
        out = {c: [] for c in ("gram", "did", "thash", "at", "open", "bytes")}
        for text, did, thash, wanted in zip(_encoded(rows), rows["did"], rows["thash"], rows["wanted"], strict=True):
            for w in wanted:
                lo, more = w["at"] >> 16, w["at"] & 255
                values = (w["gram"], did, thash, w["at"], w["open"], text[lo:lo + more + LENGTH])
                for c, v in zip(out, values, strict=True):
                    out[c].append(v)
        yield pd.DataFrame(out)


def _suffix_names(parts: list[bytes], at: np.ndarray, gram: np.ndarray
                  ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all starts of the contexts ``parts``: the context, the start in
    it, and two names of (gram, distance to the sampled place, prefix)."""
    n = (at & 255) + 1
    own = np.repeat(np.arange(len(parts)), n)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
    begin = np.cumsum([0] + [len(p) for p in parts[:-1]])
    data = np.frombuffer(b"".join(parts), np.uint8)
    prefix = hashes(data, LENGTH)[begin[own] + nth] if len(own) else np.zeros(0, np.uint64)
    distance = (((at >> 8) & 255)[own] - nth).astype(np.int64).view(np.uint64)
    first = mixed(prefix * _STEP + distance * np.uint64(977) + gram.view(np.uint64)[own])
    return own, nth, first, mixed(prefix ^ (first * _STEP))


def _group_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows hold all contexts of a gram: merge their suffixes and compare
    adjacent ones; spans of repeated suffixes of the open contexts."""
    for rows in batches:
        members = [m for group in rows["members"] for m in group]
        gram = np.repeat(rows["gram"].to_numpy(), [len(g) for g in rows["members"]])
        at = np.array([m["at"] for m in members], np.int64)
        own, nth, name, _ = _suffix_names([bytes(m["bytes"]) for m in members], at, gram)
        order = np.argsort(name, kind="stable")
        same = name[order[1:]] == name[order[:-1]]
        twice = np.zeros(len(name), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        twice &= np.array([m["open"] for m in members], bool)[own] if len(own) else False
        hit = np.flatnonzero(twice)
        new = np.ones(len(hit), bool)
        new[1:] = (own[hit[1:]] != own[hit[:-1]]) | (hit[1:] != hit[:-1] + 1)
        begin = np.flatnonzero(new)
        last = np.append(begin[1:], len(hit)) - 1
        who, lo = own[hit[begin]], nth[hit[begin]] + (at >> 16)[own[hit[begin]]]
        yield pd.DataFrame({"did": np.array([m["did"] for m in members], np.int64)[who],
                            "thash": np.array([m["thash"] for m in members], np.int64)[who],
                            "at": lo << 16 | (nth[hit[last]] - nth[hit[begin]])})


def _row_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Every suffix of the contexts as a row of its own."""
    for rows in batches:
        at = rows["at"].to_numpy()
        own, nth, a, b = _suffix_names([bytes(x) for x in rows["bytes"]], at, rows["gram"].to_numpy())
        yield pd.DataFrame({"n1": a.view(np.int64), "n2": b.view(np.int64), "did": rows["did"].to_numpy()[own],
                            "thash": rows["thash"].to_numpy()[own], "at": (nth + (at >> 16)[own]) << 16,
                            "open": rows["open"].to_numpy()[own]})


def _merged(text: bytes, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed spans as maximal, disjoint [start, end) runs."""
    lo = np.sort(at)
    end = np.maximum.accumulate((lo >> 16) + (lo & 255) + LENGTH)
    lo = lo >> 16
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > end[:-1]
    first = np.flatnonzero(new)
    return lo[first], end[np.append(first[1:], len(lo)) - 1]


def _cut(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = {c: [] for c in ("n_bytes", "n_removed", "starts", "ends", "kept")}
    for t, s in zip(text, spans, strict=True):
        raw = t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b""
        lo, hi = _merged(raw, np.asarray(s, np.int64)) if s is not None and len(s) else (np.zeros(0, np.int64),) * 2
        bounds = [0, *np.stack((lo, hi), axis=1).ravel().tolist(), len(raw)]
        kept = b"".join(raw[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
        for c, v in zip(out, (len(raw), int((hi - lo).sum()), lo, hi, kept), strict=True):
            out[c].append(v)
    return pd.DataFrame(out)


def repeated_spans(rows: DataFrame, group_contexts: int = GROUP_CONTEXTS) -> DataFrame:
    """Rows (did, thash, text) -> (did, thash, spans): packed spans of
    repeated strings of every text that has any."""
    runs = rows.mapInPandas(_run_batches, "did long, thash long, gram long, context long, at long")
    # Grams that occur once end here.
    grams = (runs.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("low"),
                                      F.max("context").alias("high")).where("n > 1"))
    grams = common.rekeyed(grams, ["gram"], "k_").select("k_gram", (F.col("low") == F.col("high")).alias("alike"))
    again = common.rekeyed(runs, ["gram"], "k_").join(grams, "k_gram").drop("k_gram")
    again = common.written(again, "sd-again")
    settled = again.where("alike").select("did", "thash", "at")
    # Grams with different contexts: each context's copies, and one of them.
    mixed_up = again.where(~F.col("alike"))
    kinds = mixed_up.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("did", "thash", "at")).alias("one"))
    sizes = kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"))
    sizes = common.rekeyed(sizes, ["gram"], "s_").select("s_gram", "kinds")
    kinds = common.rekeyed(kinds, ["gram", "context"], "k_").select("k_gram", "k_context", "n", "one")
    told = common.rekeyed(mixed_up, ["gram", "context"], "k_").join(kinds, ["k_gram", "k_context"])
    told = common.rekeyed(told, ["gram"], "s_").join(sizes, "s_gram")
    told = common.written(told.select("did", "thash", "gram", "at", (F.col("n") == 1).alias("open"),
                                      (F.struct("did", "thash", "at") == F.col("one")).alias("first"),
                                      (F.col("kinds") > group_contexts).alias("alone")), "sd-told")
    settled = settled.unionByName(told.where(~F.col("open")).select("did", "thash", "at"))
    need = told.where("open or first")
    grouped = (_contexts(rows, need.where(~F.col("alone"))).groupBy("gram")
               .agg(F.collect_set(F.struct("did", "thash", "at", "open", "bytes")).alias("members"))
               .mapInPandas(_group_batches, "did long, thash long, at long"))
    each = _contexts(rows, need.where("alone")).mapInPandas(
        _row_batches, "n1 long, n2 long, did long, thash long, at long, open boolean")
    twice = each.groupBy("n1", "n2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    twice = common.rekeyed(twice, ["n1", "n2"], "k_").select("k_n1", "k_n2")
    each = common.rekeyed(each.where("open"), ["n1", "n2"], "k_").join(twice, ["k_n1", "k_n2"]).select(
        "did", "thash", "at")
    return (settled.unionByName(grouped).unionByName(each)
            .groupBy("did", "thash").agg(F.collect_set("at").alias("spans")))


def _contexts(rows: DataFrame, need: DataFrame) -> DataFrame:
    wanted = need.groupBy("did", "thash").agg(F.collect_set(F.struct("gram", "at", "open")).alias("wanted"))
    return rows.join(wanted, ["did", "thash"]).mapInPandas(
        _context_batches, "gram long, did long, thash long, at long, open boolean, bytes binary")


def keyed(docs: DataFrame) -> DataFrame:
    """(did, thash, text): rows that share a doc_id are told apart by a
    64-bit hash of their texts; rows with a null one by a second hash as
    well, which is their id, below all others.  Rows alike in id and text
    have the same spans."""
    own = F.lit(LOWEST) + F.xxhash64(F.lit("id"), F.col("text").isNull(), F.col("text")).bitwiseAND(F.lit(NULL_IDS - 1))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), own).alias("did"),
                       common.row_hash(F.col("text")).alias("thash"), "text")


_CUT = "n_bytes long, n_removed long, starts array<long>, ends array<long>, kept binary"


def removed(docs: DataFrame, group_contexts: int = GROUP_CONTEXTS) -> DataFrame:
    """(did, thash, sd) for every row of ``docs`` (doc_id, text): sd is a
    struct of n_bytes, n_removed, the removed runs (starts, ends, in bytes)
    and the kept bytes."""
    common.prepare(docs.sparkSession)
    rows = keyed(docs)
    spans = repeated_spans(rows, group_contexts)
    # The texts are shuffled by document once, here and for the contexts.
    return rows.join(spans, ["did", "thash"], "left").select(
        "did", "thash", F.pandas_udf(_cut, _CUT)("text", "spans").alias("sd"))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, one row per document."""
    return removed(docs.select("doc_id", "text")).select(
        F.when(F.col("did") >= LOWEST + NULL_IDS, F.col("did")).alias("doc_id"), "sd.n_bytes", "sd.n_removed",
        F.size("sd.starts").cast("long").alias("n_spans"), F.sha2("sd.kept", 256).alias("kept_sha256"))
