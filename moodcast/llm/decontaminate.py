"""Benchmark decontamination under edit distance.

Documents and benchmark items are word sequences (lower-cased, without
ASCII punctuation).  A document is contaminated by an item when some
window of it is within ``MAX_EDIT_SHARE`` of the item's words in edit
distance.  The search is by CGK embedding: a random walk copies the word
under a pointer and advances the pointer by a random bit of that word, so
that two sequences a few edits apart fall in step again and again, and
their embeddings differ in few places.  Repeated bit sampling over the
embeddings (``SAMPLES`` coordinates, ``WALKS`` walks from a window's start
and as many from its end) finds candidate windows, and each candidate is
verified by its exact edit distance.  A walk covers about ``ANCHOR`` words,
so walks start at every ``ANCHOR``-th word of an item, from its start and
from its end: a long item is found by any part that is like it.

Only windows that can match are embedded: one too poor in words of any
item has too many edits.  The same test on the part that a walk covers
is for walks from inside an item.  The items reach the
workers in blocks of at most ``BLOCK_STARTS`` starts of walks, which as
built take about 1.5 kB a start, or one item that has more.  One block is
searched in the one pass over the documents.  Of several blocks one at a
time is sent, while the driver holds the next: the rows are numbered and
written once, each pass reads the texts, writes its hits and gives its block
up; only hits are shuffled to their rows.

Defined results: null or empty texts match nothing; an item of fewer than
``MIN_WORDS`` words contaminates only a document that consists of it, as
shorter phrases occur by chance; items without words are ignored; each
row is judged by itself, repeated rows alike; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .words import word_hashes

MAX_EDIT_SHARE = 0.2
MIN_WORDS = 5

WALKS = 16
SAMPLES = 4
#: Steps of a walk for items of at least so many words.
CLASSES = ((12, 24), (MIN_WORDS, 9))
#: Words between the starts of walks in an item, as many as a walk covers.
ANCHOR = 12
SEED = 23

#: Bounds of one block: items (expected) and starts of walks.
BLOCK_ITEMS, BLOCK_STARTS = 2000, 1 << 14

_STEP = np.uint64(0x9E3779B97F4A7C15)
MATCH = "array<struct<item_id:long,start_word:int,n_words:int,distance:int,similarity:double>>"


def max_edits(n: int) -> int:
    return int(MAX_EDIT_SHARE * n + 1e-9)


def anchors(n: int) -> range:
    """The words of an item at which walks start."""
    return range(0, max(n - ANCHOR, 0) + 1, ANCHOR)


def best_window(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edit distance, start, end) of the window of ``text`` nearest to
    ``item``; of equals the first to end, then the longest."""
    m = len(text)
    at = np.arange(m + 1)
    # Cost and start of the best window that ends here, in one number; a
    # smaller start wins a tie.
    one = np.int64(m + 1)
    row = at.astype(np.int64)
    for i, w in enumerate(item, 1):
        new = row + one  # the item's word is missing
        np.minimum(new[1:], row[:-1] + np.where(text == w, 0, one), out=new[1:])
        # Extra words of the text: a running minimum less one cost a step.
        row = np.minimum.accumulate(new - at * one) + at * one
    end = int(np.argmin(row // one))
    return int(row[end] // one), int(row[end] % one), end


def _mixed(key: np.ndarray, word: np.ndarray) -> np.ndarray:
    x = (key ^ word) * _STEP
    return x ^ (x >> np.uint64(31))


@dataclass
class Walk:
    """One random walk and its sampled coordinates."""

    advance: np.ndarray  # a multiplier per step; the top bit of the product moves the pointer
    sampled: np.ndarray
    prefixes: np.ndarray | None = None  # of the items: which keys the first samples can have, in bits
    keys: np.ndarray | None = None  # of the items: sorted full keys
    items: np.ndarray | None = None
    skipped: np.ndarray | None = None  # words of the item before the start

    def embed(self, words: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sampled keys of the walks from positions ``at``; with the items'
        prefixes known, only those that can match: (index in at, key)."""
        own = np.arange(len(at))
        key = np.zeros(len(at), np.uint64)
        done = 0
        for j in range(int(self.sampled[-1]) + 1):
            w = words[at]
            if j == self.sampled[done]:
                key = _mixed(key, w)
                done += 1
                if self.prefixes is not None and done < len(self.sampled):
                    bit = key & np.uint64(8 * self.prefixes.shape[1] - 1)
                    held = self.prefixes[done - 1][bit >> np.uint64(3)]
                    live = (held >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0
                    own, key, at, w = own[live], key[live], at[live], w[live]
                if done == len(self.sampled) or not len(own):
                    break
            at = at + ((w * self.advance[j]) >> np.uint64(63)).astype(np.int64)
        return own, key


@dataclass
class Block:
    """A block of items, ready to be searched for."""

    ids: list[int | None]
    texts: list[str]
    words: list[np.ndarray] = field(init=False)
    vocabulary: np.ndarray = field(init=False)
    lengths: dict[int, list[int]] = field(init=False)
    walks: dict[tuple[int, bool], list[Walk]] = field(init=False)
    whole: dict[tuple[int, ...], list[int]] = field(init=False)

    def __post_init__(self) -> None:
        line, count = word_hashes(self.texts)
        self.words = np.split(line, np.cumsum(count)[:-1])
        self.vocabulary = np.zeros(1 << 20, bool)
        self.vocabulary[line >> np.uint64(44)] = True
        self.whole = {}
        for i, w in enumerate(self.words):
            if 0 < len(w) < MIN_WORDS:
                self.whole.setdefault(tuple(w.tolist()), []).append(i)
        rng = np.random.default_rng(SEED)
        self.lengths, self.walks = {}, {}
        top = 1 << 30
        for least, steps in CLASSES:
            own = [i for i, w in enumerate(self.words) if least <= len(w) < top]
            top = least
            self.lengths[least] = sorted({len(self.words[i]) for i in own}
                                         | {ANCHOR for i in own if len(anchors(len(self.words[i]))) > 1})
            for backward in (False, True):
                walks = [Walk(rng.integers(0, 1 << 63, steps, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
                              np.sort(rng.choice(steps, SAMPLES, replace=False))) for _ in range(WALKS)]
                if own:
                    for w in walks:
                        self._enter(w, [self.words[i][::-1] if backward else self.words[i] for i in own], own)
                self.walks[least, backward] = walks if own else []

    def _enter(self, walk: Walk, items: list[np.ndarray], own: list[int]) -> None:
        padded = np.concatenate([np.concatenate((h, np.zeros(1, np.uint64))) for h in items])
        first = np.cumsum([0] + [len(h) + 1 for h in items[:-1]])
        skipped = [np.array(anchors(len(h))) for h in items]
        starts = np.concatenate([f + a for f, a in zip(first, skipped, strict=True)])
        owner = np.repeat(own, [len(a) for a in skipped])
        size = 1 << max(12, (32 * len(starts)).bit_length())
        prefixes = np.zeros((SAMPLES - 1, size // 8), np.uint8)
        for n in range(1, SAMPLES):
            part = Walk(walk.advance, walk.sampled[:n])
            held = np.zeros(size, bool)
            held[part.embed(padded, starts)[1] & np.uint64(size - 1)] = True
            prefixes[n - 1] = np.packbits(held, bitorder="little")
        _, keys = Walk(walk.advance, walk.sampled).embed(padded, starts)
        order = np.argsort(keys, kind="stable")
        walk.keys, walk.items, walk.prefixes = keys[order], owner[order].astype(np.int32), prefixes
        walk.skipped = np.concatenate(skipped)[order].astype(np.int32)

    def possible(self, known: np.ndarray, least: int) -> np.ndarray:
        """Positions at which a matching window of some length can start:
        of its first L - k words at most k are in no item."""
        total = np.concatenate(([0], np.cumsum(known)))
        n = len(known)
        out = np.zeros(n, bool)
        for length in self.lengths[least]:
            k = max_edits(length)
            end = np.minimum(np.arange(n) + length - k, n)
            # Near the end of the text the rest of the window is deleted words.
            out |= total[end] - total[:-1] >= length - 2 * k
        return np.flatnonzero(out & known)

    def candidates(self, words: np.ndarray) -> np.ndarray:
        """Rows (item, position, from its end, words of the item before the
        position) over words with a 0 after each text; each once."""
        found = [np.zeros((0, 4), np.int64)]
        for backward in (False, True):
            # Reversed texts keep the 0 after each: the one before the first moves.
            line = np.concatenate((words[:-1][::-1], words[-1:])) if backward else words
            known = self.vocabulary[line >> np.uint64(44)] & (line != 0)
            for least, _ in CLASSES:
                walks = self.walks[least, backward]
                at = self.possible(known, least) if walks else np.zeros(0, np.int64)
                for walk in walks if len(at) else ():
                    own, key = walk.embed(line, at)
                    lo = np.searchsorted(walk.keys, key, "left")
                    size = np.searchsorted(walk.keys, key, "right") - lo
                    own, lo, size = own[size > 0], lo[size > 0], size[size > 0]
                    if not len(own):
                        continue
                    nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                    entry = np.repeat(lo, size) + nth
                    p = np.repeat(at[own], size)
                    found.append(np.stack((walk.items[entry], len(words) - 2 - p if backward else p,
                                           np.full(len(p), backward), walk.skipped[entry]), axis=1))
        return np.unique(np.concatenate(found), axis=0)

    @staticmethod
    def _rich(line: np.ndarray, want: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
        """Whether each place holds all but k of the item's distinct words,
        as any window within k edits does."""
        distinct = np.unique(want)
        out = np.zeros(len(places), bool)
        width = int((places[:, 2] - places[:, 1]).max())
        step = max(1, (1 << 19) // max(width, len(distinct)))
        for at in range(0, len(places), step):
            some = places[at:at + step]
            spot = some[:, 1:2] + np.arange(width)
            words = np.where(spot < some[:, 2:3], line[np.minimum(spot, len(line) - 1)], 0)
            nth = np.minimum(np.searchsorted(distinct, words), len(distinct) - 1)
            row, col = np.nonzero(distinct[nth] == words)
            seen = np.zeros((len(some), len(distinct)), bool)
            seen[row, nth[row, col]] = True
            out[at:at + step] = seen.sum(axis=1) >= len(distinct) - k
        return out

    def matches(self, texts: list[str | None]) -> list[list[dict]]:
        """The items that each text holds, best window each."""
        flat, count = word_hashes(texts)
        end = np.cumsum(count + 1) - 1  # of each text, with a 0 after it
        line = np.zeros(len(flat) + len(count), np.uint64)
        solid = np.ones(len(line), bool)
        solid[end] = False
        line[solid] = flat
        out: list[dict[int, tuple]] = [{} for _ in texts]
        found = self.candidates(line) if len(flat) else np.zeros((0, 4), np.int64)
        for item in np.unique(found[:, 0]):
            want = self.words[item]
            n, k = len(want), max_edits(len(want))
            own = found[found[:, 0] == item]
            backward = own[:, 2] > 0
            doc = np.searchsorted(end, own[:, 1])
            at = own[:, 1] + np.where(backward, own[:, 3], -own[:, 3])  # where the item's first or last word would be
            lo = np.maximum(np.where(backward, at - n - 2 * k, at - k), end[doc] - count[doc])
            hi = np.minimum(np.where(backward, at + 1 + k, at + n + 2 * k), end[doc])
            places = np.unique(np.stack((doc, lo, hi), axis=1), axis=0)
            for d, a, b in places[self._rich(line, want, places, k)].tolist():
                if out[d].get(int(item), (1,))[0] == 0:
                    continue  # no window is nearer
                cost, s, e = best_window(want, line[a:b])
                if cost <= k:
                    hit = (cost, int(a - end[d] + count[d]) + s, e - s)
                    out[d][int(item)] = min(out[d].get(int(item), hit), hit)
        if self.whole:
            for d in np.flatnonzero((count > 0) & (count < MIN_WORDS)):
                for item in self.whole.get(tuple(line[end[d] - count[d]:end[d]].tolist()), ()):
                    out[d][item] = (0, 0, int(count[d]))
        return [[{"item_id": self.ids[i], "start_word": s, "n_words": n, "distance": d,
                  "similarity": 1.0 - d / len(self.words[i])} for i, (d, s, n) in sorted(o.items())] for o in out]


def item_blocks(benchmark: DataFrame, max_items: int = BLOCK_ITEMS, max_starts: int = BLOCK_STARTS) -> Iterator[Block]:
    """The items in blocks of bounded size, however many items there are;
    each is built when it is asked for."""
    starts = (F.regexp_count("text", F.lit(common.WORD_PATTERN)) / ANCHOR).cast("long") + 1  # or more
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text", starts.alias("starts")).where(
        F.col("text").isNotNull())
    n, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum("starts"), F.lit(0))).collect()[0]
    parts = max(1, -(-n // max_items), -(-size // max_starts))
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        rows = sorted(rows, key=lambda r: (r["item_id"] is None, r["item_id"] or 0, r["text"]))
        block, held = [], 0
        for r in rows:  # the hash deals about max_starts to each part; the rest is another block
            if block and held + r["starts"] > max_starts:
                yield Block([b["item_id"] for b in block], [b["text"] for b in block])
                block, held = [], 0
            block.append(r)
            held += r["starts"]
        if block or parts == 1:
            yield Block([b["item_id"] for b in block], [b["text"] for b in block])


def _searcher(sent: Broadcast) -> Callable[[Iterator[pd.Series]], Iterator[pd.Series]]:
    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(sent.value.matches([t if isinstance(t, str) else None for t in texts]))

    return search


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with ``dc_matches``: the items found in each text, with the
    window (first word, words), distance and similarity."""
    spark = docs.sparkSession
    common.prepare(spark)

    def search(block: Block) -> tuple[Broadcast, Column]:
        sent = spark.sparkContext.broadcast(block)
        return sent, F.pandas_udf(_searcher(sent), MATCH)("text")

    blocks = item_blocks(benchmark)
    block, after = next(blocks), next(blocks, None)
    if after is None:
        return docs.withColumn("dc_matches", search(block)[1])
    rows = common.written(docs.select(common.row_struct(docs).alias("dc_row"), "text",
                                      F.monotonically_increasing_id().alias("dc_id")), "dc-rows")
    hits = None
    while block is not None:
        sent, found = search(block)
        got = common.written(rows.select("dc_id", found.alias("dc_found")).where(F.size("dc_found") > 0), "dc-hits")
        sent.destroy()
        hits = got if hits is None else hits.unionByName(got)
        block, after = after, next(blocks, None)
    hits = hits.groupBy(F.col("dc_id").alias("dc_hit")).agg(F.flatten(F.collect_list("dc_found")).alias("dc_found"))
    rows = rows.join(hits, rows["dc_id"] == hits["dc_hit"], "left")
    matches = F.coalesce("dc_found", F.array().cast(MATCH))
    return rows.select(*common.unpacked(docs, "dc_row", {"dc_matches": F.array_sort(matches)}))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any match, columns unchanged."""
    rows = leaks(docs.select(common.row_struct(docs).alias("dc_row"), "text"), benchmark)
    return rows.where(F.size("dc_matches") == 0).select("dc_row.*")


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it."""
    rows = leaks(docs.select("doc_id", "text"), benchmark)
    return rows.select("doc_id", F.explode("dc_matches").alias("m")).select("doc_id", "m.*")
