"""Near-duplicate documents by order MinHash.

A document's shingles are labelled with their occurrence numbers; they
have one to three words, by the length of the text (``SIZES``), as edits
leave few long shingles of a short text whole.  Each of ``SKETCHES`` hash functions picks the ``PICKED``
smallest labelled shingles and keeps them in the order of the text, so
that two documents agree on a sketch in proportion to their edit
similarity.  Sizes and number of the sketches are chosen so that at least
99 % of the pairs at MIN_SIMILARITY agree on one, with the edits at random
places.  Documents of like length that agree on a sketch share a bucket.  A pair is linked when a banded alignment of the whole word
sequences finds an edit similarity of ``MIN_SIMILARITY`` or more, and
classes are the connected components of the links.

Every pair of a bucket is settled.  The members of a bucket of up to SMALL
are all compared with each other.  Those of a larger one are first held
against the bucket's representative, those that are no match among each
other again, as long as that links many.  The members of larger buckets that
are not in one component by then meet once more by a second, exact key: two texts within
MIN_SIMILARITY share all but so many words as they may have edits, so of
the words of either, in one order for all and the rarest first, one is
shared among the first edits + 1.  Words that many texts have, such as a
template's, come late in that order and make no keys, so different texts
on one template are not compared.  Of those that meet, a pair is looked at
only if the signatures of its texts, one parity bit for each of BITS
values that a word's hash may take, differ in at most two bits an edit.
Texts too long for that meet where they share a bucket's representative
instead, if a finer signature allows a match.  Each pair is looked at once, and its words are brought together only if the
signatures allow a match.

Equal word sequences are one node from the start, so copies are never
compared.  Buckets are counted before the shuffle and joined with their
representative, never gathered.

Defined results: words are lower-cased and without ASCII punctuation; a
text without words is a class of its own; documents shorter than a
shingle have one shingle, all their words; rows that share a ``doc_id``
are one document and so in one class; rows with a null ``doc_id`` are
nodes by their text and give a class its id only where it has no other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .components import components
from .words import mixed, word_hashes

SHINGLE = 5
MIN_SIMILARITY = 0.8
SKETCHES, PICKED = 48, 2
#: Length classes are so many factors of MIN_SIMILARITY wide.
WIDTH = 3
#: Words of a shingle from a length class on: up to 7 words, to 55, and more.
SIZES = ((0, 1), (3, 2), (6, 3))
SEED = 31

#: Buckets of so many members are settled pair by pair.
SMALL = 8

#: Representatives are tried on while they link this share of the pairs.
LINKED_SHARE = 0.1

#: Bits of a signature; those of an entry by word are half as many, as two
#: values each go together, and tell texts of up to SIGNED words apart.
BITS, SIGNED = 1024, 500
SIGNATURE = [f"s{i}" for i in range(BITS // 64)]
FOLDED = [f"f{i}" for i in range(BITS // 128)]
#: Bits of the finer signature of texts that BITS are too few for.
FINE_BITS = 8192
#: Words are read for their pairs alone where those are no more than so many.
FEW_PAIRS = 1 << 18
_SIGNATURE_TYPES = ", ".join(f"{s} long" for s in SIGNATURE)
#: Words are counted by the remainder of their hash.
WORD_COUNTS = 1 << 18
#: Long members of a head are dealt by so many.
SLICE = 512

NO_ID = 1 << 62
_SALTS = np.random.default_rng(SEED).integers(0, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def length_classes(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The classes in which texts of n words look for others, the second
    the same as the first or the next one.  Texts whose lengths are within
    MIN_SIMILARITY of each other share one."""
    step = np.floor(np.log(np.maximum(n, 1)) / -np.log(MIN_SIMILARITY) + 1e-9).astype(np.int64)
    return step // WIDTH, (step + 1) // WIDTH


def _shingles(words: np.ndarray, count: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Occurrence-labelled shingle hashes, and their number per text."""
    doc = np.repeat(np.arange(len(count)), count)
    first = np.cumsum(count) - count
    n = np.where(count > 0, np.maximum(count - size + 1, 1), 0)
    own = np.repeat(np.arange(len(count)), n)
    at = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + first[own]
    names = np.zeros(len(own), np.uint64)
    padded = np.concatenate((words, np.zeros(size, np.uint64)))
    docs = np.concatenate((doc, np.full(size, -1)))
    for j in range(size):  # a text of fewer words ends its only shingle
        w = np.where(docs[at + j] == own, padded[at + j], 0)
        names = (names ^ w) * _STEP
        names ^= names >> np.uint64(31)
    apart = mixed(names + own.astype(np.uint64) * _STEP)
    order = np.argsort(apart, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = apart[order[1:]] != apart[order[:-1]]
    run = np.cumsum(new) - 1
    nth = np.zeros(len(order), np.uint64)
    nth[order] = np.arange(len(order)) - np.flatnonzero(new)[run] if len(order) else 0
    return mixed(names + nth * _SALTS[0]), n


def sketches(words: np.ndarray, count: np.ndarray, size: int = SHINGLE) -> np.ndarray:
    """(texts with words, SKETCHES) order MinHash values."""
    names, n = _shingles(words, count, size)
    n = n[n > 0]
    start = np.cumsum(n) - n
    out = np.zeros((len(n), SKETCHES), np.uint64)
    place = np.arange(len(names))
    for r in range(SKETCHES if len(n) else 0):
        h = mixed(names ^ _SALTS[r])
        picks, places = [], []
        for _ in range(PICKED):
            low = np.minimum.reduceat(h, start)
            at = np.flatnonzero(h == np.repeat(low, n))
            own = np.searchsorted(start, at, "right") - 1
            at = at[np.concatenate(([True], own[1:] != own[:-1]))]  # the first of equals
            picks.append(names[at])
            places.append(place[at])
            h[at] = _TOP
        order = np.argsort(np.stack(places), axis=0, kind="stable")
        picked = np.take_along_axis(np.stack(picks), order, axis=0)
        key = np.full(len(n), r, np.uint64)
        for p in picked:
            key = mixed(key * _STEP + p)
        out[:, r] = key
    return out


def bucket_keys(words: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
    """The buckets of each text with words: its sketches in its classes."""
    n = count[count > 0]
    doc = np.repeat(np.arange(len(n)), n)
    own, beside = length_classes(n)
    out: list[list[np.ndarray]] = [[] for _ in n]
    for (least, size), top in zip(SIZES, [c for c, _ in SIZES[1:]] + [1 << 30], strict=True):
        of = [(k >= least) & (k < top) for k in (own, beside)]
        some = of[0] | of[1]
        drawn = sketches(words[some[doc]], n[some], size)
        for k, here in ((own, of[0]), (beside, of[1] & (beside > own))):
            keys = mixed(drawn + k[some].astype(np.uint64)[:, None] * _STEP)
            for i, row in zip(np.flatnonzero(some), keys, strict=True):
                if here[i]:
                    out[i].append(row)
    return [np.concatenate(k).view(np.int64) for k in out]


def _sketch_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        words, count = word_hashes([t if isinstance(t, str) else None for t in rows["text"]])
        some = count > 0
        n = count[some]
        start = np.cumsum(n) - n
        # The whole sequence, as two sums of words mixed with their places.
        nth = (np.arange(len(words)) - np.repeat(start, n)).astype(np.uint64)
        whole = [np.add.reduceat(mixed(words ^ (nth + np.uint64(s)) * _STEP), start) if len(n) else start
                 for s in (1, 1 << 40)]
        yield pd.DataFrame({"did": rows["did"][some].to_numpy(), "g1": whole[0].view(np.int64),
                            "g2": whole[1].view(np.int64), "n": n, "keys": bucket_keys(words, count)})


def node_id(doc_id: Column, text: Column) -> Column:
    """The doc_id; for a null one a number of its text beyond all ids."""
    return F.coalesce(doc_id.cast("long"), F.xxhash64(text).bitwiseAND(F.lit(NO_ID - 1)).bitwiseOR(F.lit(NO_ID)))


def edits_within(a: np.ndarray, b: np.ndarray, most: int) -> int:
    """Edit distance of two word sequences, ``most`` + 1 if it is more.

    Alignment in the band of ``most`` diagonals either way.  A column of
    the band is two bit vectors (where the distance goes up, and where
    down, from row to row), and slides down a row with each word of b; the
    distance is followed along the band's lower edge, then along the last
    row.
    """
    n, m = len(a), len(b)
    if abs(n - m) > most:
        return most + 1
    # Words without a partner in the other text are an edit each.
    values, where = np.unique(np.concatenate((a, b)), return_inverse=True)
    gap = np.bincount(where[:n], minlength=len(values)) - np.bincount(where[n:], minlength=len(values))
    if max(gap[gap > 0].sum(), -gap[gap < 0].sum()) > most:
        return most + 1
    most, bound = min(most, max(n, m)), most
    if n <= most:  # shorter than the band: the whole table is small
        row = list(range(m + 1))
        for i, x in enumerate(where[:n].tolist(), 1):
            before, row[0] = row[0], i
            for j, y in enumerate(where[n:].tolist(), 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
        return min(row[m], bound + 1)
    places: dict[int, int] = {}
    bit = 1 << most + 1  # so that the first columns need no left shift
    for x in where[:n].tolist():
        places[x] = places.get(x, 0) | bit
        bit <<= 1
    width = 2 * most + 1
    mask = (1 << width) - 1
    up, down = mask >> most << most, 0
    edge = 1 << width - 1
    distance, last = most, 2 * most + m - n
    text = where[n:].tolist()
    for j in range(n - most):
        same = places.get(text[j], 0) >> j + 1 & mask
        level = ((same & up) + up ^ up | same | down) & mask  # no change along the diagonal
        right, left = down | ~(level | up) & mask, level & up
        if not level & edge:
            distance += 1
            if distance > last:
                return bound + 1
        level >>= 1
        up, down = left | ~(level | right) & mask, level & right
    edge >>= 1
    for j in range(n - most, m):
        same = places.get(text[j], 0) >> j + 1 & mask
        level = ((same & up) + up ^ up | same | down) & mask
        right, left = down | ~(level | up) & mask, level & up
        distance += bool(right & edge) - bool(left & edge)
        edge >>= 1
        level >>= 1
        up, down = left | ~(level | right) & mask, level & right
    return min(distance, bound + 1)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    longest = max(len(a), len(b))
    return edits_within(a, b, int((1 - MIN_SIMILARITY) * longest + 1e-9)) <= (1 - MIN_SIMILARITY) * longest + 1e-9


def signatures(words: np.ndarray, count: np.ndarray, bits: int = BITS) -> np.ndarray:
    """(texts, bits / 64) longs: whether the words of each of so many hash
    values are odd in number.  An inserted or deleted word changes one bit,
    a replaced one two."""
    own = np.repeat(np.arange(len(count)), count)
    bit = (mixed(words.astype(np.uint64) * _STEP) % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(own * bits + bit, minlength=len(count) * bits).reshape(len(count), bits) & 1
    return np.packbits(odd.astype(np.uint8), axis=1, bitorder="little").view(np.int64)


def occurrences(words: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Hashes of each text's words with their occurrence numbers, so that a
    word found twice does not cancel out in a signature."""
    return _shingles(words.astype(np.uint64), count, 1)[0]


def _differing(a: str, b: str, columns: list[str]) -> Column:
    """Bits in which the signatures of columns with prefixes a and b differ."""
    total = F.lit(0)
    for s in columns:
        total = total + F.bit_count(F.col(a + s).bitwiseXOR(F.col(b + s)))
    return total


def _edits(a: str, b: str) -> Column:
    """The most edits that two texts of so many words may be apart."""
    return F.floor((1 - MIN_SIMILARITY) * F.greatest(a, b) + 1e-9)


def _bits() -> Column:
    """The most bits in which the signatures of a text and another (b_) that
    is similar may differ: two an edit, one where the edit changes the length."""
    return 2 * _edits("n", "b_n") - F.abs(F.col("n") - F.col("b_n"))


def _finely_near() -> Column:
    """Whether the finer signatures allow a match, or one has none."""
    bits = F.zip_with("fine", "b_fine", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.coalesce(F.aggregate(bits, F.lit(0), lambda total, x: total + x) <= _bits(), F.lit(True))


def _pack_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        words, count = word_hashes([t if isinstance(t, str) else None for t in rows["text"]])
        short = (words >> np.uint64(32)).astype(np.uint32)
        parts = np.split(short, np.cumsum(count)[:-1])
        names = occurrences(short, count)
        bits = signatures(names, count)
        fine = [signatures(p, np.array([len(p)]), FINE_BITS)[0] if len(p) > MIN_SIMILARITY * SIGNED else None
                for p in np.split(names, np.cumsum(count)[:-1])]  # one at a time, as they are wide
        yield pd.DataFrame({"node": rows["did"].to_numpy(), "words": [p.tobytes() for p in parts], "n": count.astype(np.int64)}
                           | dict(zip(SIGNATURE, bits.T, strict=True)) | {"fine": pd.Series(fine, dtype=object)})


def _verify(a: pd.Series, b: pd.Series) -> pd.Series:
    seq = [[np.frombuffer(x, np.uint32).astype(np.uint64) for x in s] for s in (a, b)]
    return pd.Series([similar(x, y) for x, y in zip(*seq, strict=True)], dtype=bool)


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs`` (doc_id, text) -> nodes (did, node) of all documents with
    words, and verified links (u, v) between nodes of different texts."""
    common.prepare(docs.sparkSession)
    rows = docs.select(node_id(F.col("doc_id"), F.col("text")).alias("did"), "text")
    drawn = common.written(rows.mapInPandas(_sketch_batches, "did long, g1 long, g2 long, n long, keys array<long>"),
                           "omh-sketches")
    groups = drawn.groupBy("g1", "g2").agg(F.min("did").alias("node"))
    by = common.rekeyed(groups, ["g1", "g2"], "k_").select("k_g1", "k_g2", "node")
    nodes = common.rekeyed(drawn, ["g1", "g2"], "k_").join(by, ["k_g1", "k_g2"]).select("did", "node", "keys")
    nodes = common.written(nodes, "omh-nodes")
    members = nodes.where(F.col("did") == F.col("node")).select("node", F.explode("keys").alias("key"))
    held = first = common.written(against_heads(members), "omh-held")
    words = packed_words(rows, held)  # whoever shares a bucket; later rounds are among them
    tried = pairs = common.written(pairs_to_try(held), "omh-pairs")
    linked = similar_pairs(words, pairs)
    rounds = 0
    while True:
        # Members of larger buckets that are no match of their head go on
        # among themselves, all that share a bucket with one head together.
        large = held.where("more").select("node", "head")
        failed = common.written(large.join(linked, ["node", "head"], "left_anti"), "omh-failed")
        left, done = failed.count(), large.count()
        if not left or done - left < LINKED_SHARE * done:
            break
        held = common.written(against_heads(failed.select("node", F.col("head").alias("key"))), "omh-held")
        pairs = common.written(pairs_to_try(held).join(tried, ["node", "head"], "left_anti"), "omh-pairs")
        tried = tried.unionByName(pairs)
        linked = linked.unionByName(similar_pairs(words, pairs))
        rounds += 1
    if left or rounds:
        entries = open_entries(first, words, components(_edges(linked)))
        pairs = open_pairs(entries).unionByName(long_pairs(first, entries, words))
        pairs = common.written(pairs.join(tried, ["node", "head"], "left_anti"), "omh-open")
        linked = linked.unionByName(similar_pairs(words, pairs))
    return nodes.select("did", "node"), _edges(linked)


def _edges(linked: DataFrame) -> DataFrame:
    return linked.select(F.col("node").alias("u"), F.col("head").alias("v"))


def against_heads(members: DataFrame) -> DataFrame:
    """Members (key, node) of buckets -> the distinct (node, head, more,
    keys) of all but the heads, the smallest node of each bucket; ``more``:
    whether a bucket of theirs has over SMALL members; ``keys``: their
    buckets of up to SMALL that have other members than the two."""
    heads = members.groupBy("key").agg(F.min("node").alias("head"), F.max("node").alias("last"), F.count(F.lit(1)).alias("size"))
    heads = common.rekeyed(heads.where(F.col("last") > F.col("head")), ["key"], "k_").select("k_key", "head", "size")
    held = common.rekeyed(members, ["key"], "k_").join(heads, "k_key").where(F.col("node") != F.col("head"))
    # A node has no more keys than sketches in its length classes.
    few = F.collect_set(F.when(F.col("size").between(3, SMALL), F.col("key"))).alias("keys")
    return held.groupBy("node", "head").agg(F.max(F.col("size") > SMALL).alias("more"), few)


def pairs_to_try(held: DataFrame) -> DataFrame:
    """(node, head) of ``held``, and of all members of its small buckets."""
    one = held.select("node", F.explode("keys").alias("key"))
    other = one.select(F.col("node").alias("head"), F.col("key").alias("b_key"))
    met = one.join(other, (F.col("key") == F.col("b_key")) & (F.col("node") > F.col("head"))).select("node", "head")
    return held.select("node", "head").unionByName(met).distinct()


def open_members(first: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, label) of the members of open buckets.

    ``first``: every member of a bucket with its head.  The members of all
    buckets of one head that are larger than SMALL are looked at together;
    they are open when they are in more than one component.
    """
    label = labels.withColumnRenamed("node", "l_node")
    of_head = label.select(F.col("l_node").alias("h_node"), F.col("label").alias("h_label"))
    rows = first.where("more").select("node", "head").join(label, F.col("node") == F.col("l_node"), "left").select(
        "node", "head", F.coalesce("label", "node").alias("label"))
    rows = rows.join(of_head, F.col("head") == F.col("h_node"), "left").select(
        "node", "head", "label", F.coalesce("h_label", "head").alias("h_label"))
    rows = common.written(rows, "omh-members")
    some = rows.groupBy("head", "h_label").agg(F.count(F.lit(1)).alias("size"), F.count_if(F.col("label") != F.col("h_label")).alias("off"))
    some = some.where("size > 1 and off > 0").select(F.col("head").alias("o_head"), "h_label")
    inside = rows.select("node", "label", "head").join(some, F.col("head") == F.col("o_head"), "left_semi")
    members = inside.select("node", "label").unionByName(some.select(F.col("o_head").alias("node"), F.col("h_label").alias("label")))
    return members.distinct()


def open_entries(first: DataFrame, words: DataFrame, labels: DataFrame) -> DataFrame:
    """(word, node, label, n, nth, signature): the open members by their
    rarest words."""
    members = common.written(open_members(first, labels), "omh-nodes")
    return common.written(first_words(words, members), "omh-entries")


def _may_be_similar() -> Column:
    """Of an entry and another (b_) of the same word: by lengths, places of
    the word and signatures."""
    most = _edits("n", "b_n")
    return ((F.col("label") != F.col("b_label")) & (F.abs(F.col("n") - F.col("b_n")) <= most)
            & (F.greatest("nth", "b_nth") <= most) & (_differing("", "b_", FOLDED) <= _bits()))


def open_pairs(entries: DataFrame) -> DataFrame:
    """(node, head) of up to SIGNED words that may be similar, of all
    entries with one word."""
    entries = entries.where(F.col("n") <= SIGNED)
    b = entries.select(F.col("word").alias("b_word"), F.col("node").alias("head"),
                       *[F.col(c).alias("b_" + c) for c in ("label", "n", "nth", *FOLDED)])
    both = entries.join(b, (F.col("word") == F.col("b_word")) & (F.col("node") > F.col("head")) & _may_be_similar())
    return both.select("node", "head").distinct()


def long_members(first: DataFrame, entries: DataFrame, words: DataFrame) -> DataFrame:
    """(head, main, size, node, label, n, heads, fine) of the open members
    too long for SIGNED, one row for each head of theirs; ``main``: the
    component that most of the head's ``size`` members are in."""
    long = entries.where(F.col("n") > MIN_SIMILARITY * SIGNED).select(F.col("node").alias("l_node"), "label", "n").distinct()
    held = first.where("more").select("node", "head")
    held = held.unionByName(held.select(F.col("head").alias("node"), "head")).distinct()
    held = held.join(long, F.col("node") == F.col("l_node")).groupBy("node", "label", "n").agg(F.collect_set("head").alias("heads"))
    fine = words.select(F.col("node").alias("w_node"), "fine")
    held = common.written(held.join(fine, F.col("node") == F.col("w_node")).drop("w_node"), "omh-long")
    each = held.select("label", F.explode("heads").alias("head")).groupBy("head", "label").agg(F.count(F.lit(1)).alias("of"))
    main = each.groupBy("head").agg(F.max_by("label", F.struct("of", "label")).alias("main"), F.sum("of").alias("size"))
    main = main.withColumnRenamed("head", "m_head")
    return held.withColumn("head", F.explode("heads")).join(main, F.col("head") == F.col("m_head")).drop("m_head")


def long_pairs(first: DataFrame, entries: DataFrame, words: DataFrame) -> DataFrame:
    """(node, head) that may be similar and share a head, one of them too
    long for SIGNED.

    A head's members outside its main component are held against all of
    them, dealt by SLICE members.  Signatures decide in the join, and a
    pair with several heads comes out at the smallest.
    """
    members = long_members(first, entries, words)
    slices = F.floor(F.col("size") / SLICE).cast("int")
    off = members.where("label != main").withColumn("slice", F.explode(F.sequence(F.lit(0), slices)))
    b = members.select(F.col("head").alias("b_head"), F.pmod(F.xxhash64("node"), slices + 1).cast("int").alias("b_slice"),
                       *[F.col(c).alias("b_" + c) for c in ("node", "label", "n", "heads", "fine")])
    once = (F.col("b_label") == F.col("main")) | (F.col("node") > F.col("b_node"))
    both = off.join(b, (F.col("head") == F.col("b_head")) & (F.col("slice") == F.col("b_slice"))
                    & (F.col("label") != F.col("b_label")) & once & (F.greatest("n", "b_n") > SIGNED)
                    & (F.abs(F.col("n") - F.col("b_n")) <= _edits("n", "b_n"))
                    & (F.array_min(F.array_intersect("heads", "b_heads")) == F.col("head")) & _finely_near())
    return both.select(F.greatest("node", "b_node").alias("node"), F.least("node", "b_node").alias("head"))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(words) -> (at, times): in how many of the texts of a partition the
    words are whose hashes are ``at`` modulo WORD_COUNTS."""
    times = np.zeros(WORD_COUNTS, np.int64)
    for batch in batches:
        for words in batch.column(0).to_pylist():
            times += np.bincount(np.unique(np.frombuffer(words, np.uint32)) % WORD_COUNTS, minlength=WORD_COUNTS)
    at = np.flatnonzero(times)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(times[at])], ["at", "times"])


def word_counts(held: DataFrame) -> np.ndarray:
    """For each remainder of a word's hash by WORD_COUNTS the texts (words)
    that have such words: no less than those of any one of the words."""
    some = held.select("words").mapInArrow(_count_batches, "at long, times long")
    some = some.groupBy("at").agg(F.sum("times").alias("times")).where("times > 1").toArrow()
    out = np.ones(WORD_COUNTS, np.int64)
    out[some["at"].to_numpy()] = some["times"].to_numpy()
    return out


def rarest_words(words: np.ndarray, times: dict[int, int]) -> np.ndarray:
    """The words that a text may meet a similar one by, labelled with their
    occurrence numbers: rarest first, one more than a text may have edits
    in a pair with the longest text that may be similar."""
    longest = int(len(words) / MIN_SIMILARITY + 1e-9)
    order = np.argsort(words, kind="stable")
    of = words[order].astype(np.int64)
    new = np.concatenate(([True], of[1:] != of[:-1]))
    occurrence = np.arange(len(of)) - np.flatnonzero(new)[np.cumsum(new) - 1]
    known = np.array([times[w] for w in of[new].tolist()])[np.cumsum(new) - 1]
    first = np.lexsort((occurrence, of, known))[:int((1 - MIN_SIMILARITY) * longest + 1e-9) + 1]
    return mixed(of[first].astype(np.uint64) * _STEP + occurrence[first].astype(np.uint64)).view(np.int64)


def _first_word_batches(batches: Iterator[pd.DataFrame], counts: np.ndarray) -> Iterator[pd.DataFrame]:
    for rows in batches:
        first, nth = [], []
        for words, total in zip(rows["words"], rows["n"], strict=True):
            w = np.frombuffer(words, np.uint32)
            of = np.unique(w)
            times = counts[of % WORD_COUNTS]
            lone = np.count_nonzero(np.isin(w, of[times == 1]))
            keys = rarest_words(w, dict(zip(of.tolist(), times.tolist(), strict=True)))[lone:]  # nobody else has those before
            keys = keys if total <= SIGNED else keys[:1]
            first.append(keys)
            nth.append(np.arange(lone, lone + len(keys)))
        n = [len(x) for x in first]
        out = rows[["node", "label", "n", *FOLDED]].take(np.repeat(np.arange(len(n)), n)).reset_index(drop=True)
        out.insert(0, "word", np.concatenate(first) if first else np.zeros(0, np.int64))
        out.insert(4, "nth", np.concatenate(nth) if nth else np.zeros(0, np.int64))
        yield out


def first_words(words: DataFrame, nodes: DataFrame) -> DataFrame:
    """(word, node, label, n, nth, signature): the rarest words of each of
    ``nodes`` (node, label), less those that one alone has; n words in all.
    A text of more than SIGNED words has one of them, if any.  Counts by
    WORD_COUNTS say which words are rare: one order for all texts is all
    that it takes for similar ones to share a word."""
    folded = [F.col(s).bitwiseXOR(F.col(t)).alias(f) for f, s, t in
              zip(FOLDED, SIGNATURE, SIGNATURE[len(FOLDED):], strict=False)]
    held = words.join(nodes.withColumnRenamed("node", "o_node"), F.col("node") == F.col("o_node"))
    held = common.written(held.select("node", "label", "n", *folded, "words"), "omh-first")
    counts = word_counts(held)
    return held.mapInPandas(lambda batches: _first_word_batches(batches, counts),
                            "word long, node long, label long, n long, nth long, " + ", ".join(f"{f} long" for f in FOLDED))


def packed_words(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, words, n, signature) of every node in ``pairs``."""
    wanted = pairs.select("node").unionByName(pairs.select(F.col("head").alias("node"))).distinct()
    texts = rows.join(wanted, rows["did"] == wanted["node"], "left_semi").select("did", "text")
    packed = texts.mapInPandas(_pack_batches, "node long, words binary, n long, " + _SIGNATURE_TYPES + ", fine array<long>")
    most = packed.groupBy("node").agg(F.max(F.struct("words", "n", *SIGNATURE, "fine")).alias("w"))
    return common.written(most.select("node", "w.*"), "omh-words")


def similar_pairs(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of ``pairs`` (node, head) whose texts are similar."""
    facts = ["n", *SIGNATURE, "fine"]
    a = words.select("node", *facts)
    b = words.select(F.col("node").alias("head"), *[F.col(c).alias("b_" + c) for c in facts])
    near = pairs.join(a, "node").join(b, "head").where((_differing("", "b_", SIGNATURE) <= _bits()) & _finely_near())
    near = common.written(near.select("node", "head"), "omh-near")
    texts = words.select("node", "words")
    if near.count() <= FEW_PAIRS:
        wanted = near.select("node").unionByName(near.select(F.col("head").alias("node"))).distinct()
        texts = texts.join(F.broadcast(wanted), "node", "left_semi")
    some = near.join(texts.withColumnRenamed("words", "a"), "node")
    some = some.join(texts.select(F.col("node").alias("head"), F.col("words").alias("b")), "head")
    some = some.where(F.pandas_udf(_verify, "boolean")("a", "b")).select("node", "head")
    return common.written(some, "omh-tested")


def classes(docs: DataFrame) -> DataFrame:
    """(did, class): the class of every document with words, the smallest
    node id in it."""
    nodes, linked = links(docs)
    own = nodes.groupBy("did").agg(F.min("node").alias("node"), F.max("node").alias("last"))
    # A repeated doc_id with different texts may have two nodes: one class.
    same = own.where(F.col("last") > F.col("node")).select(F.col("last").alias("u"), F.col("node").alias("v"))
    label = components(linked.unionByName(same)).withColumnRenamed("node", "k_node")
    return (own.join(label, F.col("node") == F.col("k_node"), "left")
            .select("did", F.coalesce("label", "node").alias("class")))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` less all but one row of each class, columns unchanged; the
    row with the smallest id stays."""
    did = node_id(F.col("doc_id"), F.col("text"))
    lost = classes(docs.select("doc_id", "text")).where(F.col("class") != F.col("did")).select("did")
    rows = docs.select(common.row_struct(docs).alias("nd_row"), did.alias("did"))
    rows = rows.join(lost, "did", "left_anti")
    first = Window.partitionBy("did").orderBy(F.col("nd_row.text"))
    return rows.withColumn("nd_nth", F.row_number().over(first)).where("nd_nth = 1").select("nd_row.*")


def digest(docs: DataFrame) -> DataFrame:
    """One row per document with its class id."""
    rows = docs.select("doc_id", node_id(F.col("doc_id"), F.col("text")).alias("did"))
    found = classes(docs.select("doc_id", "text"))
    out = F.coalesce("class", "did")
    return rows.join(found, "did", "left").select("doc_id", F.when(out < NO_ID, out).alias("class_id"))
