"""Spelling variants by a variable-length gram index.

The words of the corpus are counted; those long and frequent enough are
the vocabulary.  Two words are near at an edit distance of exactly one.
Near words are found with grams of variable length:

* a word gets a mark at each end, and every place in it starts a gram.
  The frequencies of all grams of ``SHORTEST`` to ``LONGEST`` characters are
  counted, and the dictionary is pruned by them: a gram is extended by one
  more character as long as it occurs more than ``COMMON`` times.  So which
  gram starts at a place depends on that gram's own characters alone;
* an edit affects only grams that cover its place, so of grams that do not
  overlap it affects one at most, and a word needs to merge the lists of
  only two: of a gram that ends where another one starts.  Of all such
  places in the word the one with the shortest lists is taken;
* the edit is behind the end of the first gram or before the start of the
  second one, and the other side of the word is equal in both words.  So a
  list is keyed with that side (the word up to the gram's end, or from its
  start on), and common grams make no long lists.  A word is entered in
  the lists of all its grams, and looks up two;
* the pairs found are deduplicated and verified.

A word's form is its most frequent near word, if that is so much more
frequent, and its root the end of the chain of forms, found by pointer
jumping.  Near words, lists and chains are tables; nothing is fetched to
the driver but counts of open chains.

Defined results: a null or empty text has no words; a null ``doc_id``
counts as the empty string where words are drawn; rows that share a
``doc_id`` are read each for itself; words are compared by code points and
of any length; other columns play no part.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# What a word is, and the words whose spelling is changed.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
DRAWN = 199

MIN_LENGTH, MIN_COUNT = 6, 5
#: A form is at least so many times as frequent as the word.
FORM_TIMES = 5

#: Half of a shortest marked word at most, so that two grams fit into any.
SHORTEST, LONGEST = 2, (MIN_LENGTH + 2) // 2
#: Occurrences up to which a gram is not extended.
COMMON = 64
#: The base of a hash of a word's characters by their places (odd).
_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Different words that a task counts before it hands them on.
HELD = 1 << 17


def spelled(run: bytes, doc_id: str) -> bytes:
    """A lower-cased run (Latin-1) of a document as it counts: every so
    many are without one letter."""
    h = crc32(f"{doc_id}:{run.decode('latin-1')}".encode())
    if h % DRAWN:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: Counter[bytes] = Counter()

    def counted() -> pd.DataFrame:
        return pd.DataFrame({"word": [w.decode("latin-1") for w in total], "n": list(total.values())})

    for rows in batches:
        for doc_id, text in zip(rows["id"], rows["text"], strict=True):
            if not isinstance(text, str):
                continue
            # Latin-1 has all letters of a run, and lower() there only A-Z.
            doc_id = doc_id if isinstance(doc_id, str) else ""
            runs: Counter[bytes] = Counter()
            for run, n in Counter(RUN.findall(text)).items():
                runs[run.encode("latin-1").lower()] += n
            for run, n in runs.items():
                if len(run) >= MIN_LENGTH:
                    word = spelled(run, doc_id)
                    if len(word) >= MIN_LENGTH:
                        total[word] += n
        if len(total) >= HELD:
            yield counted()
            total.clear()
    if total:
        yield counted()


def vocabulary(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> words (id, word, n) of the whole corpus,
    written; the id is a number of its own."""
    common.prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), "text")
    words = rows.mapInPandas(_count_batches, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = words.where(F.col("n") >= MIN_COUNT)
    return common.written(common.written(words, "sp-words").select(F.monotonically_increasing_id().alias("id"), "word", "n"),
                          "sp-vocabulary")


def _longest_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        marked = [f"^{w}$" for w in rows["word"]]
        at = [range(len(w) - SHORTEST + 1) for w in marked]
        yield pd.DataFrame({"id": np.repeat(rows["id"].to_numpy(), list(map(len, at))), "at": list(chain.from_iterable(at)),
                            "g": [w[i:i + LONGEST] for w, places in zip(marked, at, strict=True) for i in places]})


def grams(words: DataFrame) -> DataFrame:
    """(id, at, gram): the gram of the pruned dictionary that starts at
    each place of each marked word."""
    # All grams that a place may start are the prefixes of the longest one.
    longest = common.written(words.select("id", "word").mapInPandas(_longest_batches, "id long, at int, g string"), "sp-places")
    parts = F.transform(F.sequence(F.lit(SHORTEST), F.length("g")), lambda q: F.substring(F.col("g"), 1, q))
    starts = longest.groupBy("g").agg(F.count(F.lit(1)).alias("k"))
    freq = starts.select("k", F.explode(parts).alias("gram")).groupBy("gram").agg(F.sum("k").alias("times"))
    # The dictionary's gram for each longest one: the first that is not too
    # common, or else that itself.
    kept = starts.select("g", F.explode(parts).alias("gram")).join(freq, "gram")
    kept = kept.where((F.col("times") <= COMMON) | (F.col("gram") == F.col("g")))
    kept = kept.groupBy("g").agg(F.min(F.struct(F.length("gram").alias("q"), "gram")).alias("x"))
    kept = common.written(kept.select("g", "x.gram"), "sp-dictionary")
    kept = common.rekeyed(kept, ["g"], "k_").select("k_g", "gram")
    return common.rekeyed(longest, ["g"], "k_").join(kept, "k_g").select("id", "at", "gram")


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def side_keys(word: str, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the marked word up to each end, and from each start on."""
    codes = np.frombuffer(f"^{word}$".encode("utf-32-le"), np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        up = np.full(len(codes), _BASE, np.uint64)
        up[0] = 1
        down = np.full(len(codes), _INVERSE, np.uint64)
        down[0] = 1
        up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        upto = np.concatenate(([np.uint64(0)], np.cumsum(codes * up)))
        since = (upto[-1] - upto[:-1]) * down
        return _mixed(upto[ends], 1), _mixed(since[starts], 2)


def _entry_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        out = []
        for i, word, of in zip(rows["id"], rows["word"], rows["of"], strict=True):
            starts = np.array([x["at"] for x in of])
            ends = np.unique(starts + np.array([x["q"] for x in of]))
            keys = side_keys(word, starts, ends)
            letters = np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(np.uint64) & np.uint64(63)
            odd = np.bitwise_xor.reduce(np.uint64(1) << letters).view(np.int64)
            out.append((np.full(len(ends) + len(starts), i), np.concatenate((ends, starts)), np.concatenate(keys),
                        np.repeat([True, False], [len(ends), len(starts)]), np.full(len(ends) + len(starts), len(word)),
                        np.full(len(ends) + len(starts), odd)))
        if out:
            yield pd.DataFrame(dict(zip(["id", "cut", "key", "upto", "size", "odd"], map(np.concatenate, zip(*out)), strict=True)))


def entries(words: DataFrame) -> DataFrame:
    """(id, cut, key, upto, size, odd): each word in the lists of all its grams,
    by the word up to the end of the gram and from its start on.
    ``odd`` has a bit for the letters that are there an odd number of times."""
    held = grams(words).groupBy("id").agg(F.collect_list(F.struct("at", F.length("gram").alias("q"))).alias("of"))
    rows = held.withColumnRenamed("id", "g_id").join(words, F.col("g_id") == F.col("id")).select("id", "word", "of")
    return common.written(rows.mapInPandas(_entry_batches, "id long, cut int, key long, upto boolean, size int, odd long"), "sp-entries")


def lookups(entered: DataFrame) -> DataFrame:
    """(key, id, size, odd): the two lists that each word looks up, those of the
    cut whose lists are shortest together."""
    length = entered.groupBy("key").agg(F.count(F.lit(1)).alias("times"))
    length = common.rekeyed(length, ["key"], "k_").select("k_key", "times")
    known = common.rekeyed(entered, ["key"], "k_").join(length, "k_key")
    cuts = known.groupBy("id", "cut", "size", "odd").agg(F.count(F.lit(1)).alias("sides"), F.sum("times").alias("times"),
                                                  F.max(F.when(F.col("upto"), F.col("key"))).alias("upto"),
                                                  F.max(F.when(~F.col("upto"), F.col("key"))).alias("since"))
    best = cuts.where("sides = 2").groupBy("id", "size", "odd").agg(F.min(F.struct("times", "cut", "upto", "since")).alias("x"))
    return best.select("id", "size", "odd", F.explode(F.array("x.upto", "x.since")).alias("key"))


def near_pairs(words: DataFrame) -> DataFrame:
    """All pairs (a, b) of ids whose words are at distance one, each once
    in either direction."""
    entered = entries(words)
    sizes = F.explode(F.array("size", F.col("size") + 1)).alias("size")
    a = common.written(lookups(entered), "sp-lookups").select("key", F.col("id").alias("a"), "odd", sizes)
    b = entered.select("key", F.col("id").alias("b"), "size", F.col("odd").alias("b_odd"))
    # One edit changes how often two letters are there, at most.
    like = F.bit_count(F.col("odd").bitwiseXOR(F.col("b_odd"))) <= 2
    pairs = a.join(b, ["key", "size"]).where((F.col("a") != F.col("b")) & like)
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    named = words.select("id", "word")
    pairs = pairs.join(named.toDF("a", "wa"), "a").join(named.toDF("b", "wb"), "b")
    pairs = common.written(pairs.where(F.levenshtein("wa", "wb", 1) == 1).select("a", "b"), "sp-pairs")
    return pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _roots(forms: DataFrame) -> DataFrame:
    """(id, form) -> (id, root): the end of the chain of forms.  Every
    round doubles the steps a word has gone."""
    # A form is more frequent, so chains have no circles.
    jumps = common.written(forms.select("id", F.col("form").alias("root")), "sp-jumps")
    while True:
        on = jumps.select(F.col("id").alias("n_id"), F.col("root").alias("n_root"))
        far = jumps.join(on, F.col("root") == F.col("n_id"), "left")
        jumps = common.written(far.select("id", F.coalesce("n_root", "root").alias("root"),
                                          F.col("n_root").isNotNull().alias("gone")), "sp-jumps")
        if jumps.where("gone").isEmpty():
            return jumps.select("id", "root")
        jumps = jumps.drop("gone")


def variants(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) -> every word of the vocabulary with its
    form, root, n, n_near and form_n."""
    words = vocabulary(docs)
    pairs = near_pairs(words)
    other = words.select(F.col("id").alias("b"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    best = F.min(F.struct((-F.col("form_n")).alias("down"), "form", F.col("b").alias("form_id")))
    near = pairs.join(other, "b").groupBy("a").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    known = words.join(near, words["id"] == near["a"], "left").withColumn("form_n", -F.col("best.down"))
    good = F.col("form_n") >= FORM_TIMES * F.col("n")
    known = known.select("id", "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(good, F.col("best.form")).alias("form"),
                         F.when(good, F.col("best.form_id")).alias("form_id"), F.when(good, F.col("form_n")).alias("form_n"))
    known = common.written(known, "sp-forms")
    roots = _roots(known.where("form_id is not null").select("id", F.col("form_id").alias("form")))
    roots = roots.join(words.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
    return known.join(roots.select("id", "root_word"), "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def digest(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word."""
    return variants(docs.select("doc_id", "text"))
