"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the
measurements and one failure bit per rule; versioned policies are masks
over the bits, and ablations are bitwise aggregates over the ledger, so
neither reads a text again.

Defined results: a null or empty text has no words and fails
``too_few_words``; filtering keeps the other columns as
they are, and a column of the ledger's name is replaced by it; an empty
table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

# Fixed values of the contract.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

MEASURES = ("q_words", "q_word_chars", "q_symbols", "q_dup_lines", "q_repeat_words", "q_lines", "q_upper", "q_lower",
            "q_digits", "q_same_next")

#: One bit per rule, in this order; SQL over the measurements.  New rules
#: are appended, so that stored ledgers stay valid.
RULES: tuple[tuple[str, str], ...] = (
    ("too_few_words", f"q_words < {MIN_WORDS}"),
    ("repeated_words", f"100 * q_repeat_words > {MAX_REPEAT_PERCENT} * q_words"),
    ("symbol_heavy", "100 * q_symbols > 20 * q_words"),
    ("shouting", "100 * q_upper > 40 * (q_upper + q_lower)"),
    ("repeated_lines", "100 * q_dup_lines > 50 * q_lines"),
    ("digit_heavy", "100 * q_digits > 40 * q_word_chars"),
    ("long_words", "q_word_chars > 60 * q_words"),
    ("stuttering", "100 * q_same_next > 30 * q_words"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A versioned choice of rules; a document that fails any is rejected."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", ("too_few_words", "repeated_words"))
V1 = Policy("v1", tuple(name for name, _ in RULES))
POLICIES = {p.version: p for p in (BASE, V1)}

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS.encode())] = True
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit name for each pair."""
    x = (a ^ (a >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + b * _STEP
    return x ^ (x >> np.uint64(32))


def repeat_words(words: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Words of each document inside WINDOW-word windows that the same
    document holds twice or more.  ``words``: word hashes in order,
    ``doc``: the document number of each."""
    out = np.zeros(n_docs, np.int64)
    n = len(words)
    if n < WINDOW + 1:
        return out
    names = words + doc.astype(np.uint64) * _STEP
    names = _mixed(names[:-1], names[1:])
    names = _mixed(names[:-2], names[2:])
    names = _mixed(names[:-4], names[4:])
    starts = np.flatnonzero(doc[:n - WINDOW + 1] == doc[WINDOW - 1:])
    names = names[starts]
    order = np.argsort(names)
    ranked = names[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(names), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(n + 1, np.int64)
    at = starts[twice]
    np.add.at(step, at, 1)
    np.add.at(step, at + WINDOW, -1)
    covered = np.cumsum(step[:n]) > 0
    return out + np.bincount(doc[covered], minlength=n_docs)


def measure(texts: list[str | None]) -> dict[str, np.ndarray]:
    """The measurements of a batch of texts, at once."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    size = np.array([len(b) for b in raw], np.int64)
    end = np.cumsum(size)
    data = np.frombuffer(b"".join(raw), np.uint8)

    def per_text(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask)))
        return total[end] - total[end - size]

    solid = ~_IS_SPACE[data]
    out = {"q_word_chars": per_text(solid & ((data & 0xC0) != 0x80)), "q_symbols": per_text(_IS_SYMBOL[data]),
           "q_upper": per_text((data >= 65) & (data <= 90)), "q_lower": per_text((data >= 97) & (data <= 122)),
           "q_digits": per_text((data >= 48) & (data <= 57))}
    words: list[int] = []
    count = np.zeros(len(raw), np.int64)
    n_lines = np.ones(len(raw), np.int64)
    dup_lines = np.zeros(len(raw), np.int64)
    for i, b in enumerate(raw):
        own = b.split()  # bytes split at exactly the contract's white space
        count[i] = len(own)
        words.extend(map(xxhash.xxh3_64_intdigest, own))
        lines = b.split(b"\n")
        n_lines[i] = len(lines)
        lines = [s for s in lines if s.strip()]
        dup_lines[i] = len(lines) - len(set(lines))
    doc = np.repeat(np.arange(len(raw)), count)
    names = np.array(words, np.uint64)
    same = doc[1:][(names[1:] == names[:-1]) & (doc[1:] == doc[:-1])]
    out["q_same_next"] = np.bincount(same, minlength=len(raw))
    return out | {"q_words": count, "q_lines": n_lines, "q_dup_lines": dup_lines,
                  "q_repeat_words": repeat_words(names, doc, len(raw))}


def _ledger_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        got = measure([t if isinstance(t, str) else None for t in texts])
        yield pd.DataFrame({c: got[c] for c in MEASURES})


def ledger(docs: DataFrame) -> DataFrame:
    """``docs`` with ``q_ledger``: a struct of the measurements and
    ``bits``, the failure bits of all rules."""
    common.prepare(docs.sparkSession)
    measured = F.pandas_udf(_ledger_batches, ", ".join(f"{c} long" for c in MEASURES))
    out = docs.withColumn("q_ledger", measured("text"))
    bits = F.lit(0).cast("long")
    for i, (_, failed) in enumerate(RULES):
        rule = failed
        for c in MEASURES:
            rule = rule.replace(c, f"q_ledger.{c}")
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    return out.withColumn("q_ledger", F.struct("q_ledger.*", bits.alias("bits")))


def apply_policy(rows: DataFrame, policy: Policy, out: str = "q_kept") -> DataFrame:
    """A column that says whether the policy keeps the row."""
    return rows.withColumn(out, F.col("q_ledger.bits").bitwiseAND(F.lit(policy.mask)) == 0)


def ablations(rows: DataFrame, policy: Policy) -> DataFrame:
    """One row per rule of the policy: the documents that fail it, those
    that fail no other rule of the policy, and those kept without it.
    One pass over the stored bits."""
    bits, mask = F.col("q_ledger.bits"), F.lit(policy.mask)
    failed = bits.bitwiseAND(mask)
    sums = [F.count(F.lit(1)).alias("n"), F.sum((failed == 0).cast("long")).alias("kept"),
            F.bit_or(failed).alias("seen")]
    for r in policy.rules:
        sums += [F.sum((failed.bitwiseAND(F.lit(BIT[r])) != 0).cast("long")).alias(f"f_{r}"),
                 F.sum((failed == BIT[r]).cast("long")).alias(f"o_{r}")]
    rows = rows.agg(*sums)
    each = F.array(*[F.struct(F.lit(r).alias("rule"), F.coalesce(F.col(f"f_{r}"), F.lit(0)).alias("n_failed"),
                              F.coalesce(F.col(f"o_{r}"), F.lit(0)).alias("n_failed_alone"),
                              F.coalesce(F.col("kept") + F.col(f"o_{r}"), F.lit(0)).alias("n_kept_without"))
                     for r in policy.rules])
    return rows.select(F.lit(policy.version).alias("policy"), F.explode(each).alias("e")).select("policy", "e.*")


def keep_good(docs: DataFrame, policy: Policy = V1) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, columns unchanged."""
    rows = ledger(docs.select(common.row_struct(docs).alias("q_row"), "text"))
    return apply_policy(rows, policy).where("q_kept").select("q_row.*")


def digest(docs: DataFrame, policy: Policy = V1) -> DataFrame:
    """The contract's columns, one row per document."""
    rows = apply_policy(apply_policy(ledger(docs.select("doc_id", "text")), policy), BASE, "q_base")
    g = "q_ledger."
    return rows.select("doc_id", F.col(g + "q_words").alias("n_words"), F.col(g + "q_word_chars").alias("word_chars"),
                       F.col(g + "q_symbols").alias("n_symbols"), F.col(g + "q_dup_lines").alias("n_dup_lines"),
                       F.col(g + "q_repeat_words").alias("n_repeat_words"), (~F.col("q_base")).alias("base_failed"),
                       (F.col("q_base") & F.col("q_kept")).alias("kept"), F.col(g + "bits").alias("failed_bits"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper,
         length(text) - length(regexp_replace(text, '[a-z]', '', 'g')) AS n_lower,
         length(text) - length(regexp_replace(text, '[0-9]', '', 'g')) AS n_digits,
         len(string_split(text, chr(10))) AS n_lines
  FROM d),
s AS (SELECT doc_id, count(*) AS n_same_next
      FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS p FROM m) WHERE w[p] = w[p + 1] GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dl AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l
       WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
i AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS pos FROM m WHERE len(w) >= 8),
g AS (SELECT doc_id, pos, array_to_string(list_slice(w, pos, pos + 7), chr(10)) AS win FROM i),
t AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g),
c AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT doc_id, unnest(range(pos, pos + 8)) AS p FROM t WHERE n >= 2) GROUP BY doc_id),
a AS (SELECT m.doc_id, len(w) AS n_words, word_chars, n_symbols, n_upper, n_lower, n_digits, n_lines,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_same_next, 0) AS n_same_next
      FROM m LEFT JOIN dl USING (doc_id) LEFT JOIN c USING (doc_id) LEFT JOIN s USING (doc_id)),
b AS (SELECT *, (CASE WHEN n_words < 20 THEN 1 ELSE 0 END)
             + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
             + (CASE WHEN 100 * n_symbols > 20 * n_words THEN 4 ELSE 0 END)
             + (CASE WHEN 100 * n_upper > 40 * (n_upper + n_lower) THEN 8 ELSE 0 END)
             + (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 16 ELSE 0 END)
             + (CASE WHEN 100 * n_digits > 40 * word_chars THEN 32 ELSE 0 END)
             + (CASE WHEN word_chars > 60 * n_words THEN 64 ELSE 0 END)
             + (CASE WHEN 100 * n_same_next > 30 * n_words THEN 128 ELSE 0 END) AS failed_bits FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits
FROM b
"""
