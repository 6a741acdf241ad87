"""Line deduplication across documents.

Normalised lines are exploded and hashed, the documents of each hash are
counted, and lines found in too many documents are dropped everywhere but
in the keeper.  Only (hash, document) pairs and line positions are
shuffled; the texts meet the dropped positions once, by document, and are
put together again by position.

Defined results: a null or empty text is one empty line and stays empty;
each row is one document, also where a ``doc_id`` repeats; a null
``doc_id`` ranks below all others; of rows with the largest ``doc_id``
all keep the line; other columns pass through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# Fixed values of the contract.
MIN_KEY_CHARS = 20
MIN_DOCUMENTS = 3

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWEST = -(1 << 63)


def line_key(line: Column) -> Column:
    """White space stripped at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(common.SPACE_CHARS)), UPPER, UPPER.lower())


def _digest(key: Column, min_chars: int) -> Column:
    return F.when(F.char_length(key) >= min_chars, F.md5(key))


def dropped_lines(docs: DataFrame, min_chars: int = MIN_KEY_CHARS, min_docs: int = MIN_DOCUMENTS) -> DataFrame:
    """``docs`` (doc_id, text) -> (did, thash, dropped): the positions of
    the dropped lines of each document that loses any."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("did"),
                       common.row_hash(F.col("text")).alias("thash"),
                       # Two steps, so that each key is made once.
                       F.transform(F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), line_key),
                                   lambda k: _digest(k, min_chars)).alias("keys"))
    # A document's keys once each, then partial sums before the shuffle.
    found = (rows.select("did", F.explode(F.array_distinct("keys")).alias("key"))
             .where(F.col("key").isNotNull())
             .groupBy("key").agg(F.count(F.lit(1)).alias("n_docs"), F.max("did").alias("keeper"))
             .where(F.col("n_docs") >= min_docs))
    places = (rows.select("did", "thash", F.posexplode("keys").alias("pos", "key"))
              .where(F.col("key").isNotNull()))
    found = common.rekeyed(found, ["key"], "f_").select("f_key", "keeper")
    places = common.rekeyed(places, ["key"], "f_")
    return (places.join(found.hint("merge"), "f_key").where(F.col("did") < F.col("keeper"))
            .groupBy("did", "thash").agg(F.collect_set("pos").alias("dropped")))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_KEY_CHARS, min_docs: int = MIN_DOCUMENTS) -> DataFrame:
    """``docs`` with ``text`` less its dropped lines, and the columns
    ``ld_lines`` and ``ld_dropped`` (lines before, lines dropped)."""
    hits = dropped_lines(docs.select("doc_id", "text"), min_chars, min_docs)
    rows = docs.select(common.row_struct(docs).alias("ld_row"), F.coalesce("text", F.lit("")).alias("ld_text"),
                       F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("did"),
                       common.row_hash(F.col("text")).alias("thash"), F.col("text").isNull().alias("ld_null"))
    lines = F.split("ld_text", "\n", -1)
    drop = F.coalesce("dropped", F.array().cast("array<int>"))
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), drop)
    # A dropped text is never the whole row: a null text stays null.
    kept = F.when(F.col("dropped").isNull(), F.col("ld_text")).otherwise(
        F.array_join(F.transform(stay, lambda p: F.get(lines, p)), "\n"))
    out = rows.join(hits, ["did", "thash"], "left").select(
        "ld_row", F.when(~F.col("ld_null"), kept).alias("ld_kept"), F.size(lines).cast("long").alias("ld_lines"),
        F.size(drop).cast("long").alias("ld_dropped"))
    added = {"text": F.col("ld_kept"), "ld_lines": F.col("ld_lines"), "ld_dropped": F.col("ld_dropped")}
    return out.select(*common.unpacked(docs, "ld_row", added))


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, one row per document."""
    out = dedup_lines(docs.select("doc_id", "text"))
    return out.select("doc_id", F.col("ld_lines").alias("n_lines"), F.col("ld_dropped").alias("n_dropped"),
                      F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d),
k AS (SELECT doc_id, pos, line,
             translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
r AS (SELECT k.doc_id, k.pos, k.line, f.keeper IS NOT NULL AND k.doc_id < f.keeper AS gone
      FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM r GROUP BY doc_id
"""
