"""Lexicon sentiment of a text -> compound score in [-1, 1] -> class.

Two modes:

* ``bag``: lower-case words, sum of their valences, then
  ``s / sqrt(s^2 + 15)``;
* ``rules``: the valence rules of the published method (boosters,
  negation, capitals, exclamation and question marks, "but").

Both take one path for a lexicon of any size: the words of a text leave
it as rows (id, position, word, and in rules mode what the three words
before it do to it), meet the lexicon in a join, and are summed per id.
The text itself never enters a join or an exchange.  A token listed
several times in the lexicon counts once, with its largest valence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import COMPOUND_ALPHA, COMPOUND_DECIMALS
from ..functions import class_of_compound, rules, tokens
from ..functions.special import bound
from . import joins


def normalise(s: Column) -> Column:
    """s / sqrt(s^2 + alpha), rounded as the published scorer rounds it."""
    return F.round(s / F.sqrt(s * s + F.lit(COMPOUND_ALPHA)), COMPOUND_DECIMALS)


def _valences(lexicon: DataFrame) -> DataFrame:
    return lexicon.groupBy("token").agg(F.max(F.col("valence").cast("double")).alias("valence"))


def _hits(words: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``words`` (token, ...) that are in the lexicon, with their valence.

    A lexicon within the bound is sent to the words; the words, whose
    number no estimate knows, are never sent, however few they may seem.
    """
    return words.hint("merge").join(joins.bounded(_valences(lexicon)), "token")


def _with_scores(ids: DataFrame, sums: DataFrame, id_col: str, compound: Column) -> DataFrame:
    """Every id with its score; texts without a lexicon word score 0."""
    scores = sums.select(id_col, compound.alias("compound"))
    return ids.join(scores, id_col, "left").select(id_col, F.coalesce("compound", F.lit(0.0)).alias("compound"))


def score_bag(df: DataFrame, lexicon: DataFrame, text: str = "body",
              id_col: str = "comment_id") -> DataFrame:
    """(id, compound) of every text, bag mode."""
    words = df.select(id_col, F.explode(tokens(text)).alias("token"))
    sums = _hits(words, lexicon).groupBy(id_col).agg(F.sum("valence").alias("__s"))
    return _with_scores(df.select(id_col), sums, id_col, normalise(F.col("__s")))


# ----------------------------------------------------------------------
# Rules mode.
# ----------------------------------------------------------------------


def _capitals(word: Column) -> Column:
    return F.coalesce((F.upper(word) == word) & (F.lower(word) != word), F.lit(False))


def _plain(word: Column) -> Column:
    """A word as the lists have it: lower-case, without its apostrophe."""
    return F.replace(F.lower(word), F.lit(rules.APOSTROPHE), F.lit(""))


def _words(df: DataFrame, text: str, id_col: str) -> DataFrame:
    """The words of every text as rows (id, pos, w), each with the three
    words before it (w1 nearest) and what its text says of all: the marks,
    whether capitals are ``mixed`` with others, and where "but" stands."""
    t = F.col(text)
    found = F.coalesce(F.regexp_extract_all(t, F.lit(rules.WORD_PATTERN), F.lit(0)), F.array().cast("array<string>"))
    marks = [(F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))).alias(n) for c, n in (("!", "excl"), ("?", "ques"))]
    # Most texts show as a whole that they have no capitals and no "but".
    texts = df.select(id_col, *marks, found.alias("ws"), (F.lower(t) != t).alias("any_up"),
                      F.contains(_plain(t), F.lit(rules.BUT)).alias("any_but"))
    caps = F.size(F.filter("ws", _capitals))
    mixed = F.when(F.col("any_up"), (caps > 0) & (caps < F.size("ws"))).otherwise(False)
    but = F.when(F.col("any_but"), F.array_position(F.transform("ws", _plain), rules.BUT)).otherwise(0)
    before = [F.concat(F.array_repeat(F.lit(None).cast("string"), d), F.col("ws")).alias(f"w{d}") for d in (1, 2, 3)]
    # Made before the words leave, so that no row of a word carries them all.
    texts = texts.select(id_col, "excl", "ques", mixed.alias("mixed"), but.alias("but"),
                         F.arrays_zip(F.col("ws").alias("w"), *before).alias("zipped"))
    rows = texts.select(id_col, "excl", "ques", "mixed", "but", F.posexplode("zipped").alias("pos", "t"))
    return rows.select(id_col, "excl", "ques", "mixed", "but", "pos", "t.*").where(F.col("w").isNotNull())


def _before(up: list[str], down: list[str]) -> Column:
    """What the three words before a lexicon word do to it, nearest first:
    their boost (0 for none), capitals and negation."""
    def of(w: Column) -> Column:
        low = _plain(w)
        boost = F.when(low.isin(up), rules.B_INCR).when(low.isin(down), rules.B_DECR).otherwise(0.0)
        deny = low.isin(rules.NEGATIONS) | F.contains(F.lower(w), F.lit(rules.NOT_SUFFIX))
        return F.struct(boost.alias("boost"), _capitals(w).alias("caps"), deny.alias("deny"))
    return F.struct(_capitals(F.col("w")).alias("caps"), F.array(*[of(F.col(f"w{d}")) for d in (1, 2, 3)]).alias("before"))


def _valence_sql() -> str:
    """A lexicon word's valence after the words before it, nearest first."""
    push = f"(CASE WHEN v > 0 THEN {rules.C_INCR!r}D ELSE {-rules.C_INCR!r}D END)"
    steps = [("v", "valence + CASE WHEN mixed AND t.caps THEN "
                   f"CASE WHEN valence > 0 THEN {rules.C_INCR!r}D ELSE {-rules.C_INCR!r}D END ELSE 0.0D END")]
    for d, damping in enumerate(rules.BOOSTER_DAMPING):
        prev = f"t.before[{d}]"
        boosted = (f"CASE WHEN coalesce({prev}.boost, 0.0D) = 0.0D THEN v ELSE v + {damping!r}D * "
                   f"(CASE WHEN v < 0 THEN -{prev}.boost ELSE {prev}.boost END "
                   f"+ CASE WHEN mixed AND {prev}.caps THEN {push} ELSE 0.0D END) END")
        steps += [("v", boosted), ("v", f"CASE WHEN coalesce({prev}.deny, false) THEN v * {rules.N_SCALAR!r}D ELSE v END")]
    steps.append(("out", f"v * CASE WHEN but = 0 OR pos + 1 = but THEN 1.0D WHEN pos + 1 < but THEN {rules.BUT_BEFORE!r}D "
                         f"ELSE {rules.BUT_AFTER!r}D END"))
    return bound(steps)


def score_rules(df: DataFrame, lexicon: DataFrame, text: str = "body",
                id_col: str = "comment_id") -> DataFrame:
    """(id, compound) of every text, rules mode."""
    # Boosters that are lexicon words themselves neither boost nor count.
    boosters = [*rules.BOOSTERS_UP, *rules.BOOSTERS_DOWN]
    listed = {r["token"] for r in lexicon.where(F.col("token").isin(boosters)).select("token").distinct().collect()}
    up, down = ([b for b in side if b not in listed] for side in (rules.BOOSTERS_UP, rules.BOOSTERS_DOWN))
    words = _words(df, text, id_col).withColumn("token", _plain(F.col("w"))).where(~F.col("token").isin(boosters))
    # Only lexicon words are looked at together with the words before them.
    hits = _hits(words, lexicon).withColumn("t", _before(up, down))
    hits = hits.select(id_col, "excl", "ques", F.struct("pos", F.expr(_valence_sql()).alias("x")).alias("__x"))
    # Summed in the order of the text, so that reruns agree to the last digit.
    sums = hits.groupBy(id_col).agg(F.first("excl").alias("excl"), F.first("ques").alias("ques"),
                                    F.array_sort(F.collect_list("__x")).alias("__xs"))
    s = F.aggregate(F.transform("__xs", lambda h: h["x"]), F.lit(0.0), lambda a, x: a + x)
    emphasis = (F.least("excl", F.lit(rules.EXCLAIM_MAX)) * F.lit(rules.EXCLAIM_WEIGHT)
                + F.when(F.col("ques") <= 1, 0.0).when(F.col("ques") <= 3, F.col("ques") * rules.QUESTION_WEIGHT)
                .otherwise(rules.QUESTION_MAX_WEIGHT))
    sums = sums.select(id_col, s.alias("__s"), emphasis.alias("__e"))
    total = F.col("__s") + F.signum("__s") * F.col("__e")
    compound = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), total / F.sqrt(total * total + F.lit(COMPOUND_ALPHA))))
    return _with_scores(df.select(id_col), sums, id_col, F.round(compound, COMPOUND_DECIMALS))


def classify(df: DataFrame, lexicon: DataFrame, text: str = "body", mode: str = "bag",
             id_col: str = "comment_id") -> DataFrame:
    """``df`` without its text, with ``compound`` and ``sentiment``
    (negative / neutral / positive).  ``id_col`` is unique."""
    score = score_bag if mode == "bag" else score_rules
    scored = score(df, lexicon, text, id_col)
    if set(df.columns) - {text, id_col}:
        scored = df.drop(text).join(scored, id_col)
    return scored.withColumn("sentiment", class_of_compound("compound"))
