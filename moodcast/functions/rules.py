"""Rule-based valence of a text: fixed values, and the rules as DuckDB SQL.

The rules of the published lexicon method, applied to the words of a
text (letters or digits, with at most one inner apostrophe):

* each lexicon word contributes its valence, pushed away from zero by
  ``C_INCR`` when it is in capitals inside mixed-case text;
* each of the three words before it (nearest first) that is not itself a
  lexicon word may boost it (``B_INCR`` / ``B_DECR``, damped by distance,
  with the same capitals rule), and a negation among them multiplies it
  by ``N_SCALAR``;
* with "but" in the text, words before it count half and words after it
  one and a half times;
* exclamation marks (up to 4) and repeated question marks push a
  non-zero sum further from zero;
* compound = s / sqrt(s^2 + 15), rounded to 4 decimals.

The SQL uses array functions over each whole text; the Spark operator
scores word rows instead (``operators.sentiment``).
"""

from __future__ import annotations

from ..constants import COMPOUND_ALPHA, COMPOUND_DECIMALS

# Fixed values of the published rule set (Hutto & Gilbert, ICWSM 2014):
# booster increment, capitals increment, negation scalar, punctuation
# weights, and the booster damping at distance 1, 2 and 3.
B_INCR = 0.293
B_DECR = -0.293
C_INCR = 0.733
N_SCALAR = -0.74
EXCLAIM_WEIGHT = 0.292
EXCLAIM_MAX = 4
QUESTION_WEIGHT = 0.18
QUESTION_MAX_WEIGHT = 0.96
BOOSTER_DAMPING = (1.0, 0.95, 0.9)
BUT_BEFORE = 0.5
BUT_AFTER = 1.5

# Negation words and one-word intensity modifiers (a subset
# of the published lists, English; apostrophes removed).
NEGATIONS = [
    "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt",
    "dont", "hadnt", "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither",
    "never", "none", "nope", "nor", "not", "nothing", "nowhere", "oughtnt",
    "shant", "shouldnt", "wasnt", "werent", "without", "wont", "wouldnt",
    "rarely", "seldom", "despite",
]
BOOSTERS_UP = [
    "absolutely", "amazingly", "awfully", "completely", "considerably",
    "decidedly", "deeply", "enormously", "entirely", "especially",
    "exceptionally", "extremely", "fabulously", "greatly", "highly",
    "hugely", "incredibly", "intensely", "majorly", "more", "most",
    "particularly", "purely", "quite", "really", "remarkably", "so",
    "substantially", "thoroughly", "totally", "tremendously", "uber",
    "unbelievably", "unusually", "utterly", "very",
]
BOOSTERS_DOWN = [
    "almost", "barely", "hardly", "kinda", "less", "little", "marginally",
    "occasionally", "partly", "scarcely", "slightly", "somewhat", "sorta",
]

# The ending of a contracted negation, its sign, and the word
# that turns a text.
NOT_SUFFIX = "n't"
APOSTROPHE = "'"
BUT = "but"

# Word pattern: letters or digits, optionally one apostrophe inside.
WORD_PATTERN = r"[\p{L}\p{N}]+(?:'[\p{L}\p{N}]+)?"


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _array(values) -> str:
    return "[" + ", ".join(map(_lit, values)) + "]"


def lexicon_map_sql(rows) -> str:
    """Map literal token -> valence."""
    return "MAP {" + ", ".join(f"{_lit(t)}: CAST({float(v)!r} AS DOUBLE)" for t, v in rows) + "}"


def compound_sql(text: str, lex_map: str) -> list[tuple[str, str]]:
    """DuckDB steps (column, SQL) ending in ``__rules_compound`` for the
    text column: the oracle of the relational form in operators.sentiment."""
    def has(arr: str, x: str) -> str:
        return f"list_contains({arr}, {x})"

    def at(arr: str, i: str) -> str:
        return f"{arr}[{i}]"

    def lookup(k: str) -> str:
        return f"({lex_map})[{k}]"

    def seq(a: str, b: str) -> str:
        return f"range({a}, ({b}) + 1)"

    def fold(arr: str, init: str, body: str) -> str:
        return f"list_reduce({arr}, lambda {body}, CAST({init} AS DOUBLE))"

    def tr(arr: str, body: str) -> str:
        return f"list_transform({arr}, lambda {body})"

    def dbl(x: float) -> str:
        return f"CAST({x!r} AS DOUBLE)"

    W, L, N, MIX, BUT = "__rw", "__rl", "__rn", "__rmix", "__rbut"
    up, down, neg = _array(BOOSTERS_UP), _array(BOOSTERS_DOWN), _array(NEGATIONS)

    def isup(w: str) -> str:
        return f"(upper({w}) = {w} AND lower({w}) <> {w})"

    def caps(word: str, sign_of: str) -> str:
        return (f"(CASE WHEN {MIX} AND {isup(word)} THEN (CASE WHEN {sign_of} > 0 THEN {dbl(C_INCR)} "
                f"ELSE {dbl(-C_INCR)} END) ELSE 0.0 END)")

    def step(v: str, j: str, dist: str) -> str:
        wj, lj = at(W, j), at(L, j)
        s0 = (f"(CASE WHEN {has(up, lj)} THEN {dbl(B_INCR)} WHEN {has(down, lj)} THEN {dbl(B_DECR)} "
              f"ELSE 0.0 END)")
        scalar = (f"(CASE WHEN {s0} = 0.0 THEN 0.0 ELSE (CASE WHEN {v} < 0 THEN -{s0} ELSE {s0} END) "
                  f"+ {caps(wj, v)} END)")
        damp = f"{at(_damp(), dist)}"
        boosted = f"(CASE WHEN {lookup(lj)} IS NULL THEN {v} + {scalar} * {damp} ELSE {v} END)"
        denied = f"{has(neg, lj)} OR instr(lower({wj}), {_lit(NOT_SUFFIX)}) > 0"
        # bind the boosted value once
        negated = f"b_: (CASE WHEN {denied} THEN b_ * {dbl(N_SCALAR)} ELSE b_ END)"
        return f"({tr('[' + boosted + ']', negated)})[1]"

    lp, wp = at(L, "p"), at(W, "p")
    base = lookup(lp)
    v0 = f"({base} + {caps(wp, base)})"
    loop = fold(seq("1", "3"), v0, f"v, dist: CASE WHEN p - dist < 1 THEN v ELSE {step('v', 'p - dist', 'dist')} END")
    val = (f"(CASE WHEN {base} IS NULL OR {has(up, lp)} OR {has(down, lp)} THEN 0.0 ELSE {loop} END)")
    but = (f"(CASE WHEN {BUT} = 0 THEN 1.0 WHEN p < {BUT} THEN {dbl(BUT_BEFORE)} "
           f"WHEN p > {BUT} THEN {dbl(BUT_AFTER)} ELSE 1.0 END)")
    vals = tr(seq("1", N), f"p: {val} * {but}")
    total = f"(CASE WHEN {N} = 0 THEN 0.0 ELSE {fold(vals, '0.0', 'a, x: a + x')} END)"
    excl = f"(length({text}) - length(replace({text}, '!', '')))"
    ques = f"(length({text}) - length(replace({text}, '?', '')))"
    ep = (f"(least({excl}, {EXCLAIM_MAX}) * {dbl(EXCLAIM_WEIGHT)} + CASE WHEN {ques} > 1 THEN "
          f"(CASE WHEN {ques} <= 3 THEN {ques} * {dbl(QUESTION_WEIGHT)} ELSE {dbl(QUESTION_MAX_WEIGHT)} END) "
          f"ELSE 0.0 END)")
    s = "__rs"
    emph = f"(CASE WHEN {s} = 0.0 THEN 0.0 WHEN {s} > 0 THEN {s} + {ep} ELSE {s} - {ep} END)"
    comp = f"greatest(-1.0, least(1.0, {emph} / sqrt({emph} * {emph} + {dbl(COMPOUND_ALPHA)})))"
    caps_found = f"len(list_filter({W}, lambda w: {isup('w')}))"
    return [
        (W, f"coalesce(regexp_extract_all({text}, {_lit(WORD_PATTERN)}), []::VARCHAR[])"),
        (L, tr(W, f"w: replace(lower(w), {_lit(APOSTROPHE)}, '')")),
        (N, f"len({W})"),
        (MIX, f"({caps_found} > 0 AND {caps_found} < {N})"),
        (BUT, f"coalesce(list_position({L}, {_lit('but')}), 0)"),
        (s, total),
        ("__rules_compound", f"CAST(round({comp}, {COMPOUND_DECIMALS}) AS DOUBLE)"),
    ]


def _damp() -> str:
    return "[" + ", ".join(f"CAST({d!r} AS DOUBLE)" for d in BOOSTER_DAMPING) + "]"


__all__ = ["compound_sql", "lexicon_map_sql", "WORD_PATTERN"]
