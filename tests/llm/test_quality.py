import re

import numpy as np
from helpers import LONG_WORD, PROSE, documents, same_extras

from moodcast.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    wins = {}
    for i in range(len(words) - 7):
        wins.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {j for at in wins.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    lines = [s for s in text.split("\n") if WORD.search(s)]
    return (len(words), sum(map(len, words)), sum(c in q.SYMBOLS for c in text), len(lines) - len(set(lines)), len(covered))


TEXTS = [None, "", " \n\t ", "one", PROSE, PROSE * 3, "a b c d e f g h " * 40, "# $ % & | < > * " * 10, LONG_WORD,
         "línea única\nlínea única\nótra\n\n\n", "A b c d e\x1cf", PROSE.upper(), "It " * 9 + "was " * 50,
         "1 22 333 " * 20, "a b c d e f g a b c d e f g h"]


def test_measures_match_brute_force():
    got = q.measure(TEXTS)
    cols = ("q_words", "q_word_chars", "q_symbols", "q_dup_lines", "q_repeat_words")
    assert [tuple(int(got[c][i]) for c in cols) for i in range(len(TEXTS))] == [brute(t) for t in TEXTS]


def test_measures_of_random_words():
    rng = np.random.default_rng(3)
    for n in (7, 8, 9, 60, 400):
        texts = [" ".join(rng.choice(list("abc"), n)) for _ in range(20)]
        got = q.measure(texts)["q_repeat_words"]
        assert got.tolist() == [brute(t)[4] for t in texts]


def test_digest_verdicts(spark):
    rows = {r["doc_id"]: r for r in q.digest(documents(spark, TEXTS)).collect()}
    for i, t in enumerate(TEXTS):
        words, repeated = brute(t)[0], brute(t)[4]
        assert rows[i]["base_failed"] == (words < 20 or 100 * repeated > 30 * words)
        assert not (rows[i]["kept"] and rows[i]["base_failed"])
    assert rows[4]["kept"] and not rows[11]["kept"] and not rows[7]["kept"]


def test_policies_and_ablations_use_stored_bits(spark):
    led = q.ledger(documents(spark, TEXTS).select("doc_id", "text")).persist()
    kept = {r["doc_id"] for r in q.apply_policy(led, q.V1).where("q_kept").collect()}
    table = {r["rule"]: r for r in q.ablations(led, q.V1).collect()}
    bits = {r["doc_id"]: r["q_ledger"]["bits"] for r in led.collect()}
    for rule, row in table.items():
        assert row["n_failed"] == sum(b & q.BIT[rule] != 0 for b in bits.values())
        assert row["n_kept_without"] == sum(b & q.V1.mask & ~q.BIT[rule] == 0 for b in bits.values())
    assert kept == {i for i, b in bits.items() if not b}
    led.unpersist()


def test_filter_keeps_rows_whole(spark):
    docs = documents(spark, [PROSE, PROSE, None, "junk"], ids=[1, 1, None, 4])
    out = q.keep_good(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == 2 and all(same_extras(r) and r["text"] == PROSE for r in rows)


def test_empty_table(spark):
    docs = documents(spark, [PROSE]).limit(0)
    assert q.digest(docs).count() == 0 and q.keep_good(docs).count() == 0
    assert {r["n_failed"] for r in q.ablations(q.ledger(docs), q.V1).collect()} == {0}
