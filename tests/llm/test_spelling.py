"""Spelling variants against all pairs of words."""

import random
from collections import Counter
from zlib import crc32

import pytest

from moodcast.llm import spelling
from tests.llm.helpers import LONG_WORD, PROSE, documents


def distance_is_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1:] or (len(a) == len(b) and a[i + 1:] == b[i + 1:])


def plain_counts(rows):
    """Letters by their code points, from the contract."""
    count = Counter()
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "a" <= c <= "z" or "A" <= c <= "Z" or "À" <= c <= "ÿ":
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
                continue
            if run:
                h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 199 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                if len(run) >= 6:
                    count[run] += 1
            run = ""
    return {w: n for w, n in count.items() if n >= 5}


def plain(count):
    near = {w: [] for w in count}
    some = sorted(count)
    for i, a in enumerate(some):
        for b in some[:i]:
            if abs(len(a) - len(b)) < 2 and distance_is_one(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w in count:
        best = min(near[w], key=lambda x: (-count[x], x), default=None)
        form[w] = best if best and count[best] >= 5 * count[w] else None
    out = set()
    for w in count:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, count[w], len(near[w]), count.get(form[w])))
    return out


def found(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def typed(rng, w):
    """The word with one random edit."""
    i, c = rng.randrange(len(w) + 1), rng.choice("abcé")
    return rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]])


@pytest.mark.parametrize("common", [0, 64])
def test_all_near_words_are_found(spark, monkeypatch, common):
    monkeypatch.setattr(spelling, "COMMON", common)
    rng = random.Random(common)
    base = ["".join(rng.choices("abcdeé", k=rng.randint(5, 9))) for _ in range(150)]
    base += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "abababab", "bababab", "ababababab", "straße", "straßen", "ÿÿÿÿÿÿ"]
    words = {w: rng.randint(1, 6) ** 3 for w in base}
    for _ in range(2):
        words |= {typed(rng, w): rng.randint(1, 60) for w in list(words)}
    text = [f"{w} " * n for w, n in words.items()]
    rows = list(enumerate(text))
    count = plain_counts(rows)
    want = plain(count)
    assert sum(bool(x[4]) for x in want) > 100
    assert found(spelling.digest(documents(spark, text))) == want


def test_chains_of_forms(spark):
    texts = ["lettera " * 5, "letterab " * 25, "letterabc " * 125, "letterabcd " * 700, "letterabce " * 700, "1letterx2letterx3 " * 10]
    got = {r.word: r for r in spelling.digest(documents(spark, texts)).collect()}
    rows = list(enumerate(texts))
    assert set(map(tuple, got.values())) == plain(plain_counts(rows))
    assert got["lettera"].root == "letterabcd" and got["letterabc"].form == "letterabcd"
    assert got["letterabcd"].root == "letterabcd" and got["letterabcd"].form is None


def test_hard_rows(spark):
    texts = [None, "", " ", "12 34", PROSE * 9, PROSE.upper() * 9, LONG_WORD * 2, (LONG_WORD + " ") * 6, LONG_WORD[1:] + " b"] * 6
    texts += ["ÀÉÎÕÜ× ÷÷÷÷÷÷ naïveté NAÏVETÉ " * 6, "Ŀatin Ωmegas " * 6]
    ids = [None if i % 5 == 3 else i // 2 for i in range(len(texts))]
    want = plain(plain_counts(zip(ids, texts, strict=True)))
    assert found(spelling.digest(documents(spark, texts, ids))) == want
    assert found(spelling.digest(documents(spark, []))) == set() == found(spelling.digest(documents(spark, ["one"])))


def test_sides_of_a_word_have_the_same_key_in_its_near_words():
    import numpy as np
    at = np.arange(8)
    upto, since = spelling.side_keys("abcéef", at, at)
    more, shifted = spelling.side_keys("abcéxef", np.arange(9), np.arange(9))
    assert (upto[:6] == more[:6]).all() and not set(upto[6:]) & set(more)
    assert (since[5:] == shifted[6:]).all() and not set(since[:5]) & set(shifted)


def test_lists_stay_short_where_words_share_their_ends(spark):
    rng = random.Random(2)
    middle = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(3000)]
    words = sorted({f"inter{m}ation" for m in middle})
    table = spark.createDataFrame([(i, w, 9) for i, w in enumerate(words)], "id long, word string, n long")
    entered = spelling.entries(table)
    found = spelling.lookups(entered).withColumnRenamed("id", "a").join(entered, ["key", "size"])
    assert found.count() < 100 * len(words)


def test_query_on_a_given_table(spark):
    from moodcast.llm import queries
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert found(queries.op12_spelling(spark, "/root/testdata/sf0.001")) == plain(plain_counts(map(tuple, rows)))
