import pickle
import random

import numpy as np
from helpers import LONG_WORD, documents, same_extras

from moodcast.llm import decontaminate as dc
from moodcast.llm.words import word_hashes

VOCABULARY = [a + b + c for a in ("ba", "ko", "ri", "tu", "ze") for b in ("lan", "mor", "", "vis") for c in ("", "ta", "e")]


def edit(words, k, rng):
    words = list(words)
    for _ in range(k):
        p = rng.randrange(len(words))
        op = rng.choice("sdi")
        if op == "s":
            words[p] = rng.choice(VOCABULARY)
        elif op == "d" and len(words) > 1:
            del words[p]
        else:
            words.insert(p, rng.choice(VOCABULARY))
    return words


def brute_best(item, text):
    """Edit distance of the nearest window, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, w in enumerate(item, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (w != t)))
        row = new
    return min(row)


def items(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame(list(zip(ids, texts, strict=True)), "item_id long, text string")


def corpus(rng, n_items=12):
    bench = [[rng.choice(VOCABULARY) for _ in range(rng.randrange(8, 45))] for _ in range(n_items)]
    docs, planted = [], []
    for i in range(80):
        text = [rng.choice(VOCABULARY) for _ in range(rng.randrange(0, 90))]
        if i % 2:
            j = rng.randrange(n_items)
            share = rng.choice((0, 0.1, 0.2, 0.35))
            at = rng.randrange(len(text) + 1)
            text[at:at] = edit(bench[j], int(share * len(bench[j])), rng)
        docs.append(text)
    return bench, docs


def test_search_finds_what_brute_force_finds():
    rng = random.Random(4)
    bench, docs = corpus(rng, 20)
    block = dc.Block(list(range(len(bench))), [" ".join(b) for b in bench])
    got = block.matches([" ".join(d) for d in docs])
    found = wanted = 0
    for text, hits in zip(docs, got, strict=True):
        true = {i: brute_best(b, text) for i, b in enumerate(bench)}
        true = {i: d for i, d in true.items() if d <= dc.max_edits(len(bench[i]))}
        assert {h["item_id"] for h in hits} <= true.keys()
        assert all(h["distance"] >= true[h["item_id"]] for h in hits)
        found, wanted = found + len(hits), wanted + len(true)
    assert wanted > 20 and found >= 0.98 * wanted


def test_long_items_without_head_and_tail():
    rng = random.Random(15)
    words = [f"{a}{b}" for a in VOCABULARY for b in VOCABULARY]
    for size in (40, 60, 100, 200, 500):
        bench = [[rng.choice(words) for _ in range(size)] for _ in range(30)]
        cut = [b[size // 10:size - size // 10] for b in bench]
        ends = [[rng.choice(words) for _ in range(size // 10)] + b[size // 10:size - size // 10]
                + [rng.choice(words) for _ in range(size // 10)] for b in bench]
        inner = [edit(b, size * 3 // 20, rng) for b in bench]
        block = dc.Block(list(range(30)), [" ".join(b) for b in bench])
        for made in (cut, ends, inner):
            texts = [[rng.choice(words) for _ in range(70)] + m + [rng.choice(words) for _ in range(70)] for m in made]
            got = block.matches([" ".join(t) for t in texts])
            assert sum(i in {h["item_id"] for h in hits} for i, hits in enumerate(got)) >= 29, size
            assert all(h["distance"] <= dc.max_edits(size) for hits in got for h in hits)


def test_best_window_matches_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(300):
        item, text = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(0, 15))
        d, s, e = dc.best_window(item, text)
        assert d == brute_best(list(item), list(text)) and 0 <= s <= e <= len(text)
        assert brute_best(list(item), list(text[s:e])) == d


def test_query_rows_and_edge_cases(spark):
    item = "how many stones does the old harbour wall of Lindow hold in all"
    bench = items(spark, [item, None, "", "two words", "?!"], ids=[7, 8, 9, 10, 11])
    texts = [item, f"Before. {item.upper()}! After", None, "", LONG_WORD, "two words", "these are two words here",
             "how many stones does a new wall hold", item.replace("harbour", "sea"), f"x {item} {item}"]
    docs = documents(spark, texts)
    rows = {(r["doc_id"], r["item_id"]): r for r in dc.digest(docs, bench).collect()}
    assert rows.keys() == {(0, 7), (1, 7), (5, 10), (8, 7), (9, 7)}
    assert rows[1, 7]["start_word"] == 1 and rows[1, 7]["distance"] == 0 and rows[8, 7]["distance"] == 1
    clean = dc.clean(docs, bench)
    assert clean.columns == docs.columns
    kept = clean.collect()
    assert sorted(r["doc_id"] for r in kept) == [2, 3, 4, 6, 7] and all(map(same_extras, kept))


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    bench, texts = corpus(random.Random(8))
    table, docs = items(spark, [" ".join(b) for b in bench]), documents(spark, [" ".join(t) for t in texts])
    one = sorted(map(tuple, dc.digest(docs, table).collect()))
    blocks = list(dc.item_blocks(table, max_items=5))
    assert len(blocks) == 3 and sum(len(b.ids) for b in blocks) == len(bench)
    parts = dc.item_blocks
    monkeypatch.setattr(dc, "item_blocks", lambda b: parts(b, max_items=5))
    many = sorted(map(tuple, dc.digest(docs, table).collect()))
    key = lambda rows: {(r[0], r[1]) for r in rows}
    assert len(key(one) & key(many)) >= 0.98 * len(key(one) | key(many))


def test_blocks_are_bounded_as_built(spark, monkeypatch):
    rng = random.Random(3)
    for n, size in ((600, 50), (60, 1300), (200, 200)):
        table = items(spark, [" ".join(rng.choice(VOCABULARY) for _ in range(size)) for _ in range(n)])
        blocks = list(dc.item_blocks(table, max_starts=2048))
        assert sum(len(b.ids) for b in blocks) == n and len(blocks) >= n * (size // 12) // 2048
        for b in blocks:
            starts = sum(len(dc.anchors(len(w))) for w in b.words)
            assert starts <= 2048 and len(pickle.dumps(b)) < 2 * 1024 * 2048 + (2 << 20)
    built = []
    monkeypatch.setattr(dc.Block, "__post_init__", lambda self: built.append(len(self.ids)))
    blocks = dc.item_blocks(table, max_starts=300)
    next(blocks)
    assert len(built) == 1  # none is built before it is asked for


def test_empty_tables(spark):
    docs, bench = documents(spark, ["a b c d e f"]), items(spark, ["a b c d e f"])
    assert dc.digest(docs.limit(0), bench).count() == 0
    assert dc.digest(docs, bench.limit(0)).count() == 0 and dc.clean(docs, bench.limit(0)).count() == 1


def test_word_hashes_follow_the_words():
    texts = [None, "", " \t\n", "a", "b a", "A, b.", "x" * 200_000 + " y", "é\x1cè a"]
    flat, count = word_hashes(texts)
    words = [w for t in texts for w in ((t or "").lower().encode().translate(None, b",.").split())]
    assert len(flat) == len(words) == count.sum()
    assert len(dict(zip(words, flat.tolist(), strict=True))) == len(set(flat.tolist())) == len(set(words))
    assert len(word_hashes([])[0]) == 0
