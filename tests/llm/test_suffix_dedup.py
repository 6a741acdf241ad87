import hashlib
import random

import numpy as np
from helpers import documents

from moodcast.llm import suffix_dedup as sd


def brute(rows, length=sd.LENGTH):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = {}
    for _, b in raw:
        for p in range(len(b) - length + 1):
            s = b[p:p + length]
            seen[s] = seen.get(s, 0) + 1
    out = []
    for i, b in raw:
        gone = np.zeros(len(b) + 1, int)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p] += 1
                gone[p + length if p + length <= len(b) else len(b)] -= 1
        gone = np.cumsum(gone)[:-1] > 0
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=70):
    rng = random.Random(seed)
    say = lambda k: " ".join(rng.choice(["tar", "ölig", "mist", "quay", "漁", "vane", "cob"]) for _ in range(k))
    shared = [say(60), say(90), say(45), say(41)]
    docs = []
    for _ in range(n):
        kind = rng.random()
        if kind < 0.2 and docs:
            t = rng.choice(docs)
            at = rng.randrange(len(t) + 1)
            t = t[:at] + rng.choice(["", "x", "changed"]) + t[at + rng.randrange(3):]  # a near copy
        elif kind < 0.6:
            s = rng.choice(shared)
            t = say(rng.randrange(60)) + s[rng.randrange(9):len(s) - rng.randrange(9)] + say(rng.randrange(60))
        elif kind < 0.7:
            t = rng.choice(["a", "ab", "x y "]) * rng.randrange(0, 400)
        else:
            t = say(rng.randrange(120))
        docs.append(t)
    return docs


def test_matches_brute_force(spark):
    for seed in (1, 2):
        rows = list(enumerate(corpus(seed)))
        rows += [(1000, None), (1001, ""), (1002, rows[0][1]), (1003, "z" * 200), (1004, "q" * 201), (1005, "w" * 199)]
        got = sd.digest(documents(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
        assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_grams_with_many_contexts_go_row_by_row(spark):
    rows = list(enumerate(corpus(3, 50)))
    table = documents(spark, [t for _, t in rows], [i for i, _ in rows])
    out = sd.removed(table, group_contexts=1).collect()
    assert sorted((r["did"], r["sd"]["n_removed"]) for r in out) == sorted((r[0], r[2]) for r in brute(rows))


def test_texts_longer_than_a_slice(spark, monkeypatch):
    """The worker's slices are no limit: the same bytes, cut anywhere."""
    rng = np.random.default_rng(4)
    data = rng.integers(97, 123, 9000).astype(np.uint8)
    data[6000:6700] = data[100:800]
    whole = sd.covers(data, np.arange(len(data) - sd.LENGTH + 1))
    monkeypatch.setattr(sd, "SLICE", 1000)
    parts = [(at, c) for at, c in sd._runs(data.tobytes())]
    starts = lambda lo, hi: [p for a, b in zip(lo, hi, strict=True) for p in range(a, b + 1)]
    assert [p + at for at, c in parts for p in starts(c[0], c[1])] == starts(whole[0], whole[1])
    place = {int(p) for p in whole[2]}
    assert {int(p) + at for at, c in parts for p in c[2]} == place


def test_repeated_and_null_ids(spark):
    text = " ".join(str(i) for i in range(200))
    other = " ".join(str(i) for i in range(500, 700))
    rows = [(1, text), (1, other), (None, text), (None, "short"), (2, other), (2, other)]
    got = sd.digest(documents(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_many_null_ids(spark):
    text = " ".join(str(i) for i in range(130))
    other = " ".join(str(i * 7) for i in range(300, 420))
    rows = [(None, text)] * 150 + [(7, text[:260] + other)] + [(None, other[30:])] + [(None, "z" * 199 + str(i)) for i in range(40)]
    got = sd.digest(documents(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_rows_with_null_ids_have_ids_of_their_own(spark):
    texts = [f"text {i}" for i in range(2000)] + [None, ""]
    rows = sd.keyed(documents(spark, texts, [None] * len(texts)))
    assert rows.select("did").distinct().count() == len(texts) == rows.select("thash").distinct().count()
    assert rows.where(f"did >= {sd.LOWEST + sd.NULL_IDS}").isEmpty()


def test_equal_strings_share_their_sampled_place():
    rng = np.random.default_rng(7)
    s = rng.integers(0, 256, 700).astype(np.uint8)
    a = np.concatenate((rng.integers(0, 256, 333).astype(np.uint8), s))
    b = np.concatenate((s, rng.integers(0, 256, 91).astype(np.uint8)))
    where = []
    for data, shift in ((a, 333), (b, 0)):
        lo, hi, place, _, _ = sd.covers(data, np.arange(len(data) - sd.LENGTH + 1))
        where.append({p - shift: int(q) - shift for x, y, q in zip(lo, hi, place, strict=True) for p in range(x, y + 1)})
    assert all(where[0][p] == where[1][p] for p in range(len(s) - sd.LENGTH + 1))


def test_empty_table(spark):
    assert sd.digest(documents(spark, ["a"]).limit(0)).count() == 0
