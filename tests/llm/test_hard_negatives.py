"""Hard negatives against a plain search, bounds against exact scores."""

import math
import random

import numpy as np
import pytest

from moodcast.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id long, own string, score long, rank string"


def table(spark, rows, schema=SCHEMA):
    extra = (1, "o", 2, "r")
    return spark.createDataFrame([(*r, *extra) for r in rows], schema).repartition(3)


def plain(rows):
    """All hits, from the contract, in Python's integers."""
    known = []
    for vec_id, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        if vec_id is not None and vec_id % 7 == 0:
            label = (label + 1) % 10
        known.append((vec_id, label, [math.floor(256 * float(x)) for x in v]))
    out = set()
    last = lambda x: (x[0] * -1, x[1] is None, x[1] or 0)
    for a_id, a_label, a in known:
        if a_id is None or a_id % 100:
            continue
        score = lambda v: min(sum(x * y for x, y in zip(a, v)), (1 << 63) - 1)  # noqa: B023, E731
        pos = sorted(((score(v), i) for i, lab, v in known if lab == a_label and i != a_id), key=last)[:5]
        neg = sorted(((score(v), i) for i, lab, v in known if lab != a_label), key=last)
        for p, p_id in pos:
            hits = [(s, i) for s, i in neg if 80 * p <= 100 * s <= 100 * p][:5]
            out |= {(a_id, p_id, k + 1, i, p, s) for k, (s, i) in enumerate(hits)}
    return out


def vectors(n, dim, seed=1, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    rows = []
    for i in range(n):
        lab = int(rng.integers(labels))
        v = (0.6 * centres[lab] + rng.normal(size=dim) * 0.5 + 0.4).astype(np.float32)
        rows.append((i, [float(x) for x in v], lab))
    return rows


def mined(df):
    return {tuple(r) for r in hn.digest(df).collect()}


@pytest.mark.parametrize("dim", [3, 64, 70])
def test_equal_to_a_plain_search(spark, dim):
    rows = vectors(450, dim, seed=dim)
    want = plain(rows)
    assert len(want) > 30 and mined(table(spark, rows)) == want


def test_many_blocks_and_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(hn, "BLOCK_BYTES", 4000)
    monkeypatch.setattr(hn, "QUERY_STEP", 10)
    rows = [(i * 10, v, k) for i, v, k in vectors(70, 8)] + [(i * 10 + 1, v, k) for i, v, k in vectors(200, 8, seed=3)]
    rows = [(i, v, k) for i, v, k in rows if i % 7]  # no changed labels: ids are scaled below
    anchors, blocks = hn._blocks(hn.packed(table(spark, rows)).where("id % 10 = 0"))
    assert len(blocks) > 5
    want = plain([(i * 10, v, k) for i, v, k in rows])
    assert len(want) > 30
    assert mined(table(spark, rows)) == {(a // 10, p // 10, r, n // 10, x, y) for a, p, r, n, x, y in want}


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.5, -0.25, 0.125]
    rows = [(0, v, 1), (100, v, 2), (200, [], 1), (300, [0.0, 0.0], 3), (400, [-0.5] * 3, 1), (500, None, 1), (600, v, None),
            (700, [0.5, None], 1), (800, [0.5, nan], 1), (900, [inf], 1), (None, v, 1), (None, v, 2)]
    rows += [(k, [0.45, -0.25, 0.125, 9.0], 1 + k % 2) for k in range(1, 40)]  # ties, longer vectors
    rows += [(51, v, 2)] * 7 + [(52, v, 1)] * 3 + [(1000, [1e30, 1e30], 1), (1001, [1e30], 1), (1002, [3e38], 2)]
    got = mined(table(spark, rows))
    assert got == plain(rows)
    assert mined(table(spark, [])) == set() == mined(table(spark, [(1, v, 1)]))
    assert mined(table(spark, [(0, v, 1)])) == set()


def test_bounds_hold_and_rule_out():
    rng = np.random.default_rng(4)
    near = rng.normal(size=(300, 128)) * 5 + 100 * np.repeat(rng.normal(size=(300, 32)), 4, axis=1)
    v = np.floor(near)
    side = hn.Side(np.arange(300), np.zeros(300, bool), np.zeros(300), np.arange(300), v, np.stack([hn.summary(x) for x in v]))
    s = hn.exact(v, v)
    for share in (0.5, 0.9, 0.99):
        low, high = np.quantile(s, share, axis=1), np.full(300, np.quantile(s, 0.999))
        left = hn.open_pairs(side, side, low, high, np.ones(s.shape, bool))
        wanted = (s >= low[:, None]) & (s <= high[:, None])
        assert (left | ~wanted).all()  # nothing wanted is ruled out
    assert left.mean() < 0.05  # and most of the rest is
    assert hn.open_pairs(side, side, s.min(axis=1) - 1.0, s.max(axis=1) + 1.0, np.ones(s.shape, bool)).all()


def test_large_components_are_scored_exactly():
    a = np.array([[2.0 ** 40 + 1, 3.0], [1e30, 0.0]])
    s = hn.exact(a, a)
    assert s[0, 0] == (1 << 63) - 1 and s[1, 1] == (1 << 63) - 1
    b = np.array([[2.0 ** 30 + 1, 2.0 ** 29 + 1]])
    assert hn.exact(b, b)[0, 0] == (2 ** 30 + 1) ** 2 + (2 ** 29 + 1) ** 2 == hn.exact(b, b, pairs=True)[0]


def test_query_equals_its_sql(spark):
    import duckdb
    from moodcast.llm import queries
    con = duckdb.connect()
    con.execute("create view embeddings as from '/root/testdata/sf0.01/embeddings.parquet'")
    want = con.execute("select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from ("
                       + queries.ORACLES["op11_hard_negatives"] + ")").fetchall()
    got = {tuple(r) for r in queries.op11_hard_negatives(spark, "/root/testdata/sf0.01").collect()}
    assert got == set(want) and len(want) == len(got)
