import pytest
from helpers import documents, same_extras

from moodcast.llm import mixing as m


def brute_targets(sizes):
    """Water filling, source by source."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: m.WEIGHT_CYCLE[i % 3] for i, s in enumerate(order)}
    cap = {s: 2.0 * sizes[s] for s in order}
    target, rest, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if cap[s] < level * weight[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: cap[s] for s in full}
        rest -= sum(cap[s] for s in full)
        open_ -= full
    return target


CASES = [{"a": 100, "b": 100, "c": 100}, {"a": 1000, "b": 10, "c": 500, "d": 3, None: 77},
         {"a": 0, "b": 50, "c": 1}, {"only": 9}, {"a": 5, "b": 5000, "c": 5000, "d": 5000, "e": 1}]


@pytest.mark.parametrize("sizes", CASES)
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r["source"]: r["target"] for r in m.source_targets(rows).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - want[s]) < 1e-6 for s in want)


def corpus(spark, n=600):
    texts = [" ".join(["w"] * (1 + (i * 37) % 90)) for i in range(n)] + [None, "", "  "]
    sources = [None if i % 31 == 0 else "abcdefg"[0 if i % 3 == 0 else i % 7] for i in range(n)] + ["a", "b", None]
    return documents(spark, texts, sources=sources)


def test_taken_is_near_the_target(spark):
    rows = m.digest(corpus(spark)).collect()
    taken, target, size = {}, {}, {}
    for r in rows:
        s = r["source"]
        taken[s] = taken.get(s, 0) + r["taken"]
        target[s], size[s] = r["target"], r["source_size"]
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    assert all(abs(taken[s] - target[s]) <= 181 for s in target)
    assert abs(sum(target.values()) - 1.5 * sum(size.values())) < 1e-6
    assert sum(taken.values()) <= sum(target.values()) + 1e-6


def test_the_queue_is_cut_where_the_budget_ends(spark):
    """Brute force: all entries by finish time, taken while they fit."""
    rows = m.digest(corpus(spark)).collect()
    budget = sum({r["source"]: r["target"] for r in rows}.values())
    entries = []
    for r in rows:
        if r["size"]:
            for p in range(2):
                entries.append((r["virtual_finish"] + p * r["source_size"] / r["target"], p, r["doc_id"], r["size"]))
    total, want = 0, {}
    for at, _, doc, size in sorted(entries):
        total += size
        if total > budget:
            break
        want[doc] = want.get(doc, 0) + size
    got = {r["doc_id"]: r["taken"] for r in rows if r["taken"]}
    off = sum(abs(got.get(d, 0) - want.get(d, 0)) for d in got.keys() | want.keys())
    assert off <= 181  # entries that tie with the cut


def test_reruns_agree_whatever_the_partitions(spark):
    one, two = m.digest(corpus(spark)).collect(), m.digest(corpus(spark).repartition(11)).collect()
    key = lambda rows: sorted((r["doc_id"], r["taken"], r["source"] or "") for r in rows)
    assert key(one) == key(two)


def test_mix_keeps_columns_and_copes_with_odd_rows(spark):
    docs = documents(spark, ["a b c", "a b c", "d e", None, "f"], ids=[1, 1, None, 3, None], sources=["x", "x", None, "x", "y"])
    out = m.mix(docs)
    rows = out.collect()
    assert out.columns == [*docs.columns, "mix_target", "mix_finish", "mix_passes"]
    assert all(same_extras(r, ("mix_size",)) and r["text"] for r in rows)
    same = [r for r in rows if r["doc_id"] == 1]
    assert len(same) in (0, 2) and len({r["mix_passes"] for r in same}) <= 1
    finish = [r["mix_finish"] for r in rows]
    assert finish == sorted(finish)


def test_every_row_is_a_document(spark):
    texts = ["a b c d e", "a b c d e f g", "x", "x", "a b c d e", None, "y z"] * 3
    ids = [None, None, 1, 1, 1, None, 2] * 3
    docs = documents(spark, texts, ids, sources=["s"] * len(texts))
    got = m.digest(docs).collect()
    size = [len((t or "").split()) for t in texts]
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted(zip(map(str, ids), size, strict=True))
    assert all(r["source_size"] == sum(size) and r["taken"] <= 2 * r["size"] for r in got)
    assert abs(sum(r["taken"] for r in got) - 1.5 * sum(size)) <= 2 * max(size)
    taken = m.mix(docs).collect()
    assert all(r["mix_size"] == len(r["text"].split()) for r in taken)
    assert {(r["doc_id"], r["text"]) for r in taken} <= set(zip(ids, texts, strict=True))


def test_empty_tables(spark):
    docs = documents(spark, ["a"]).limit(0)
    assert m.digest(docs).count() == 0 and m.mix(docs).count() == 0
    assert [r["taken"] for r in m.digest(documents(spark, [None, ""])).collect()] == [0, 0]
