"""SimHash: fingerprints against a plain version, links against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from moodcast.llm import simhash
from tests.llm.helpers import LONG_WORD, PROSE, documents, same_extras


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] * bool(words)
    bits = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def plain_components(ids, prints):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i
    x = np.array(prints, np.uint64)
    for i in range(len(x)):
        for j in np.flatnonzero(np.bitwise_count(x[i] ^ x[:i]) <= 3):
            root[find(i)] = find(int(j))
    least = {}
    for i, d in enumerate(ids):
        r = find(i)
        least[r] = min([v for v in (least.get(r), d) if v is not None], default=None)
    return [least[find(i)] for i in range(len(x))]


@pytest.mark.parametrize("chunk", [3, 4, 7, 1 << 16])
def test_fingerprint_in_chunks(monkeypatch, chunk):
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    rng = random.Random(5)
    for n in (0, 1, 2, 3, 4, 6, 7, 8, 9, 14, 40):
        text = " ".join(rng.choice(["Ab", "c", "ÀÉ", "dd"]) for _ in range(n)) + rng.choice(["", " \n", "\x0b"])
        assert simhash.fingerprint(text) == plain_fingerprint(text), (n, text)
    assert simhash.fingerprint(None) == 0 == simhash.fingerprint(" \t\n")


def test_fingerprints_are_sparks_xxhash64(spark):
    from pyspark.sql import functions as F
    got = spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0]
    assert got % (1 << 64) == simhash.fingerprint("One two THREE")


def test_every_pair_within_three_bits_meets(spark):
    rng = random.Random(7)
    some = [rng.getrandbits(64) for _ in range(60)]
    made = set(some)
    for x in some:  # chains of one, two and three bits, also within one half and at the edges
        for bits in ((1,), (2,), (3,), (3, 3), (2, 3, 1), (4,)):
            y = x
            for k in bits:
                within = rng.choice([range(64), range(32), range(32, 64), (0, 31, 32, 63)])
                y ^= sum(1 << b for b in rng.sample(list(within), k))
                made.add(y)
    made |= {0, 1, 3, 7, (1 << 64) - 1, 7 << 61}
    prints = sorted(made)
    table = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x) for i, x in enumerate(prints)], "id long, fp long")
    got = {r.fp % (1 << 64): r.component for r in simhash.component_ids(table.repartition(4)).collect()}
    want = plain_components(range(len(prints)), prints)
    assert [got[x] for x in prints] == want
    assert len(set(want)) < len(prints)


def test_links_are_verified_and_join_a_dense_ball(spark):
    centre = 0x0123456789ABCDEF
    ball = [centre] + [centre ^ 1 << i for i in range(64)] + [centre ^ 3 << i for i in range(63)]
    table = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in ball], "fp long")
    rows = simhash.links(table).collect()
    assert all((r.u ^ r.v) % (1 << 64) != 0 and ((r.u ^ r.v) % (1 << 64)).bit_count() <= 3 for r in rows)
    assert len(rows) == len({(r.u, r.v) for r in rows}) < len(ball) ** 2 / 2
    nodes = simhash.component_ids(table.selectExpr("cast(null as long) as id", "fp"))
    assert [r.component for r in nodes.collect()] == [None] * len(ball)


def test_documents_with_hard_rows(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(words, k=200)) for _ in range(6)]
    texts = [None, "", " \n ", "one", "One", "one two", PROSE * 30, LONG_WORD, LONG_WORD.upper() + " b"]
    for b in base:
        texts += [b, b + " tail", b.replace(" w7 ", " w8 "), b.upper()]
    ids = [None if i % 9 == 4 else 1000 - i // 2 for i in range(len(texts))]
    rows = simhash.with_components(documents(spark, texts, ids)).collect()
    assert len(rows) == len(texts) and all(same_extras(r) for r in rows)
    prints = [plain_fingerprint(t) for t in texts]
    want = sorted(zip(map(str, ids), prints, map(str, plain_components(ids, prints)), strict=True))
    assert sorted((str(r.doc_id), r.sh_fingerprint % (1 << 64), str(r.sh_component)) for r in rows) == want
    got = simhash.digest(documents(spark, texts, ids)).collect()
    assert sorted((str(r.doc_id), int(r.fingerprint, 16), str(r.component_id)) for r in got) == want
    assert all(len(r.fingerprint) == 16 and r.fingerprint.islower() or r.fingerprint.isdigit() for r in got)
    assert simhash.digest(documents(spark, [])).count() == 0


def test_query_on_a_given_table(spark):
    from moodcast.llm import queries
    got = {r.doc_id: r for r in queries.op13_simhash(spark, "/root/testdata/sf0.001").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    prints = [plain_fingerprint(r.text) for r in docs]
    want = plain_components([r.doc_id for r in docs], prints)
    assert [(int(got[r.doc_id].fingerprint, 16), got[r.doc_id].component_id) for r in docs] == list(zip(prints, want, strict=True))
