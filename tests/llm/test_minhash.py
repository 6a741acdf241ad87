import random

import numpy as np
from helpers import LONG_WORD, documents, same_extras

from moodcast.llm import minhash as mh
from moodcast.llm.components import components
from moodcast.llm.words import word_hashes


def brute_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(words, k, rng):
    words = list(words)
    for _ in range(k):
        op = rng.choice("sdi")
        at = rng.randrange(len(words) + 1)
        if op == "i" or not words:
            words.insert(at, rng.choice("uvwxyz"))
        elif op == "s":
            words[at % len(words)] = rng.choice("uvwxyz")
        else:
            del words[at % len(words)]
    return words


def test_banded_alignment_matches_the_full_table():
    rng = random.Random(1)
    for _ in range(800):
        n = rng.choice((0, 1, 3, 20, 45))
        a = [rng.choice("abcdefgh"[:rng.choice((2, 8))]) for _ in range(n)]
        b = edited(a, rng.randrange(9), rng) if rng.random() < 0.8 else [rng.choice("ab") for _ in range(rng.randrange(40))]
        most = rng.randrange(14)
        x, y = (np.array([ord(c) for c in w], np.uint64) for w in (a, b))
        assert mh.edits_within(x, y, most) == min(brute_distance(a, b), most + 1)


def corpus(rng, families=25):
    texts = []
    passage = [f"shared{i}" for i in range(60)]
    for f in range(families):
        size = rng.choice((8, 30, 120, 400))
        base = [f"w{rng.randrange(3000)}" for _ in range(size)]
        if f % 3 == 0:
            base[size // 2:size // 2] = passage
        for _ in range(rng.randrange(1, 6)):
            texts.append(edited(base, int(rng.choice((0, 0.02, 0.05, 0.1)) * len(base)), rng))
    return [" ".join(t) for t in texts]


def brute_classes(ids, texts):
    words = [t.lower().split() for t in texts]
    label = list(range(len(texts)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            longest = max(len(words[i]), len(words[j]))
            if longest and abs(len(words[i]) - len(words[j])) <= 0.2 * longest and find(i) != find(j) \
                    and brute_distance(words[i], words[j]) <= 0.2 * longest + 1e-9:
                label[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for k, i in enumerate(ids):
        least[find(k)] = min(least.get(find(k), i), i)
    return {i: least[find(k)] for k, i in enumerate(ids)}


def test_classes_match_brute_force(spark):
    texts = corpus(random.Random(3))
    ids = [10 * i + 3 for i in range(len(texts))]
    got = {r["doc_id"]: r["class_id"] for r in mh.digest(documents(spark, texts, ids)).collect()}
    want = brute_classes(ids, texts)
    assert got.keys() == want.keys()
    assert sum(got[i] == want[i] for i in ids) >= 0.98 * len(ids)
    # No class joins what brute force keeps apart.
    assert all(want[i] == want[got[i]] for i in ids)


def test_word_order_matters(spark):
    first = [f"a{i}" for i in range(40)]
    second = [f"b{i}" for i in range(40)]
    rows = mh.digest(documents(spark, [" ".join(first + second), " ".join(second + first)])).collect()
    assert {r["class_id"] for r in rows} == {0, 1}


def test_odd_rows(spark):
    same = "Nine words make a short text, all of them."
    texts = [None, "", " \n", same, same.upper(), LONG_WORD, "three small words", "Three small words!", same, same, "tail"]
    ids = [0, 1, 2, 9, 4, 5, 6, 7, None, 9, None]
    rows = mh.digest(documents(spark, texts, ids)).collect()
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["class_id"] if r["class_id"] is not None else -1)
                 for r in rows)
    assert got == [(-1, -1), (-1, 4), (0, 0), (1, 1), (2, 2), (4, 4), (5, 5), (6, 6), (7, 6), (9, 4), (9, 4)]


def test_stage_keeps_one_of_each(spark):
    same = "Nine words make a short text, all of them."
    docs = documents(spark, [same, same + " Indeed.", "", None, "else", same, "else"], ids=[5, 3, 1, 2, None, 3, None])
    out = mh.keep_one(docs)
    rows = out.collect()
    assert out.columns == docs.columns and all(map(same_extras, rows))
    assert sorted((r["doc_id"] or 0, r["text"] is None) for r in rows) == [(0, False), (1, False), (2, True), (3, False)]


def forms(rng, pairs, size=100, shared=75, swapped=13):
    """Texts on one template, two and two of them alike."""
    template = [f"form{i}" for i in range(shared)]
    texts = []
    for _ in range(pairs):
        own = [f"o{rng.randrange(10 ** 9)}" for _ in range(size - shared)]
        other = list(own)
        for at in rng.sample(range(len(own)), swapped):
            other[at] = f"o{rng.randrange(10 ** 9)}"
        texts += [" ".join(template + own), " ".join(template + other)]
    return texts


def test_pairs_on_one_template_all_meet(spark):
    texts = forms(random.Random(6), 200)
    got = {r["doc_id"]: r["class_id"] for r in mh.digest(documents(spark, texts)).collect()}
    assert got == {i: i // 2 * 2 for i in range(len(texts))}


def test_a_member_linked_to_its_head_still_meets_the_others(spark):
    rng = random.Random(9)
    chains = []
    for _ in range(12):
        text = [f"c{rng.randrange(10 ** 9)}" for _ in range(100)]
        for step in range(4):  # each is near the one before it only
            chains.append(" ".join(text))
            text = text[:step * 18] + [f"c{rng.randrange(10 ** 9)}" for _ in range(18)] + text[step * 18 + 18:]
    got = {r["doc_id"]: r["class_id"] for r in mh.digest(documents(spark, chains)).collect()}
    assert got == {i: i // 4 * 4 for i in range(len(chains))}


def test_similar_texts_share_one_of_their_first_words():
    rng = random.Random(4)
    for _ in range(400):
        a = [rng.choice("abcdefghijkl") for _ in range(rng.randrange(1, 40))]
        b = edited(a, rng.randrange(9), rng) or ["a"]
        x, y = (np.array([ord(c) for c in w], np.uint32) for w in (a, b))
        if not mh.similar(x.astype(np.uint64), y.astype(np.uint64)):
            continue
        times = {ord(c): rng.randrange(4) for c in "abcdefghijklmnopqrstuvwxyz"}
        times = {w: times.get(w, 1) for w in [*x.tolist(), *y.tolist()]}
        most = int((1 - mh.MIN_SIMILARITY) * max(len(a), len(b)) + 1e-9)
        first = [mh.rarest_words(w, times)[:most + 1] for w in (x, y)]
        assert np.isin(*first).any()


def packed(spark, texts):
    flat, count = word_hashes(texts)
    short = (flat >> np.uint64(32)).astype(np.uint32)
    rows = [(i, w.tobytes(), len(w), *bits) for i, (w, bits) in
            enumerate(zip(np.split(short, np.cumsum(count)[:-1]), mh.signatures(short, count).tolist(), strict=True))]
    return spark.createDataFrame(rows, "node long, words binary, n long, " + ", ".join(f"{s} long" for s in mh.SIGNATURE))


def test_pairs_tried_grow_with_the_texts_of_a_template(spark):
    rng = random.Random(8)
    template = [f"t{i}" for i in range(70)]
    tried = []
    for n in (150, 300, 600):
        words = packed(spark, [" ".join(template + [f"o{rng.randrange(10 ** 9)}" for _ in range(30)]) for _ in range(n)])
        first = spark.createDataFrame([(i, 0, True) for i in range(1, n)], "node long, head long, more boolean")
        labels = spark.createDataFrame([], "node long, label long")
        tried.append(mh.open_pairs(mh.open_entries(first, words, labels)).count())
    assert max(tried) <= 5


def test_small_buckets_are_settled_pair_by_pair(spark):
    rows = [(1, n) for n in (10, 11, 12, 13)] + [(2, n) for n in range(20, 21 + mh.SMALL)] + [(3, 30), (3, 31), (4, 11), (4, 40)]
    held = mh.against_heads(spark.createDataFrame(rows, "key long, node long"))
    assert {r["node"] for r in held.where("more").collect()} == set(range(21, 21 + mh.SMALL))
    got = {(r["node"], r["head"]) for r in mh.pairs_to_try(held).collect()}
    assert got == ({(a, b) for a in range(10, 14) for b in range(10, a)} | {(n, 20) for n in range(21, 21 + mh.SMALL)}
                   | {(31, 30), (40, 11)})


def test_small_buckets_need_no_words(spark, monkeypatch):
    """Texts that share a bucket with an unlike one only are no entries by word."""
    made = []
    write = mh.common.written
    monkeypatch.setattr(mh.common, "written", lambda df, name: made.append(name) or write(df, name))
    texts = forms(random.Random(6), 1) + ["short one here", "short one there", "nothing else"]
    got = {r["doc_id"]: r["class_id"] for r in mh.digest(documents(spark, texts)).collect()}
    assert got == {0: 0, 1: 0, 2: 2, 3: 3, 4: 4}
    assert "omh-near" in made and "omh-entries" not in made


def test_repeated_words_count_in_signatures():
    """Two long texts that differ in how often they say the same words."""
    own = [f"w{i}" for i in range(400)]
    flat, count = word_hashes([" ".join(own + ["of"] * 200), " ".join(own + ["the"] * 200)])
    short = (flat >> np.uint64(32)).astype(np.uint32)
    plain, told = (mh.signatures(w, count, mh.FINE_BITS) for w in (short, mh.occurrences(short, count)))
    apart = [int(np.bitwise_count((b[0] ^ b[1]).view(np.uint64)).sum()) for b in (plain, told)]
    assert apart[0] == 0 and 2 * 0.2 * 600 < apart[1] <= 400


def test_labelled_signatures_never_part_similar_texts():
    """Two bits an edit, less one for each word that one text is longer."""
    rng = random.Random(17)
    for _ in range(300):
        a = [f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 200))]
        b = edited(a, rng.randrange(40), rng) or ["a"]
        flat, count = word_hashes([" ".join(a), " ".join(b)])
        names = mh.occurrences((flat >> np.uint64(32)).astype(np.uint32), count)
        for size in (mh.BITS, mh.FINE_BITS):
            bits = mh.signatures(names, count, size)
            apart = int(np.bitwise_count((bits[0] ^ bits[1]).view(np.uint64)).sum())
            assert apart <= 2 * brute_distance(a, b) - abs(len(a) - len(b))


def test_signatures_never_part_similar_texts():
    rng = random.Random(14)
    for _ in range(300):
        a = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 200))]
        b = edited(a, rng.randrange(40), rng) or ["a"]
        flat, count = word_hashes([" ".join(a), " ".join(b)])
        short = (flat >> np.uint64(32)).astype(np.uint32)
        bits = mh.signatures(short, count)
        apart = int(np.bitwise_count((bits[0] ^ bits[1]).view(np.uint64)).sum())
        assert apart <= 2 * brute_distance(a, b)


def test_a_large_group_close_to_the_bound(spark):
    # Variants of one text, the similarity of whose pairs is about 0.8.
    rng = random.Random(21)
    base = [f"b{i}" for i in range(100)]
    texts = []
    for _ in range(300):
        text = list(base)
        for at in rng.sample(range(100), 11):
            text[at] = f"v{rng.randrange(60)}"
        texts.append(" ".join(text))
    got = {r["doc_id"]: r["class_id"] for r in mh.digest(documents(spark, texts)).collect()}
    assert got == brute_classes(list(range(300)), texts)


def test_long_texts_meet_by_shared_heads(spark):
    rng = random.Random(23)
    texts = forms(rng, 6, size=700, shared=500, swapped=100)
    got = {r["doc_id"]: r["class_id"] for r in mh.digest(documents(spark, texts)).collect()}
    assert got == {i: i // 2 * 2 for i in range(len(texts))}


def replaced(rng, text, share):
    out = list(text)
    for at in rng.sample(range(len(text)), int(share * len(text))):
        out[at] = f"r{rng.randrange(400)}"  # words that others have as well
    return out


def test_long_texts_near_a_large_group_are_told_by_signature(spark, monkeypatch):
    """Texts too far from a group of long copies make no pairs with all of it."""
    made = {}
    write = mh.common.written

    def written(df, name):
        made[name] = write(df, name)
        return made[name]
    monkeypatch.setattr(mh.common, "written", written)
    rng = random.Random(31)
    base = [f"b{i}" for i in range(700)]
    texts = [replaced(rng, base, 0.05) for _ in range(60)]
    texts += [replaced(rng, base, 0.26) for _ in range(40)]
    texts += [replaced(rng, texts[99], 0.05), replaced(rng, texts[3], 0.1)]
    got = {r["doc_id"]: r["class_id"] for r in mh.digest(documents(spark, [" ".join(t) for t in texts])).collect()}
    assert got == {i: 0 if i < 60 or i == 101 else 99 if i == 100 else i for i in range(len(texts))}
    assert made["omh-entries"].where("n > 500").select("node").distinct().count() > 40
    assert made["omh-open"].count() <= len(texts)


def test_long_pairs_come_out_once(spark, monkeypatch):
    """Whatever the heads that two texts share, and however a head's members are dealt."""
    monkeypatch.setattr(mh, "SLICE", 3)
    rng = random.Random(33)
    base = [f"b{i}" for i in range(600)]
    texts = [replaced(rng, base, 0.05) for _ in range(20)]
    flat, count = word_hashes([" ".join(t) for t in texts])
    short = (flat >> np.uint64(32)).astype(np.uint32)
    fine = mh.signatures(mh.occurrences(short, count), count, mh.FINE_BITS).tolist()
    words = spark.createDataFrame(list(enumerate(fine)), "node long, fine array<long>")
    first = spark.createDataFrame([(i, h, True) for h in (0, 1) for i in range(h + 1, 20)], "node long, head long, more boolean")
    label = [0] * 12 + [12] * 4 + [16, 17, 18, 19]
    entries = spark.createDataFrame([(i, label[i], 600) for i in range(20)] * 2, "node long, label long, n long")
    got = sorted((r["node"], r["head"]) for r in mh.long_pairs(first, entries, words).collect())
    assert got == [(a, b) for a in range(20) for b in range(a) if label[a] != label[b]]


def test_scattered_edits_up_to_the_bound_meet():
    rng = random.Random(12)
    for size in (5, 6, 7, 9, 10, 20, 30, 45, 55, 60, 100, 300):
        for share in (0.15, 0.2):
            texts = []
            for _ in range(400):
                words = [f"w{rng.randrange(10 ** 9)}" for _ in range(size)]
                other = list(words)
                for at in rng.sample(range(size), max(1, int(share * size))):
                    other[at] = f"w{rng.randrange(10 ** 9)}"
                if size < 10:  # the worst place
                    other = words[:size // 2] + ["changed"] + words[size // 2 + 1:]
                texts += [" ".join(words), " ".join(other)]
            keys = mh.bucket_keys(*word_hashes(texts))
            met = [bool(np.isin(a, b).any()) for a, b in zip(keys[::2], keys[1::2], strict=True)]
            assert np.mean(met) >= 0.985, (size, share, np.mean(met))


def test_lengths_within_the_bound_share_a_class():
    for long in range(1, 3000):
        n = np.arange(max(1, int(np.ceil(mh.MIN_SIMILARITY * long - 1e-9))), long + 1)
        own, beside = mh.length_classes(n)
        assert np.all((own == own[-1]) | (beside == own[-1]))


def test_repeated_shingles_are_labelled():
    flat, count = word_hashes(["a b c d e " * 9, "a b c d e " * 3, "a b c d e", "a b", ""])
    names, n = mh._shingles(flat, count)
    assert n.tolist() == [41, 11, 1, 1, 0] and len(set(names[:41].tolist())) == 41
    assert set(names[41:52].tolist()) < set(names[:41].tolist())
    assert mh.sketches(flat, count).shape == (4, mh.SKETCHES)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    edges += [(2000, i) for i in range(2001, 2400)]
    label = {}

    def find(x):
        while label.setdefault(x, x) != x:
            x = label[x]
        return x

    for u, v in edges:
        if u != v:
            a, b = find(u), find(v)
            label[max(a, b)] = min(a, b)
    rows = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {r["node"]: r["label"] for r in rows} == {x: find(x) for x in list(label)} and len(rows) == len(label)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_empty_table(spark):
    docs = documents(spark, ["a"]).limit(0)
    assert mh.digest(docs).count() == 0 and mh.keep_one(docs).count() == 0
