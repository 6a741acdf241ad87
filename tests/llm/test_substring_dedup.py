import random
import re

from helpers import LONG_WORD, documents, same_extras

from moodcast.llm import substring_dedup as ss

CAPITAL = re.compile("[A-ZÀ-ÞΑ-ΩА-Я]")


def brute_units(text):
    """(start, end, normalised words) of every unit, word by word."""
    words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    out, at = [], 0
    while at < len(words):
        end = at
        while end + 1 < len(words) and text[words[end][1] - 1] not in ".!?" and "\n" not in text[words[end][1]:words[end + 1][0]]:
            end += 1
        for b in range(at, end + 1):
            if b == at or CAPITAL.match(text[words[b][0]]):
                norm = " ".join(text[s:e] for s, e in words[b:end + 1])
                if len(norm) >= ss.MIN_CHARS and end - b + 1 >= ss.MIN_WORDS:
                    norm = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in norm)
                    out.append((words[b][0], words[end][1], norm))
        at = end + 1
    return out


def brute(rows):
    first = {}
    for i, t in sorted(rows, key=lambda r: r[0]):
        for s, _, n in brute_units(t or ""):
            first.setdefault(n, (i, s))
    out = {}
    for i, t in rows:
        spans = []
        for s, e, n in sorted(brute_units(t or "")):
            if first[n] != (i, s):
                if spans and s - spans[-1][1] < ss.MIN_CHARS:
                    spans[-1][1] = max(spans[-1][1], e)
                else:
                    spans.append([s, e])
        out[i] = [tuple(s) for s in spans]
    return out


def corpus(seed, n=60):
    rng = random.Random(seed)
    sentence = lambda: " ".join([rng.choice(["Über", "The", "Ωmega", "Дом", "one", "É"])]
                                + [rng.choice(["grain", "salt", "Tor", "wharf", "ñandú", "a"]) for _ in range(rng.randrange(1, 12))]
                                ) + rng.choice([".", "!", "?", ".", "..."])
    shared = [" ".join(sentence() for _ in range(6)) for _ in range(4)]
    docs = []
    for _ in range(n):
        parts = [sentence() + rng.choice([" ", "\n", "  ", ""]) for _ in range(rng.randrange(0, 8))]
        if rng.random() < 0.5:
            parts.insert(rng.randrange(len(parts) + 1), "and so " + rng.choice(shared) + " ")
        if rng.random() < 0.2 and docs:
            parts = [rng.choice(docs)]
        docs.append("".join(parts))
    return docs


def test_matches_brute_force(spark):
    for seed in (1, 2):
        rows = [(3 * i, t) for i, t in enumerate(corpus(seed))] + [(1, None), (2, ""), (4, LONG_WORD), (5, " . ! \n")]
        got = ss.digest(documents(spark, [t for _, t in rows], [i for i, _ in rows])).collect()
        want = brute(rows)
        text = dict(rows)
        for r in got:
            spans = [(s["start"], s["end"]) for s in r["removed"]]
            assert spans == want[r["doc_id"]]
            whole = text[r["doc_id"]]
            if whole is None:
                assert r["text"] is None
                continue
            bounds = [0, *(p for s in spans for p in s), len(whole)]
            assert r["text"] == "".join(whole[a:b] for a, b in zip(bounds[::2], bounds[1::2]))
            assert (r["n_chars"], r["n_removed"]) == (len(whole), sum(b - a for a, b in spans))


def test_a_passage_inside_a_sentence_goes(spark):
    passage = ("Many a mild evening was spent on the old stone bridge below the mill. Nobody hurried there at all. "
               "Even the dogs slept until the last boat had gone by in silence.")
    rows = ss.digest(documents(spark, [passage, "it began with " + passage + " and then went on."])).collect()
    got = {r["doc_id"]: r["text"] for r in rows}
    assert got == {0: passage, 1: "it began with  and then went on."}


def test_ids_and_columns(spark):
    line = "One plain sentence that is long enough to count."
    docs = documents(spark, [line] * 5, ids=[7, 7, None, 9, None])
    rows = ss.dedup_passages(docs).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in rows) == [(0, ""), (0, ""), (7, line), (7, line), (9, "")]
    assert all(map(same_extras, rows))


def test_passages_repeat_among_null_ids(spark):
    line = "One plain sentence that is long enough to count."
    texts = [f"{line} Another sentence which no other text has, number {w} of all." for w in ("one", "two", "three")]
    rows = ss.dedup_passages(documents(spark, texts, [None] * 3)).collect()
    assert sum(line in r["text"] for r in rows) == 1 and all("Another sentence" in r["text"] for r in rows)


def test_spans_of_any_length_are_whole():
    far = (1 << 31) - 5
    assert ss.merged([3 << 32 | 1 << 25, far << 32 | 40]) == [(3, 3 + (1 << 25)), (far, far + 40)]


def test_empty_table(spark):
    assert ss.digest(documents(spark, ["a"]).limit(0)).count() == 0
