import hashlib
import random

from helpers import LONG_WORD, documents, same_extras

from moodcast.llm import line_dedup as ld

SPACE = " \t\n\x0b\f\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(docs):
    holders = {}
    for i, t in docs:
        for k in {key(s) for s in (t or "").split("\n")}:
            if len(k) >= 20:
                holders.setdefault(k, []).append(i)
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [s for s in lines if not (len(holders.get(key(s), ())) >= 3 and i < max(holders[key(s)]))]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def test_matches_brute_force(spark):
    rng = random.Random(5)
    pool = ["A line that is common to many texts", "  a line that is COMMON to many texts\t", "short", "", " ",
            "Émile writes the very same ending line", "émile writes the very same ending line", "x" * 20, "X" * 20, "y" * 19,
            "another line of more than twenty characters", LONG_WORD, "tail\r"]
    docs = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(0, 9)))) for i in range(60)] + [(60, None), (61, "")]
    got = ld.digest(documents(spark, [t for _, t in docs], [i for i, _ in docs])).collect()
    assert sorted(map(tuple, got)) == brute(docs)


def test_stage_keeps_other_columns_and_nulls(spark):
    line = "this line is in all of the documents"
    docs = documents(spark, [line, line + "\nown", line, None, ""], ids=[1, 2, 3, None, 5])
    out = ld.dedup_lines(docs)
    rows = {r["doc_id"]: r for r in out.collect()}
    assert out.columns == [*docs.columns, "ld_dropped"]  # ld_lines takes the place of the old one
    assert rows[1]["text"] == "" and rows[2]["text"] == "own" and rows[3]["text"] == line
    assert rows[None]["text"] is None and rows[5]["text"] == ""
    assert all(same_extras(r, ("ld_lines",)) for r in rows.values())
    assert rows[2]["ld_lines"] == 2


def test_repeated_rows_are_documents(spark):
    line = "the same line of the same document again"
    rows = ld.dedup_lines(documents(spark, [line] * 3, ids=[4, 4, 4])).collect()
    assert [r["text"] for r in rows] == [line] * 3
    rows = ld.dedup_lines(documents(spark, [line] * 4, ids=[4, 4, None, 9])).collect()
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in rows)) == [
        (False, 4, ""), (False, 4, ""), (False, 9, line), (True, 0, "")]


def test_empty_table(spark):
    assert ld.digest(documents(spark, ["a"]).limit(0)).count() == 0
