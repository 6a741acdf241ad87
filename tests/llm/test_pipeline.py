import random

import pytest
from helpers import PROSE

import __spark_entry__ as entry
import corpus_pipeline as cp
from moodcast.llm import queries


def prose(rng, n):
    return " ".join(rng.choice(["river", "meadow", "winter", "harbour", "quiet", "stone", "lantern", "barley", "of", "and", "the"])
                    + str(rng.randrange(40)) * (rng.random() < 0.6) for _ in range(n)) + "."


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(9)
    bench = [prose(rng, 30) for _ in range(5)]
    common_line = "This very line stands at the foot of every page"
    rows = [(i, prose(rng, rng.randrange(80, 160)) + "\n" + common_line, "en", f"src{i % 4}") for i in range(80)]
    rows += [(100, rows[3][1] + " indeed", "en", "src1"), (101, rows[5][1], "en", "src2")]  # near and exact copy
    rows += [(102, prose(rng, 30) + " " + bench[2] + " " + prose(rng, 30), "en", "src1")]
    rows += [(103, "# $ % & * | < > " * 20, "en", "src0"), (104, "short", "en", None), (105, None, None, None),
             (106, PROSE * 1, "en", None)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    docs = spark.createDataFrame([(i, t, lang, s, len(t) if t else None) for i, t, lang, s in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(folder + "/documents.parquet")
    spark.createDataFrame(list(enumerate(bench)), "item_id long, text string").write.parquet(folder + "/benchmark.parquet")
    return folder


def test_each_stage_acts_on_what_the_last_kept(spark, tables, tmp_path):
    docs = spark.read.parquet(tables + "/documents.parquet")
    columns, seen = docs.columns, {}
    for i, (name, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, tables)
        if i < len(cp.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen[name] = {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "mixing"]
    assert not {103, 104, 105} & seen["quality_rules"].keys() and 102 in seen["quality_rules"]
    # The common line stays in the largest document that has it; 100 ends it otherwise.
    assert {i for i, t in seen["line_dedup"].items() if "This very line" in t} == {100, 101}
    gone = seen["line_dedup"].keys() - seen["near_dedup"].keys()
    assert gone == {100, 101}
    assert seen["near_dedup"].keys() - seen["decontamination"].keys() == {102}
    assert seen["mixing"].keys() <= seen["decontamination"].keys()


def test_run_is_the_stages_in_turn(spark, tables):
    rows = cp.run(spark, tables).collect()
    docs = spark.read.parquet(tables + "/documents.parquet")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, tables)
    key = lambda rows: sorted((r["doc_id"], r["text"], r["mix_passes"]) for r in rows)
    assert key(rows) == key(docs.collect())


def test_counts_of_characters_follow_the_text(spark, tables):
    docs = spark.read.parquet(tables + "/documents.parquet")
    assert all(r["n_chars"] == len(r["text"]) for r in cp.STAGES[1][1](spark, docs.na.drop(subset=["text"]), tables).collect())


def test_registration():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert names["pipeline"] is cp.run and set(queries.ORACLES) <= set(names)
