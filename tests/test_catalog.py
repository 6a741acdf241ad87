"""Every catalog query against its DuckDB oracle on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

from conftest import SF0001  # noqa: E402

NAMES = sorted(E.queries())
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF0001)


def test_entry_is_the_flagship(spark):
    df = E.entry(spark)
    rows = {r.sentiment: r for r in df.collect()}
    assert set(rows) == {"negative", "neutral", "positive"}
    # n, slope and r of the flagship at sf0.001, worked out with numpy
    assert rows["negative"].n == 100 and rows["negative"].slope == pytest.approx(0.689270, abs=1e-6)
    assert rows["neutral"].r_value == pytest.approx(-0.015107, abs=1e-6)
    assert rows["positive"].n == 83


def test_every_sql_entry_is_a_query():
    assert set(SQL) <= set(NAMES)
    assert len(SQL) >= 60


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF0001)
    rows = [tuple(r) for r in df.collect()]
    assert df.columns == list(dict.fromkeys(df.columns)), "duplicate column names"
    if name not in SQL:
        assert len(rows) > 0
        return
    rel = con.execute(SQL[name])
    drows = rel.fetchall()
    msg = compare(rows, df.columns, drows, [d[0] for d in rel.description])
    assert msg is None, msg


def test_forest_scores_the_hash_test_part(spark):
    split = E.queries()["train_test_split"](spark, SF0001)
    n_test = split.where("part = 'test'").count()
    acc = E.queries()["rf_accuracy"](spark, SF0001).first()
    preds = E.queries()["rf_predictions"](spark, SF0001)
    assert acc.n_test == n_test == preds.count()
    assert 0.0 <= acc.accuracy <= 1.0
    assert set(r.prediction for r in preds.collect()) <= {0.0, 1.0, 2.0}
