"""Distribution tails: Spark and DuckDB text against commons-math3."""

import duckdb
import pytest

from moodcast.functions import special as S


def _spark_values(spark, rows, schema, steps):
    df = spark.createDataFrame(rows, schema)
    return S.apply_spark(df, steps).collect()


def test_betainc_matches_reference(spark, jvm):
    rows = [(a, b, x) for a in (0.5, 1.0, 3.5, 40.0, 8000.5) for b in (0.5, 2.0, 300.0)
            for x in (1e-5, 0.2, 0.5, 0.8, 0.9999)]
    rows = [tuple(float(v) for v in r) for r in rows]
    out = _spark_values(spark, rows, "a double, b double, x double", S.betainc_steps("a", "b", "x", "v", S.SPARK))
    con = duckdb.connect()
    con.execute("CREATE TABLE t(a DOUBLE, b DOUBLE, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    dd = {r[:3]: r[3] for r in con.execute(S.apply_sql("SELECT * FROM t", S.betainc_steps("a", "b", "x", "v", S.DUCKDB))).fetchall()}
    for r in out:
        ref = jvm.special.Beta.regularizedBeta(r.x, r.a, r.b, 1e-16, 100000)
        assert r.v == pytest.approx(ref, abs=1e-11)
        assert dd[(r.a, r.b, r.x)] == pytest.approx(ref, abs=1e-11)


def test_gammaincc_matches_reference(spark, jvm):
    rows = [(s, x) for s in (0.5, 1.0, 2.5, 20.0, 900.0) for x in (1e-4, 0.5, 3.0, 25.0, 1200.0)]
    rows = [tuple(float(v) for v in r) for r in rows]
    out = _spark_values(spark, rows, "s double, x double", S.gammaincc_steps("s", "x", "v", S.SPARK))
    for r in out:
        ref = jvm.special.Gamma.regularizedGammaQ(r.s, r.x, 1e-16, 100000)
        assert r.v == pytest.approx(ref, abs=1e-11)


def test_t_and_f_tails(spark, jvm):
    rows = [(0.3, 10.0, 2.5, 2.0, 27.0), (-0.05, 1600.0, 0.7, 5.0, 174.0), (0.9, 3.0, 11.0, 1.0, 8.0)]
    df = spark.createDataFrame(rows, "r double, df double, f double, d1 double, d2 double")
    df = S.apply_spark(df, S.t_two_sided_steps("r", "df", "pt", S.SPARK))
    for row in S.apply_spark(df, S.f_upper_steps("f", "d1", "d2", "pf", S.SPARK)).collect():
        t = abs(row.r) * (row.df / (1 - row.r ** 2)) ** 0.5
        ref_t = 2 * (1 - jvm.distribution.TDistribution(row.df).cumulativeProbability(t))
        ref_f = 1 - jvm.distribution.FDistribution(row.d1, row.d2).cumulativeProbability(row.f)
        assert row.pt == pytest.approx(ref_t, abs=1e-10)
        assert row.pf == pytest.approx(ref_f, abs=1e-10)


def test_chi2_and_normal_tails(spark, jvm):
    df = spark.createDataFrame([(3.84, 1.0, 1.96), (7.0, 2.0, 0.3), (0.0, 0.0, -1.0)], "c double, k double, z double")
    df = S.apply_spark(df, S.chi2_upper_steps("c", "k", "pc", S.SPARK))
    rows = S.apply_spark(df, S.normal_two_sided_steps("z", "pz", S.SPARK)).collect()
    for row in rows[:2]:
        ref = 1 - jvm.distribution.ChiSquaredDistribution(row.k).cumulativeProbability(row.c)
        assert row.pc == pytest.approx(ref, abs=1e-10)
        ref_z = 2 * (1 - jvm.distribution.NormalDistribution().cumulativeProbability(row.z))
        assert row.pz == pytest.approx(min(1.0, ref_z), abs=1e-10)
    assert rows[2].pc == 1.0 and rows[2].pz == 1.0
