"""Statistics operators against brute-force computations on small samples."""

import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from moodcast.functions.studentized import qtukey, tukey_sf
from moodcast.operators import anova, contingency, histogram, ranks, regression


def _frame(spark, groups):
    rows = [(g, float(v)) for g, vals in groups.items() for v in vals]
    return spark.createDataFrame(rows, "g string, v double")


def test_linregress_matches_numpy_and_t_tail(spark, jvm):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 40, 50).astype(float)
    y = 0.3 * x + rng.normal(0, 3, 50)
    df = spark.createDataFrame([("a", float(a), float(b)) for a, b in zip(x, y)], "g string, x double, y double")
    r = regression.linregress(df, "x", "y", ["g"]).first()
    slope, intercept = np.polyfit(x, y, 1)
    rr = np.corrcoef(x, y)[0, 1]
    t = rr * math.sqrt(48 / (1 - rr * rr))
    p = 2 * (1 - jvm.distribution.TDistribution(48.0).cumulativeProbability(abs(t)))
    assert r.slope == pytest.approx(slope, rel=1e-9)
    assert r.intercept == pytest.approx(intercept, rel=1e-9)
    assert r.r_value == pytest.approx(rr, rel=1e-9)
    assert r.p_value == pytest.approx(p, abs=1e-9)
    resid = y - (slope * x + intercept)
    se = math.sqrt((resid ** 2).sum() / 48 / ((x - x.mean()) ** 2).sum())
    assert r.stderr == pytest.approx(se, rel=1e-9)


def test_linregress_edge_cases(spark):
    df = spark.createDataFrame([("flat", 1.0, 1.0), ("flat", 1.0, 2.0), ("two", 1.0, 3.0), ("two", 2.0, 3.0),
                                ("two2", 1.0, 3.0), ("two2", 2.0, 5.0)], "g string, x double, y double")
    got = {r.g: r for r in regression.linregress(df, "x", "y", ["g"]).collect()}
    assert got["flat"].slope is None and got["flat"].p_value is None
    assert got["two"].p_value == 1.0 and got["two"].slope == 0.0
    assert got["two2"].p_value == 0.0 and got["two2"].r_value == pytest.approx(1.0)


def test_polyfit_matches_numpy_predictions(spark):
    rng = np.random.default_rng(3)
    x = np.linspace(2, 250, 40)
    y = np.sin(x / 40) * 10 + rng.normal(0, 0.1, 40)
    df = spark.createDataFrame([("a", float(a), float(b)) for a, b in zip(x, y)], "g string, x double, y double")
    fit = regression.polyfit(df, "x", "y", 4, ["g"])
    pred = regression.with_poly(df, fit, "x", 4, ["g"]).orderBy("x").collect()
    ref = np.polynomial.Polynomial.fit(x, y, 4)(x)
    assert np.allclose([p.poly_predict for p in pred], ref, atol=1e-7)


def test_polyfit_rank_deficient_gives_projection(spark):
    # three distinct x, degree 4: the fit passes through the group means
    rows = [("a", 1.0, 1.0), ("a", 1.0, 3.0), ("a", 2.0, 5.0), ("a", 3.0, 0.0), ("a", 3.0, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    fit = regression.polyfit(df, "x", "y", 4, ["g"])
    assert fit.first().rank == 3
    pred = {(r.x, r.y): r.poly_predict for r in regression.with_poly(df, fit, "x", 4, ["g"]).collect()}
    assert pred[(1.0, 1.0)] == pytest.approx(2.0) and pred[(2.0, 5.0)] == pytest.approx(5.0)
    assert pred[(3.0, 0.0)] == pytest.approx(1.0)


def _chi2_reference(table, correction=True):
    obs = np.array(table, dtype=float)
    exp = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    dof = (obs.shape[0] - 1) * (obs.shape[1] - 1)
    if dof == 1 and correction:
        d = exp - obs
        obs = obs + np.sign(d) * np.minimum(0.5, np.abs(d))
    return ((obs - exp) ** 2 / exp).sum(), dof


@pytest.mark.parametrize("table", [[[12, 5], [7, 9]], [[30, 10, 4], [12, 25, 8]], [[5, 9], [1, 3], [8, 2]]])
def test_chi2_matches_reference(spark, jvm, table):
    rows = [(f"r{i}", f"c{j}", v) for i, line in enumerate(table) for j, v in enumerate(line)]
    df = spark.createDataFrame(rows, "r string, c string, n long")
    cols = [f"c{j}" for j in range(len(table[0]))]
    got = contingency.chi2_test(df, "r", "c", cols, weight="n").first()
    chi2, dof = _chi2_reference(table)
    assert got.dof == dof
    assert got.chi2 == pytest.approx(chi2, rel=1e-12)
    ref_p = 1 - jvm.distribution.ChiSquaredDistribution(float(dof)).cumulativeProbability(chi2)
    assert got.p_value == pytest.approx(ref_p, abs=1e-10)


def test_chi2_transpose_invariant_and_degenerate(spark):
    table = [[30, 10, 4], [12, 25, 8]]
    rows = [(f"r{i}", f"c{j}", v) for i, line in enumerate(table) for j, v in enumerate(line)]
    df = spark.createDataFrame(rows, "r string, c string, n long")
    a = contingency.chi2_test(df, "r", "c", ["c0", "c1", "c2"], "n").first()
    b = contingency.chi2_test(df, "c", "r", ["r0", "r1"], "n").first()
    assert a.chi2 == pytest.approx(b.chi2) and a.p_value == pytest.approx(b.p_value)
    one = spark.createDataFrame([("r0", "c0", 4), ("r0", "c1", 6)], "r string, c string, n long")
    d = contingency.chi2_test(one, "r", "c", ["c0", "c1"], "n").first()
    assert d.dof == 0 and d.chi2 == 0.0 and d.p_value == 1.0


def test_anova_matches_reference(spark, jvm):
    groups = {"a": [3, 5, 4, 6, 2], "b": [7, 8, 6, 9], "c": [4, 4, 5, 3, 6, 5], "d": [10]}
    got = anova.one_way_anova(_frame(spark, groups), "g", "v").first()
    vals = [np.array(v, float) for v in groups.values()]
    allv = np.concatenate(vals)
    ssb = sum(len(v) * (v.mean() - allv.mean()) ** 2 for v in vals)
    ssw = sum(((v - v.mean()) ** 2).sum() for v in vals)
    f = (ssb / 3) / (ssw / (len(allv) - 4))
    assert got.f_stat == pytest.approx(f, rel=1e-10)
    ref = 1 - jvm.distribution.FDistribution(3.0, float(len(allv) - 4)).cumulativeProbability(f)
    assert got.p_value == pytest.approx(ref, abs=1e-10)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=3, max_size=12), st.lists(st.integers(0, 30), min_size=3, max_size=12))
def test_anova_two_groups_is_t_squared(spark, a, b):
    if np.var(a + b) == 0 or (np.var(a) == 0 and np.var(b) == 0):
        return
    got = anova.one_way_anova(_frame(spark, {"a": a, "b": b}), "g", "v").first()
    x, y = np.array(a, float), np.array(b, float)
    sp = ((len(x) - 1) * x.var(ddof=1) + (len(y) - 1) * y.var(ddof=1)) / (len(x) + len(y) - 2)
    t = (x.mean() - y.mean()) / math.sqrt(sp * (1 / len(x) + 1 / len(y)))
    assert got.f_stat == pytest.approx(t * t, rel=1e-9)


def test_tukey_pairs_and_intervals(spark):
    groups = {"negative": [3, 5, 4, 6, 2, 5], "neutral": [7, 8, 6, 9, 8], "positive": [4, 4, 5, 3, 6, 5, 4]}
    got = anova.tukey_hsd(_frame(spark, groups), "g", "v").orderBy("group1", "group2").collect()
    assert [(r.group1, r.group2) for r in got] == [("negative", "neutral"), ("negative", "positive"),
                                                   ("neutral", "positive")]
    vals = {k: np.array(v, float) for k, v in groups.items()}
    n = sum(len(v) for v in vals.values())
    mse = sum(((v - v.mean()) ** 2).sum() for v in vals.values()) / (n - 3)
    crit = qtukey(0.95, 3, n - 3)
    for r in got:
        a, b = vals[r.group1], vals[r.group2]
        se = math.sqrt(mse / 2 * (1 / len(a) + 1 / len(b)))
        assert r.meandiff == pytest.approx(b.mean() - a.mean())
        assert r.lower == pytest.approx(r.meandiff - crit * se)
        assert r.p_adj == pytest.approx(tukey_sf(abs(r.meandiff) / se, 3, n - 3))
        assert r.reject == (r.p_adj < 0.05)


def _u_brute(a, b):
    return sum(1.0 if x > y else 0.5 if x == y else 0.0 for x in a for y in b)


def test_mann_whitney_asymptotic(spark, jvm):
    rng = np.random.default_rng(7)
    a = list(rng.integers(0, 15, 30))
    b = list(rng.integers(3, 18, 25))
    got = ranks.mann_whitney(_frame(spark, {"a": a, "b": b}), "g", "v", [("a", "b"), ("b", "a")]).collect()
    by = {(r.group1, r.group2): r for r in got}
    u1 = _u_brute(a, b)
    assert by[("a", "b")].u_stat == pytest.approx(u1)
    assert by[("b", "a")].u_stat == pytest.approx(len(a) * len(b) - u1)
    assert by[("a", "b")].p_value == pytest.approx(by[("b", "a")].p_value)
    # normal approximation with tie correction and continuity
    allv = np.concatenate([a, b])
    _, counts = np.unique(allv, return_counts=True)
    n1, n2, nn = len(a), len(b), len(allv)
    sigma = math.sqrt(n1 * n2 / 12 * ((nn + 1) - (counts ** 3 - counts).sum() / (nn * (nn - 1))))
    z = (max(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / sigma
    ref = 2 * (1 - jvm.distribution.NormalDistribution().cumulativeProbability(z))
    assert by[("a", "b")].p_value == pytest.approx(min(1.0, ref), abs=1e-10)


def test_mann_whitney_exact_small_samples(spark):
    a, b = [1.5, 4.0, 7.0, 9.0], [2.0, 3.0, 5.0, 6.0, 8.0, 10.0, 11.0]
    got = ranks.mann_whitney(_frame(spark, {"a": a, "b": b}), "g", "v", [("a", "b")]).first()
    u1 = _u_brute(a, b)
    assert got.u_stat == u1
    # enumerate every split of the pooled ranks
    pooled = sorted(a + b)
    us = [_u_brute(list(c), [v for v in pooled if v not in c]) for c in itertools.combinations(pooled, len(a))]
    u = max(u1, len(a) * len(b) - u1)
    ref = min(1.0, 2 * sum(1 for x in us if x >= u) / len(us))
    assert got.p_value == pytest.approx(ref, abs=1e-12)


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(5)
    series = {"p": rng.integers(1, 50, 40), "q": rng.integers(5, 90, 30), "r": [1, 89, 89]}
    rows = [(k, float(v)) for k, vs in series.items() for v in vs]
    df = spark.createDataFrame(rows, "s string, v double")
    got = {(r.s, r.bin): r["count"] for r in histogram.shared_histogram(df, "s", "v", 10).collect()}
    edges = np.histogram_bin_edges(np.concatenate([np.asarray(v, float) for v in series.values()]), 10)
    for k, vs in series.items():
        ref, _ = np.histogram(np.asarray(vs, float), edges)
        assert [got[(k, i)] for i in range(10)] == list(ref)


@pytest.mark.parametrize("ranges", [2, 7, 1024])
def test_mann_whitney_agrees_for_any_number_of_ranges(spark, monkeypatch, ranges):
    rng = np.random.default_rng(13)
    groups = {"a": list(rng.normal(0, 1, 60).round(2)), "b": list(rng.normal(0.4, 1, 50).round(2)),
              "c": list(rng.normal(-0.2, 1, 40).round(1))}
    df = _frame(spark, groups)
    pairs = [("a", "b"), ("c", "a"), ("b", "c")]
    plain = ranks.running_below
    monkeypatch.setattr(ranks, "running_below", lambda w, v, c: plain(w, v, c, ranges))
    got = {(r.group1, r.group2): r for r in ranks.mann_whitney(df, "g", "v", pairs).collect()}
    for a, b in pairs:
        assert got[(a, b)].u_stat == _u_brute(groups[a], groups[b])


def test_exact_tail_is_bounded_by_the_smaller_sample(spark):
    import time
    t = time.time()
    big = spark.range(1_000_000).select(F.lit("b").alias("g"), (F.col("id") * 2).cast("double").alias("v"))
    untied = spark.range(8).select(F.lit("a").alias("g"), (F.col("id") * 200_001 + 1).cast("double").alias("v"))
    tied = spark.range(8).select(F.lit("a").alias("g"), (F.col("id") * 200_000).cast("double").alias("v"))
    ps = [ranks.mann_whitney(big.unionByName(x), "g", "v", [("a", "b")]).first().p_value for x in (untied, tied)]
    assert all(0.0 < p <= 1.0 for p in ps) and abs(ps[0] - ps[1]) < 0.05
    assert time.time() - t < 120


def test_exact_tail_matches_enumeration():
    from itertools import combinations
    for m, n in ((1, 1), (2, 3), (3, 5), (4, 4)):
        us = [sum(c) - sum(range(m)) for c in combinations(range(m + n), m)]
        for u in range(m * n + 2):
            want = min(1.0, 2.0 * sum(x >= u for x in us) / len(us))
            assert ranks.exact_two_sided(float(u), m, n) == pytest.approx(want, abs=1e-12)


def test_anova_with_a_large_offset(spark):
    rng = np.random.default_rng(5)
    groups = {g: rng.random(4000) + d for g, d in (("a", 0.0), ("b", 0.002), ("c", -0.001))}
    allv = np.concatenate(list(groups.values()))
    ssb = sum(len(v) * (v.mean() - allv.mean()) ** 2 for v in groups.values())
    ssw = sum(((v - v.mean()) ** 2).sum() for v in groups.values())
    want = (ssb / 2) / (ssw / (len(allv) - 3))
    for offset in (0.0, 1e6):
        got = anova.one_way_anova(_frame(spark, {g: v + offset for g, v in groups.items()}), "g", "v").first().f_stat
        # The offset itself rounds the values to about 1e-10.
        assert got == pytest.approx(want, rel=1e-6)


def test_polyfit_of_clustered_points_is_the_least_squares_fit(spark):
    """Degree 11 where most points lie in a corner of the range."""
    rng = np.random.default_rng(8)
    x = np.concatenate((rng.normal(700.0, 60.0, 70), [3.0, 950.0]))
    y = rng.normal(50.0, 20.0, len(x))
    df = spark.createDataFrame([("g", float(a), float(b)) for a, b in zip(x, y)], "g string, x double, y double")
    fit = regression.polyfit(df, "x", "y", 11, ["g"])
    got = {r.x: r.p for r in regression.with_poly(df, fit, "x", 11, ["g"], "p").collect()}
    z = (2 * x - x.min() - x.max()) / (x.max() - x.min())
    q, _ = np.linalg.qr(np.polynomial.chebyshev.chebvander(z, 11))
    want = q @ (q.T @ y)
    assert fit.first()["rank"] == 12
    assert max(abs(got[a] - b) for a, b in zip(x, want)) < 1e-6 * np.abs(want).max()


def test_polyfit_factors_merge(spark):
    rng = np.random.default_rng(9)
    rows = [(g, float(v), float(v * v + rng.normal())) for g in ("a", "b") for v in rng.normal(0, 3, 300)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    one = {r.g: r.coef for r in regression.polyfit(df.coalesce(1), "x", "y", 4, ["g"]).collect()}
    many = {r.g: r.coef for r in regression.polyfit(df.repartition(40), "x", "y", 4, ["g"]).collect()}
    assert one.keys() == many.keys() == {"a", "b"}
    assert all(one[g] == pytest.approx(many[g], abs=1e-9) for g in one)


def test_results_do_not_depend_on_partitioning(spark):
    rng = np.random.default_rng(11)
    groups = {g: list(rng.integers(0, 20, 40)) for g in ("a", "b", "c")}
    df = _frame(spark, groups)
    a = anova.one_way_anova(df, "g", "v").first()
    b = anova.one_way_anova(df.repartition(7), "g", "v").first()
    assert a.f_stat == pytest.approx(b.f_stat, rel=1e-12)
    u1 = ranks.mann_whitney(df, "g", "v", [("a", "b")]).first()
    u2 = ranks.mann_whitney(df.repartition(5), "g", "v", [("a", "b")]).first()
    assert u1.u_stat == u2.u_stat and u1.p_value == pytest.approx(u2.p_value)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(-20, 20), st.integers(-50, 50)), min_size=3, max_size=25))
def test_regression_residuals_sum_to_zero_and_p_in_range(spark, pts):
    if len({x for x, _ in pts}) < 2:
        return
    df = spark.createDataFrame([("g", float(x), float(y)) for x, y in pts], "g string, x double, y double")
    fit = regression.linregress(df, "x", "y", ["g"]).first()
    resid = sum(y - (fit.slope * x + fit.intercept) for x, y in pts)
    assert abs(resid) < 1e-8 * max(1.0, sum(abs(y) for _, y in pts))
    assert 0.0 <= fit.p_value <= 1.0


def test_split_options(spark):
    from moodcast.operators import ml
    df = spark.range(2000).withColumn("k", F.col("id") * 7)
    a, b = ml.hash_split(df, ["k"])
    a2, _ = ml.hash_split(df.repartition(5), ["k"])
    assert a.count() + b.count() == 2000
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in a2.collect())
    r1, r2 = ml.random_split(df)
    assert r1.count() + r2.count() == 2000
    assert 1300 < r1.count() < 1700


def test_indexer_fitted_on_train_keeps_unseen(spark):
    from moodcast.operators import ml
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",)], "v string")
    train = df.where(F.col("v") != "c")
    out = {r.v: r.v_index for r in ml.index_strings(df, ["v"], fit_on=train, handle_invalid="keep").collect()}
    assert out == {"a": 0.0, "b": 1.0, "c": 2.0}


def test_chi2_per_test_matches_single_tables(spark):
    rows = [("t1", f"r{i}", f"c{j}", v) for i, line in enumerate([[12, 5], [7, 9]]) for j, v in enumerate(line)]
    rows += [("t2", f"r{i}", f"c{j}", v) for i, line in enumerate([[30, 10], [12, 25], [4, 8]])
             for j, v in enumerate(line)]
    df = spark.createDataFrame(rows, "t string, r string, c string, n long")
    both = {r.t: r for r in contingency.chi2_test(df, "r", "c", ["c0", "c1"], "n", by=["t"]).collect()}
    for t in ("t1", "t2"):
        one = contingency.chi2_test(df.where(F.col("t") == t), "r", "c", ["c0", "c1"], "n").first()
        assert both[t].chi2 == pytest.approx(one.chi2) and both[t].dof == one.dof


def test_tukey_of_many_groups_gives_every_pair(spark):
    df = spark.range(1200).select(F.format_string("g%04d", F.col("id")).alias("g"), F.col("id").cast("double").alias("v"))
    df = df.unionByName(df.withColumn("v", F.col("v") + 1))
    from moodcast.operators import anova as an
    plain, an._tukey_p = an._tukey_p, lambda q, k, d: F.lit(0.5)  # the tail of 719,400 pairs is not what is tested
    try:
        assert an.tukey_hsd(df, "g", "v").count() == 1200 * 1199 // 2
    finally:
        an._tukey_p = plain


def test_studentised_range_is_smooth_in_df():
    from moodcast.functions.studentized import ptukey
    for q in (1.0, 3.3, 5.0):
        a, b, c = (ptukey(q, 4, d) for d in (49_999, 50_001, 1e12))
        assert abs(a - b) < 1e-8 and abs(b - c) < 1e-4


def test_fit_series_matches_numpy(spark):
    rng = np.random.default_rng(21)
    rows = []
    for g in ("a", "b"):
        x = np.sort(rng.uniform(-5, 30, 35))
        y = 3 + 0.5 * x - 0.02 * x ** 2 + rng.normal(0, 0.3, 35)
        rows += [(g, float(a), float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = regression.fit_series(df, "x", "y", 4, ["g"]).collect()
    for g in ("a", "b"):
        pts = sorted((r.x, r.y, r.lin_predict, r.poly_predict) for r in got if r.g == g)
        x = np.array([p[0] for p in pts]); y = np.array([p[1] for p in pts])
        lin = np.polyval(np.polyfit(x, y, 1), x)
        poly = np.polynomial.Polynomial.fit(x, y, 4)(x)
        assert np.allclose([p[2] for p in pts], lin, atol=1e-9)
        assert np.allclose([p[3] for p in pts], poly, atol=1e-8)


def test_anova_by_test_matches_single_tests(spark):
    rng = np.random.default_rng(4)
    rows = [(t, g, float(v)) for t in ("x", "y") for g in ("a", "b", "c")
            for v in rng.integers(0, 20 if t == "x" else 9, 15)]
    df = spark.createDataFrame(rows, "t string, g string, v double")
    both = {r.t: r for r in anova.one_way_anova(df, "g", "v", by=["t"]).collect()}
    for t in ("x", "y"):
        one = anova.one_way_anova(df.where(F.col("t") == t), "g", "v").first()
        assert both[t].f_stat == pytest.approx(one.f_stat, rel=1e-10) and both[t].k == one.k == 3
        assert both[t].n == one.n == 45


def test_value_ranges_cut_many_values(spark, monkeypatch):
    """Many ranges give the running sums of one; NaN is the largest value."""
    from moodcast.operators import ranks
    monkeypatch.setattr(ranks, "RANGE_ROWS", 40)
    rng = np.random.default_rng(3)
    values = sorted({round(float(v), 2) for v in rng.lognormal(3, 2, 900)} | {-1.0, 0.0, 1e300, float("inf")}) + [float("nan")]
    counts = [float(n) for n in rng.integers(0, 5, len(values))]
    wide = spark.createDataFrame(list(zip(values, counts, strict=True)), "v double, c double").repartition(7)
    assert ranks.value_ranges(wide, "v", len(values)).select("__range").distinct().count() > 8
    got = {repr(r.v): r["__below_c"] for r in ranks.running_below(wide, "v", ["c"]).collect()}
    below = np.concatenate(([0.0], np.cumsum(counts)[:-1]))
    assert got == {repr(v): b for v, b in zip(values, below, strict=True)}


def test_quantile_of_the_studentised_range():
    """The search agrees with a plain bisection, and Phi with erfc."""
    import math

    from moodcast.functions import studentized as st
    x = np.linspace(-8.9, 8.9, 1777)
    assert np.abs(st._phi_cdf(x) - [0.5 * math.erfc(-v / math.sqrt(2)) for v in x]).max() < 1e-14
    for p, k, df in [(0.95, 2, 3), (0.95, 6, 40), (0.99, 3, 1e6), (0.5, 12, 1), (0.999, 4, 7)]:
        q = st.qtukey(p, k, df)
        lo, hi = 0.0, 1000.0
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if st.ptukey(mid, k, df) < p else (lo, mid)
        assert abs(q - lo) < 1e-8 * lo


def test_replayed_trees_predict_what_the_forest_does(spark):
    """The trees as rows, walked by joins, on whole and on indexed features."""
    from moodcast.operators import ml
    rng = np.random.default_rng(12)
    cities = ["a", "b", "c", "d"]
    rows = []
    for i in range(600):
        city, v = cities[int(rng.integers(4))], rng.normal(size=5)
        label = "negative" if (v[0] > 0.3) ^ (city in "bd") else "positive" if v[3] > v[1] else "neutral"
        rows.append((str(i), city, *map(float, v), label))
    data = ml.prepared_rows(spark.createDataFrame(rows, "id string, city string, PRCP double, SNOW double, TMAX double, "
                                                  "TMIN double, TAVG double, sentiment string"))
    model = ml.train_forest(data, trees=7, depth=6, cities=4)
    trees = ml.tree_rows(model)
    assert trees.where("feature = 0 and kinds = 4").count() > 0 and trees.where("kinds < 0").count() > 0
    want = {r.id: r.prediction for r in model.transform(data).select("id", "prediction").collect()}
    got = {r.id: r.prediction for r in ml.replay(data, trees, ["id"], depth=6).collect()}
    assert got == want and len(set(want.values())) == 3


def _repeated_rows(spark):
    """40 feature vectors with 30 rows each, one key of them twice."""
    from moodcast.operators import ml
    rng = np.random.default_rng(5)
    days = [(["a", "b", "c"][i % 3], *map(float, rng.normal(size=5))) for i in range(40)]
    rows = [(str(30 * i + j), *day, ["negative", "neutral", "positive"][(i + (j % 7 == 0)) % 3])
            for i, day in enumerate(days) for j in range(30)]
    rows += [rows[0], ("0", *rows[45][1:])]
    return ml.prepared_rows(spark.createDataFrame(rows, "id string, city string, PRCP double, SNOW double, TMAX double, "
                                                  "TMIN double, TAVG double, sentiment string"))


def _most_generated(df) -> int:
    """The most rows that a Generate of the executed plan made."""
    df.collect()  # runs this plan, so its metrics are filled in
    made = [0]

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if name.endswith("QueryStage"):
            return walk(node.plan())
        if name == "Generate":
            made.append(node.metrics().get("numOutputRows").get().value())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return max(made)


def test_rows_with_equal_features_walk_the_trees_once(spark):
    from moodcast.operators import ml
    data = _repeated_rows(spark)
    model = ml.train_forest(data, trees=5, depth=4, cities=3)
    replayed = ml.replay(data, ml.tree_rows(model), ["id"], depth=4)
    got = {r.id: r.prediction for r in replayed.collect()}
    want = {r.id: r.prediction for r in model.transform(data).where("id <> '0'").select("id", "prediction").collect()}
    assert len(got) == replayed.count() == 1200 and {k: v for k, v in got.items() if k != "0"} == want
    assert _most_generated(replayed) <= 40 * 5


def test_rows_with_equal_features_are_scored_once(spark):
    from moodcast.operators import joins, ml
    data = _repeated_rows(spark)
    model = ml.train_forest(data, trees=5, depth=4, cities=3)
    got = ml.scored(model, data)
    assert joins._KEPT[-1].count() == 40
    assert sorted((r.id, r.prediction) for r in got.collect()) == sorted(
        (r.id, r.prediction) for r in model.transform(data).select("id", "prediction").collect())


def _forest_sides(spark):
    """Station days and comments: gaps, a station day twice, a comment twice,
    equal features on two stations, and a city with many of both."""
    from moodcast.operators import ml
    rng = np.random.default_rng(8)
    days = [(f"s{i % 9}", f"2024-01-0{1 + i % 3}", ["a", "a", "b"][i % 9 % 3], *[float(x) for x in rng.integers(0, 3, 5)])
            for i in range(60)]
    days += [days[0], ("s99", *days[0][1:]), ("s50", "2024-01-01", None, 1., 1., 1., 1., 1.),
             ("s51", "2024-01-01", "a", None, 1., 1., 1., 1.), (None, "2024-01-01", "a", 1., 1., 1., 1., 1.)]
    said = [(i, f"2024-01-0{1 + i % 3}", ["a", "b", "a", "z"][i % 4], ["negative", "neutral", "positive", None][i % 7 % 4])
            for i in range(90)]
    said += [said[0], (None, "2024-01-01", "a", "neutral")]
    weather = spark.createDataFrame(days, "station_id string, date string, city string, "
                                    + ", ".join(f"{m} double" for m in ml.MEASURES))
    comments = spark.createDataFrame(said, "comment_id long, date string, subreddit string, sentiment string")
    return weather.withColumn("date", F.to_date("date")), comments.withColumn("date", F.to_date("date"))


def test_split_is_counted_as_the_rows_are_split(spark, monkeypatch):
    from moodcast.operators import ml
    monkeypatch.setattr(ml, "PIECE_STATIONS", 4)
    monkeypatch.setattr(ml, "PIECE_COMMENTS", 3)
    weather, comments = _forest_sides(spark)
    rows = ml.forest_rows(weather, comments)
    plain = weather.dropna().join(comments.where("sentiment is not null").withColumnRenamed("subreddit", "city"), ["city", "date"])
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, plain.select(*rows.columns).collect()))
    by = ["city", *ml.MEASURES, "sentiment"]
    train, test = ml.hash_split(rows, ml.ROW_KEYS)
    want = {tuple(r[c] for c in by): [r["count"], 0] for r in train.groupBy(*by).count().collect()}
    for r in test.groupBy(*by).count().collect():
        want.setdefault(tuple(r[c] for c in by), [0, 0])[1] = r["count"]
    counted = ml.split_counts(weather, comments).collect()
    assert {tuple(r[c] for c in by): [r.n_train, r.n_test] for r in counted} == want and len(counted) == len(want)
    labels = ml.fit_index(rows, ["sentiment", "city"]).labelsArray
    assert ml.index_labels(ml.forest_index(weather, comments)) == [list(x) for x in labels]


def test_counted_rows_grow_the_trees_of_the_rows(spark):
    """One row with its number gives the trees that the rows give, and a
    bag holds n equal rows a Poisson(n) number of times."""
    from moodcast.operators import ml
    data = _repeated_rows(spark)
    counted = data.groupBy(*ml.FEATURES, "features", "sentiment_index").agg(F.count(F.lit(1)).alias("n"))
    one, two = (ml.tree_rows(ml.train_forest(d, trees=4, depth=5, cities=3, count=n)).drop("votes")
                for d, n in ((data.repartition(5), None), (counted, "n")))
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))
    drawn = spark.range(400).select(F.explode(ml._drawn(20, 42)("id", F.lit(50))).alias("n"))
    mean, var = drawn.agg(F.avg("n"), F.var_samp("n")).first()
    assert abs(mean - 50) < 0.5 and abs(var - 50) < 4


def test_accuracy_of_counted_rows(spark):
    from moodcast.operators import ml
    rows = spark.createDataFrame([(0.0, 0.0, 5), (1.0, 0.0, 2), (1.0, 1.0, 1)], "prediction double, sentiment_index double, n long")
    assert tuple(ml.accuracy(rows, "n").first()) == (8, 0.75)
    assert tuple(ml.accuracy(rows).first()) == (3, 2 / 3)
    assert tuple(ml.accuracy(rows.where("n < 0")).first()) == (0, None)


def test_forest_keeps_no_row_per_station_day_and_comment(spark):
    from moodcast.operators import joins, ml
    from moodcast.plans import catalog
    from moodcast.plans.workspace import workspace
    from conftest import SF001
    ws = workspace(spark, SF001)
    ws.release()
    weather, comments = _forest_sides(spark)
    many = comments.crossJoin(spark.range(20)).withColumn("comment_id", F.col("comment_id") + 1000 * F.col("id")).drop("id")
    ws.__dict__.update(weather=weather, classified=many)
    try:
        n_test = catalog.REGISTRY["rf_accuracy"].build(ws).first().n_test
        assert n_test == ml.hash_split(ml.forest_rows(weather, many), ml.ROW_KEYS)[1].count() > 2000
        assert max(df.count() for df in joins._KEPT) < 400
    finally:
        ws.release()
