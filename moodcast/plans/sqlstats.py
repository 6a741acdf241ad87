"""Oracle SQL for the statistics operators (DuckDB dialect).

Each builder takes the SQL of its input rows and returns a SELECT whose
columns match the Spark operator's output.
"""

from __future__ import annotations

from collections.abc import Sequence

from ..functions import special
from ..functions.special import DUCKDB, apply_sql
from .sqlbase import q


def _by(by: Sequence[str]) -> tuple[str, str]:
    if not by:
        return "", ""
    cols = ", ".join(by)
    return cols + ", ", "GROUP BY " + cols


def linreg_sql(src: str, x: str, y: str, by: Sequence[str]) -> str:
    sel, grp = _by(by)
    xd, yd = f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)"
    mom = (f"SELECT {sel}count(*) AS n, avg({xd}) AS m_x, avg({yd}) AS m_y, var_pop({xd}) AS v_x, "
           f"var_pop({yd}) AS v_y, covar_pop({xd}, {yd}) AS c_xy "
           f"FROM ({src}) src WHERE {x} IS NOT NULL AND {y} IS NOT NULL {grp}")
    fit = (f"SELECT *, CASE WHEN v_x > 0 THEN c_xy / v_x END AS slope, "
           f"CASE WHEN v_x > 0 AND v_y > 0 THEN greatest(-1.0, least(1.0, c_xy / sqrt(v_x * v_y))) "
           f"WHEN v_x > 0 THEN 0.0 END AS r_value, greatest(n - 2, 1) AS df_t FROM ({mom}) m")
    withp = apply_sql(fit, special.t_two_sided_steps("r_value", "df_t", "p_t", DUCKDB))
    return (f"SELECT {sel}n, slope, m_y - slope * m_x AS intercept, r_value, "
            f"CASE WHEN v_x IS NULL OR v_x <= 0 OR n < 2 THEN NULL WHEN n = 2 THEN "
            f"(CASE WHEN v_y = 0 THEN 1.0 ELSE 0.0 END) ELSE p_t END AS p_value, "
            f"CASE WHEN v_x > 0 AND n > 2 THEN sqrt((1.0 - r_value * r_value) * v_y / v_x / (n - 2)) "
            f"WHEN v_x > 0 AND n = 2 THEN 0.0 END AS stderr, m_x, v_x FROM ({withp}) f")


def linreg_out(src: str, x: str, y: str, by: Sequence[str]) -> str:
    sel, _ = _by(by)
    inner = linreg_sql(src, x, y, by)
    return (f"SELECT {sel}n, round(slope, 6) AS slope, round(intercept, 6) AS intercept, "
            f"round(r_value, 6) AS r_value, round(p_value, 6) AS p_value, round(stderr, 6) AS stderr, "
            f"round(stderr * sqrt(v_x + m_x * m_x), 6) AS intercept_stderr FROM ({inner}) l")


def cells_sql(src: str, row: str, col: str, col_values: Sequence[str], weight: str | None) -> str:
    w = weight or "1"
    parts = []
    for v in col_values:
        parts.append(f"SELECT {row}, {q(v)} AS {col}, "
                     f"CAST(sum(CASE WHEN {col} = {q(v)} THEN {w} ELSE 0 END) AS BIGINT) AS observed "
                     f"FROM ({src}) src WHERE {col} IN ({', '.join(q(c) for c in col_values)}) GROUP BY {row}")
    return " UNION ALL ".join(parts)


def pivot_sql(src: str, row: str, col: str, col_values: Sequence[str], weight: str | None) -> str:
    w = weight or "1"
    sums = ", ".join(f"CAST(sum(CASE WHEN {col} = {q(v)} THEN {w} ELSE 0 END) AS BIGINT) AS {v}"
                     for v in col_values)
    return (f"SELECT {row}, {sums} FROM ({src}) src "
            f"WHERE {col} IN ({', '.join(q(c) for c in col_values)}) GROUP BY {row}")


def expected_sql(cells: str, row: str, col: str) -> str:
    return (f"SELECT c.*, r.r_tot * k.c_tot / (SELECT sum(observed) FROM ({cells}) a) AS expected, "
            f"CAST(((SELECT count(DISTINCT {row}) FROM ({cells}) a) - 1) "
            f"* ((SELECT count(DISTINCT {col}) FROM ({cells}) a) - 1) AS BIGINT) AS dof "
            f"FROM ({cells}) c "
            f"JOIN (SELECT {row}, CAST(sum(observed) AS DOUBLE) AS r_tot FROM ({cells}) a GROUP BY {row}) r "
            f"ON c.{row} = r.{row} "
            f"JOIN (SELECT {col}, CAST(sum(observed) AS DOUBLE) AS c_tot FROM ({cells}) a GROUP BY {col}) k "
            f"ON c.{col} = k.{col}")


def chi2_sql(cells: str, row: str, col: str, correction: bool = True) -> str:
    e = expected_sql(cells, row, col)
    o = "CAST(observed AS DOUBLE)"
    adj = (f"({o} + sign(expected - {o}) * least(0.5, abs(expected - {o})))" if correction else o)
    used = f"(CASE WHEN dof = 1 THEN {adj} ELSE {o} END)"
    stat = (f"SELECT CASE WHEN max(dof) = 0 THEN 0.0 ELSE sum(({used} - expected) * ({used} - expected) "
            f"/ expected) END AS chi2, max(dof) AS dof FROM ({e}) e")
    withp = apply_sql(stat, special.chi2_upper_steps("chi2", "dof", "p_value", DUCKDB))
    return f"SELECT round(chi2, 6) AS chi2, round(p_value, 6) AS p_value, dof FROM ({withp}) t"


def moments_sql(src: str, group: str, value: str, by: Sequence[str] = ()) -> str:
    sel, _ = _by(by)
    v = f"CAST({value} AS DOUBLE)"
    return (f"SELECT {sel}{group}, count(*) AS n, avg({v}) AS mean, coalesce(var_samp({v}), 0.0) AS var "
            f"FROM ({src}) src WHERE {value} IS NOT NULL GROUP BY {sel}{group}")


def anova_sql(src: str, group: str, value: str, by: Sequence[str] = ()) -> str:
    sel, grp = _by(by)
    part = f"PARTITION BY {', '.join(by)}" if by else ""
    m = moments_sql(src, group, value, by)
    g = f"SELECT *, sum(n * mean) OVER ({part}) / sum(n) OVER ({part}) AS grand FROM ({m}) m"
    ss = (f"SELECT {sel}count(*) AS k, CAST(sum(n) AS BIGINT) AS n, sum(n * (mean - grand) * (mean - grand)) AS ssb, "
          f"sum((n - 1) * var) AS ssw FROM ({g}) g {grp}")
    f = (f"SELECT *, k - 1 AS df_between, n - k AS df_within, "
         f"(ssb / (k - 1)) / (ssw / (n - k)) AS f_stat FROM ({ss}) s")
    withp = apply_sql(f, special.f_upper_steps("f_stat", "df_between", "df_within", "p_value", DUCKDB))
    return (f"SELECT {sel}k, n, round(f_stat, 6) AS f_stat, round(p_value, 6) AS p_value, df_between, df_within "
            f"FROM ({withp}) a")


def mannwhitney_sql(src: str, group: str, value: str, pairs: Sequence[tuple[str, str]]) -> str:
    pair_values = ", ".join(f"({i}, {q(a)}, {q(b)})" for i, (a, b) in enumerate(pairs))
    hist = f"SELECT {group} AS g, {value} AS v, count(*) AS n FROM ({src}) src WHERE {value} IS NOT NULL GROUP BY 1, 2"
    merged = (f"SELECT pair, group1, group2, v, sum(n1) AS n1, sum(n2) AS n2 FROM ("
              f"SELECT p.pair, p.group1, p.group2, h.v, h.n AS n1, 0 AS n2 FROM ({hist}) h "
              f"JOIN (VALUES {pair_values}) p(pair, group1, group2) ON h.g = p.group1 "
              f"UNION ALL SELECT p.pair, p.group1, p.group2, h.v, 0 AS n1, h.n AS n2 FROM ({hist}) h "
              f"JOIN (VALUES {pair_values}) p(pair, group1, group2) ON h.g = p.group2) u "
              f"GROUP BY pair, group1, group2, v")
    t = "CAST(n1 + n2 AS DOUBLE)"
    ranked = (f"SELECT *, {t} AS t, coalesce(sum({t}) OVER (PARTITION BY pair ORDER BY v ROWS BETWEEN "
              f"UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) + ({t} + 1.0) / 2.0 AS mid FROM ({merged}) m")
    s = (f"SELECT group1, group2, CAST(sum(n1) AS DOUBLE) AS n_1, CAST(sum(n2) AS DOUBLE) AS n_2, "
         f"sum(n1 * mid) AS r_1, sum(t * t * t - t) AS ties FROM ({ranked}) r GROUP BY group1, group2")
    nn = "(n_1 + n_2)"
    u = (f"SELECT *, r_1 - n_1 * (n_1 + 1.0) / 2.0 AS u_stat FROM ({s}) s")
    z = (f"SELECT *, (greatest(u_stat, n_1 * n_2 - u_stat) - n_1 * n_2 / 2.0 - 0.5) / "
         f"sqrt(n_1 * n_2 / 12.0 * (({nn} + 1.0) - ties / ({nn} * ({nn} - 1.0)))) AS z FROM ({u}) u")
    withp = apply_sql(z, special.normal_two_sided_steps("z", "p_value", DUCKDB))
    return f"SELECT group1, group2, round(u_stat, 6) AS u_stat, round(p_value, 6) AS p_value FROM ({withp}) w"


def histogram_sql(src: str, series: str, value: str, bins: int = 10) -> str:
    v = f"CAST({value} AS DOUBLE)"
    lo0 = f"(SELECT min({v}) FROM ({src}) a)"
    hi0 = f"(SELECT max({v}) FROM ({src}) a)"
    pts = (f"SELECT {series} AS series, {v} AS x, {lo0} AS lo0, {hi0} AS hi0 "
           f"FROM ({src}) s WHERE {value} IS NOT NULL")
    rng = (f"SELECT *, CASE WHEN hi0 > lo0 THEN lo0 ELSE lo0 - 0.5 END AS lo, "
           f"CASE WHEN hi0 > lo0 THEN hi0 ELSE hi0 + 0.5 END AS hi FROM ({pts}) p")
    nb = float(bins)

    def edge(i: str) -> str:
        return f"(CASE WHEN {i} >= {bins} THEN hi ELSE lo + CAST({i} AS DOUBLE) * ((hi - lo) / {nb}) END)"

    g0 = f"SELECT *, least(CAST(floor((x - lo) * ({nb} / (hi - lo))) AS INTEGER), {bins - 1}) AS g0 FROM ({rng}) r"
    g1 = f"SELECT *, CASE WHEN x < {edge('g0')} THEN g0 - 1 ELSE g0 END AS g1 FROM ({g0}) a"
    g = (f"SELECT *, CASE WHEN g1 < {bins - 1} AND x >= {edge('(g1 + 1)')} THEN g1 + 1 ELSE g1 END AS g "
         f"FROM ({g1}) b")
    counts = (f"SELECT series, any_value(lo) AS lo, any_value(hi) AS hi, "
              + ", ".join(f"count_if(g = {i}) AS b{i}" for i in range(bins))
              + f" FROM ({g}) c GROUP BY series")
    parts = [f"SELECT series AS {series}, {i} AS bin, {edge(str(i))} AS bin_lo, {edge(str(i + 1))} AS bin_hi, "
             f"CAST(b{i} AS BIGINT) AS count FROM ({counts}) k" for i in range(bins)]
    body = " UNION ALL ".join(parts)
    return (f"SELECT {series}, bin, round(bin_lo, 6) AS bin_lo, round(bin_hi, 6) AS bin_hi, count "
            f"FROM ({body}) h")


def polyfit_sql(src: str, x: str, y: str, degree: int, by: Sequence[str], keep: Sequence[str],
                decimals: int = 6) -> str:
    """Least-squares polynomial per group, predicted at each point.

    Another method than the Spark operator's: polynomials orthogonal on
    the group's own points, by the three-term recurrence with every term
    orthogonalised once more against all before it, and y projected on
    each.  A term at rounding level is left out.
    """
    part = f"OVER (PARTITION BY {', '.join(by)})"
    xd, yd = f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)"
    cur = (f"SELECT *, {yd} AS y__, CASE WHEN max({xd}) {part} > min({xd}) {part} THEN (2.0 * {xd} - min({xd}) {part} "
           f"- max({xd}) {part}) / (max({xd}) {part} - min({xd}) {part}) ELSE 0.0 END AS z__ "
           f"FROM ({src}) s WHERE {x} IS NOT NULL AND {y} IS NOT NULL")
    cur = f"SELECT *, 1.0 / sqrt(count(*) {part}) AS p0 FROM ({cur}) a"
    for k in range(1, degree + 1):
        cur = f"SELECT *, z__ * p{k - 1} AS w FROM ({cur}) a{k}"
        cur = f"SELECT *, sqrt(sum(w * w) {part}) AS w0 FROM ({cur}) b{k}"
        for _ in range(2):
            dots = ", ".join(f"sum(w * p{j}) {part} AS d{j}" for j in range(k))
            less = " ".join(f"- d{j} * p{j}" for j in range(k))
            cur = (f"SELECT * EXCLUDE ({', '.join(f'd{j}' for j in range(k))}) REPLACE (w {less} AS w) "
                   f"FROM (SELECT *, {dots} FROM ({cur}) c{k}) e{k}")
        cur = f"SELECT *, sqrt(sum(w * w) {part}) AS w1 FROM ({cur}) f{k}"
        cur = (f"SELECT * EXCLUDE (w, w0, w1), CASE WHEN w1 > 1e-13 * w0 THEN w / w1 ELSE 0.0 END AS p{k} "
               f"FROM ({cur}) g{k}")
    coefs = ", ".join(f"sum(y__ * p{k}) {part} AS c{k}" for k in range(degree + 1))
    fitted = " + ".join(f"c{k} * p{k}" for k in range(degree + 1))
    return (f"SELECT {', '.join(keep)}, round({fitted}, {decimals}) AS poly_predict "
            f"FROM (SELECT *, {coefs} FROM ({cur}) h) i")
