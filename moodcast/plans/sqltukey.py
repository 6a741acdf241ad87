"""Oracle SQL for Tukey's HSD (DuckDB dialect).

The studentised range tail is integrated in SQL: Gauss-Legendre nodes are
literal lists, Phi comes from the regularised upper incomplete gamma
(series or continued fraction folded with ``list_reduce``), and q_crit is
found by bisection with a struct accumulator.  This is an independent
second computation of what ``functions.studentized`` does in numpy.
"""

from __future__ import annotations

import math

import numpy as np


_X, _W = np.polynomial.legendre.leggauss(16)


def _panels(lo: float, hi: float, panels: int) -> tuple[list[float], list[float]]:
    edges = np.linspace(lo, hi, panels + 1)
    xs, ws = [], []
    for a, b in zip(edges[:-1], edges[1:]):
        half, mid = (b - a) / 2.0, (a + b) / 2.0
        xs += [float(v) for v in mid + half * _X]
        ws += [float(v) for v in half * _W]
    return xs, ws


# inner rule over z: fixed nodes, with phi(z) and Phi(z) as constants
_Z, _ZW = _panels(-8.5, 8.5, 6)
_INNER = "[" + ", ".join(
    f"{{'z': {z!r}, 'w': {w * math.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)!r}, "
    f"'c': {0.5 * math.erfc(-z / math.sqrt(2.0))!r}}}" for z, w in zip(_Z, _ZW)) + "]"
# outer rule on [-1, 1], mapped per row to the s range
_T, _TW = _panels(-1.0, 1.0, 6)
_OUTER = "[" + ", ".join(f"{{'t': {t!r}, 'w': {w!r}}}" for t, w in zip(_T, _TW)) + "]"


def _q_half(y: str) -> str:
    """Q(1/2, y) for y >= 0 (y a lambda variable)."""
    series = f"list_reduce(range(36, 0, -1), lambda acc, n: 1.0 + {y} / (0.5 + n) * acc, 1.0::DOUBLE)"
    cf = (f"list_reduce(range(36, 0, -1), lambda acc, n: ({y} + 2.0 * n - 1.0 - 0.5) - n * (n - 0.5) / acc, "
          f"({y} + 73.0 - 0.5)::DOUBLE)")
    return (f"(CASE WHEN {y} <= 0.0 THEN 1.0 WHEN {y} < 1.5 THEN "
            f"1.0 - exp(-{y} + 0.5 * ln({y}) - lgamma(1.5)) * {series} "
            f"ELSE exp(-{y} + 0.5 * ln({y}) - lgamma(0.5)) / {cf} END)")


def _phi(x: str) -> str:
    """Standard normal CDF of the expression x (bound once to a lambda variable)."""
    body = f"CASE WHEN xx >= 0.0 THEN 1.0 - 0.5 * {_q_half('(xx * xx / 2.0)')} ELSE 0.5 * {_q_half('(xx * xx / 2.0)')} END"
    return f"(list_transform([{x}], lambda xx: {body}))[1]"


def ptukey_sql(qq: str, k: str, df: str) -> str:
    """P(Q <= qq) for k groups and df error degrees of freedom (expressions)."""
    inner = (f"list_sum(list_transform({_INNER}, lambda nd: nd.w * pow(greatest(nd.c - {_phi('nd.z - qq_ * s_')}, 0.0), "
             f"k_ - 1)))")
    range_cdf = f"k_ * {inner}"
    sd = "(1.0 / sqrt(2.0 * df_))"
    lo = f"(CASE WHEN df_ < 10 THEN 1e-9 ELSE greatest(1e-9, 1.0 - 14.0 * {sd}) END)"
    hi = f"(CASE WHEN df_ < 10 THEN 1.0 + 14.0 * {sd} + 4.0 ELSE 1.0 + 14.0 * {sd} END)"
    log_f = ("(df_ / 2.0 * ln(df_) - lgamma(df_ / 2.0) - (df_ / 2.0 - 1.0) * ln(2.0) "
             "+ (df_ - 1.0) * ln(s_) - df_ * s_ * s_ / 2.0)")
    outer = (f"list_sum(list_transform({_OUTER}, lambda ot: (list_transform([{{'s': ({lo} + {hi}) / 2.0 + "
             f"({hi} - {lo}) / 2.0 * ot.t, 'w': ({hi} - {lo}) / 2.0 * ot.w}}], lambda sw: "
             f"(list_transform([sw.s], lambda s_: sw.w * exp({log_f}) * {range_cdf}))[1]))[1]))")
    expr = f"CASE WHEN qq_ <= 0.0 THEN 0.0 ELSE least(1.0, {outer}) END"
    return (f"(list_transform([{{'q': CAST({qq} AS DOUBLE), 'k': CAST({k} AS DOUBLE), 'd': CAST({df} AS DOUBLE)}}], "
            f"lambda a_: (list_transform([a_.q], lambda qq_: (list_transform([a_.k], lambda k_: "
            f"(list_transform([a_.d], lambda df_: {expr}))[1]))[1]))[1]))[1]")


def qtukey_sql(p: float, k: str, df: str, iterations: int = 40) -> str:
    """q with P(Q <= q) = p, by bisection on [0, 64]."""
    mid = "((acc.lo + acc.hi) / 2.0)"
    step = (f"CASE WHEN {ptukey_sql(mid, k, df)} < {p!r} THEN {{'lo': {mid}, 'hi': acc.hi}} "
            f"ELSE {{'lo': acc.lo, 'hi': {mid}}} END")
    fold = f"list_reduce(range({iterations}), lambda acc, i: {step}, {{'lo': 0.0::DOUBLE, 'hi': 64.0::DOUBLE}})"
    return f"(list_transform([{fold}], lambda b_: (b_.lo + b_.hi) / 2.0))[1]"


def tukey_sql(src: str, group: str, value: str, alpha: float = 0.05) -> str:
    v = f"CAST({value} AS DOUBLE)"
    m = (f"SELECT {group} AS g, count(*) AS n, avg({v}) AS mean, coalesce(var_samp({v}), 0.0) AS var "
         f"FROM ({src}) s WHERE {value} IS NOT NULL GROUP BY {group}")
    consts = (f"SELECT count(*) AS k, sum(n) - count(*) AS dfw, sum((n - 1) * var) / (sum(n) - count(*)) AS mse "
              f"FROM ({m}) m")
    consts = f"SELECT *, {qtukey_sql(1.0 - alpha, 'k', 'dfw')} AS crit FROM ({consts}) c0"
    crit = (f"SELECT a.g AS group1, b.g AS group2, b.mean - a.mean AS meandiff, "
            f"sqrt(c.mse / 2.0 * (1.0 / a.n + 1.0 / b.n)) AS se, c.k, c.dfw, c.crit "
            f"FROM ({m}) a JOIN ({m}) b ON a.g < b.g, ({consts}) c")
    full = f"SELECT *, abs(meandiff) / se AS qv FROM ({crit}) c"
    return (f"SELECT group1, group2, round(meandiff, 6) AS meandiff, "
            f"round(greatest(0.0, 1.0 - {ptukey_sql('qv', 'k', 'dfw')}), 6) AS p_adj, "
            f"round(meandiff - crit * se, 6) AS lower, round(meandiff + crit * se, 6) AS upper, "
            f"qv > crit AS reject FROM ({full}) f")
