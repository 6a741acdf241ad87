"""Distribution tails written once as SQL text, for Spark SQL and for DuckDB.

Every p-value in the library is a regularised incomplete beta or gamma
function.  Spark SQL has no ``lgamma`` and no ``erf``, so both are built
here from closed forms plus a fixed-depth continued fraction / power
series evaluated with a higher-order ``aggregate`` (Spark) or
``list_reduce`` (DuckDB).  Because the same text is used for the Spark
query and for the DuckDB oracle, both engines run the same arithmetic.

The functions only ever see a handful of rows (one per test or per
group), so the depth of the fraction is not a cost concern.

Each builder returns a list of ``(column, sql)`` steps; callers apply
them in order (``withColumn`` in Spark, nested selects in DuckDB), which
keeps the generated text small when an argument is used many times.
"""

from __future__ import annotations

SPARK = "spark"
DUCKDB = "duckdb"

# Lanczos coefficients for g = 7, n = 9 (public domain
# approximation of the gamma function, about 15 significant digits for
# arguments >= 0.5).
_LANCZOS_G = 7.0
_LANCZOS = (
    0.99999999999980993,
    676.5203681218851,
    -1259.1392167224028,
    771.32342877765313,
    -176.61502916214059,
    12.507343278686905,
    -0.13857109526572012,
    9.9843695780195716e-6,
    1.5056327351493116e-7,
)
_HALF_LN_2PI = 0.9189385332046728


def lgamma(x: str, dialect: str) -> str:
    """ln Gamma(x) for x >= 0.5."""
    if dialect == DUCKDB:
        return f"lgamma({x})"
    z = f"(({x}) - 1.0D)"
    series = " + ".join(
        [repr(_LANCZOS[0]) + "D"]
        + [f"try_divide({c!r}D, {z} + {i}.0D)" for i, c in enumerate(_LANCZOS[1:], 1)]
    )
    t = f"({z} + {_LANCZOS_G + 0.5}D)"
    return f"({_HALF_LN_2PI}D + ({z} + 0.5D) * ln({t}) - {t} + ln({series}))"


def _div(num: str, den: str, dialect: str) -> str:
    # ANSI Spark raises on a zero divisor; the fractions never reach one in
    # practice, but a NULL is a better failure than a killed job.
    return f"try_divide({num}, {den})" if dialect == SPARK else f"(({num}) / ({den}))"


def _fold_down(n: str, init: str, acc: str, k: str, body: str, dialect: str) -> str:
    """Right fold over k = n, n-1, ..., 1 with a double accumulator."""
    if dialect == SPARK:
        return (
            f"aggregate(sequence(CAST({n} AS INT), 1), CAST({init} AS DOUBLE), "
            f"({acc}, {k}) -> CAST({body} AS DOUBLE))"
        )
    return (
        f"list_reduce(range(CAST({n} AS BIGINT), 0, -1), "
        f"lambda {acc}, {k}: CAST({body} AS DOUBLE), CAST({init} AS DOUBLE))"
    )


def betainc_steps(a: str, b: str, x: str, out: str, dialect: str) -> list[tuple[str, str]]:
    """Regularised incomplete beta I_x(a, b) into column ``out``.

    Continued fraction (modified to a backward evaluation of fixed depth),
    with the symmetry I_x(a,b) = 1 - I_{1-x}(b,a) above the mean.
    """
    p = f"__{out}"
    flip, aa, bb, xx = f"{p}_flip", f"{p}_a", f"{p}_b", f"{p}_x"
    depth, cf, val = f"{p}_n", f"{p}_cf", f"{p}_v"
    k = "k"
    m_odd = f"(({k} - 1) / 2.0)"
    m_even = f"({k} / 2.0)"
    den = f"(({aa} + {k} - 1.0) * ({aa} + {k}))"
    d_k = (
        f"(CASE WHEN {k} % 2 = 1 "
        f"THEN -({aa} + {m_odd}) * ({aa} + {bb} + {m_odd}) * {xx} / {den} "
        f"ELSE {m_even} * ({bb} - {m_even}) * {xx} / {den} END)"
    )
    body = f"1.0 + {_div(d_k, 'acc', dialect)}"
    steps = [
        (flip, f"({x}) > (({a}) + 1.0) / (({a}) + ({b}) + 2.0)"),
        (aa, f"CAST(CASE WHEN {flip} THEN {b} ELSE {a} END AS DOUBLE)"),
        (bb, f"CAST(CASE WHEN {flip} THEN {a} ELSE {b} END AS DOUBLE)"),
        (xx, f"CAST(CASE WHEN {flip} THEN 1.0 - ({x}) ELSE {x} END AS DOUBLE)"),
        (depth, f"CAST(60 + 8 * ceil(sqrt(greatest({aa}, {bb}))) AS INT)"),
        (cf, _fold_down(depth, "1.0", "acc", k, body, dialect)),
        (
            val,
            f"CASE WHEN {xx} <= 0.0 THEN 0.0 ELSE exp({aa} * ln({xx}) + {bb} * ln(1.0 - {xx}) "
            f"- ({lgamma(aa, dialect)} + {lgamma(bb, dialect)} - {lgamma(f'({aa} + {bb})', dialect)})) "
            f"/ ({aa} * {cf}) END",
        ),
        (
            out,
            f"CAST(CASE WHEN ({x}) IS NULL OR ({a}) IS NULL OR ({b}) IS NULL THEN NULL "
            f"WHEN ({x}) <= 0.0 THEN 0.0 WHEN ({x}) >= 1.0 THEN 1.0 "
            f"WHEN {flip} THEN 1.0 - {val} ELSE {val} END AS DOUBLE)",
        ),
    ]
    return steps


def gammaincc_steps(s: str, x: str, out: str, dialect: str) -> list[tuple[str, str]]:
    """Regularised upper incomplete gamma Q(s, x) into column ``out``.

    Power series for the lower part when x < s + 1, continued fraction for
    the upper part otherwise; both evaluated backward at a fixed depth.
    """
    p = f"__{out}"
    ss, xx, use_series = f"{p}_s", f"{p}_x", f"{p}_ser"
    n_ser, n_cf, ser, cf = f"{p}_ns", f"{p}_nc", f"{p}_sv", f"{p}_cv"
    k = "k"
    series_body = f"1.0 + {xx} / ({ss} + {k}) * acc"
    cf_body = f"({xx} + 2.0 * {k} - 1.0 - {ss}) - {_div(f'{k} * ({k} - {ss})', 'acc', dialect)}"
    log_front = f"(-{xx} + {ss} * ln({xx}))"
    return [
        (ss, f"CAST({s} AS DOUBLE)"),
        (xx, f"CAST({x} AS DOUBLE)"),
        (use_series, f"{xx} < {ss} + 1.0"),
        (n_ser, f"CAST(40 + {xx} + 12 * ceil(sqrt({xx} + 1.0)) AS INT)"),
        (n_cf, f"CAST(60 + 8 * ceil(sqrt({ss} + 1.0)) AS INT)"),
        (
            ser,
            f"CASE WHEN {use_series} AND {xx} > 0.0 THEN "
            f"{_fold_down(n_ser, '1.0', 'acc', k, series_body, dialect)} END",
        ),
        (
            cf,
            f"CASE WHEN NOT {use_series} THEN "
            f"{_fold_down(n_cf, f'({xx} + 2.0 * {n_cf} + 1.0 - {ss})', 'acc', k, cf_body, dialect)} END",
        ),
        (
            out,
            f"CAST(CASE WHEN {xx} IS NULL OR {ss} IS NULL THEN NULL "
            f"WHEN {xx} <= 0.0 THEN 1.0 "
            f"WHEN {use_series} THEN 1.0 - exp({log_front} - {lgamma(f'({ss} + 1.0)', dialect)}) * {ser} "
            f"ELSE exp({log_front} - {lgamma(ss, dialect)}) / {cf} END AS DOUBLE)",
        ),
    ]


# ----------------------------------------------------------------------
# p-values built on the two functions above.
# ----------------------------------------------------------------------


def t_two_sided_steps(r: str, df: str, out: str, dialect: str) -> list[tuple[str, str]]:
    """Two-sided p of Pearson's r with ``df`` = n - 2 degrees of freedom.

    t = r sqrt(df / (1 - r^2)) gives df / (df + t^2) = 1 - r^2, so
    p = I_{1 - r^2}(df / 2, 1 / 2).
    """
    x = f"__{out}_arg"
    return [(x, f"1.0 - ({r}) * ({r})")] + betainc_steps(
        f"(({df}) / 2.0)", "0.5", x, out, dialect
    )


def f_upper_steps(f: str, d1: str, d2: str, out: str, dialect: str) -> list[tuple[str, str]]:
    """Upper tail of the F(d1, d2) distribution at ``f``."""
    x = f"__{out}_arg"
    return [(x, f"({d2}) / (({d2}) + ({d1}) * ({f}))")] + betainc_steps(
        f"(({d2}) / 2.0)", f"(({d1}) / 2.0)", x, out, dialect
    )


def chi2_upper_steps(stat: str, dof: str, out: str, dialect: str) -> list[tuple[str, str]]:
    """Upper tail of chi-square with ``dof`` degrees of freedom (1.0 when dof = 0)."""
    tmp = f"__{out}_q"
    return gammaincc_steps(f"(({dof}) / 2.0)", f"(({stat}) / 2.0)", tmp, dialect) + [
        (out, f"CASE WHEN ({dof}) = 0 THEN 1.0 ELSE {tmp} END")
    ]


def normal_two_sided_steps(z: str, out: str, dialect: str) -> list[tuple[str, str]]:
    """min(1, 2 * (1 - Phi(z))) = erfc(z / sqrt 2) for z > 0, else 1."""
    tmp = f"__{out}_q"
    return gammaincc_steps("0.5", f"(({z}) * ({z}) / 2.0)", tmp, dialect) + [
        (out, f"CASE WHEN ({z}) IS NULL THEN NULL WHEN ({z}) <= 0.0 THEN 1.0 ELSE least(1.0, {tmp}) END")
    ]


# ----------------------------------------------------------------------
# Applying steps.
# ----------------------------------------------------------------------


def bound(steps) -> str:
    """The last step's SQL with every step before it bound to its name by
    a lambda, so that each is written (and evaluated) once however often
    the later ones use it.  A chain of columns would be inlined, and so
    multiplied, wherever the optimizer moves the result, as into a filter."""
    *first, (_, expr) = steps
    for name, sql in reversed(first):
        expr = f"transform(array({sql}), {name} -> {expr})[0]"
    return expr


def apply_spark(df, steps):
    """Add the last step as a column of a Spark DataFrame."""
    from pyspark.sql import functions as F

    return df.withColumn(steps[-1][0], F.expr(bound(steps)))


def apply_sql(select_sql: str, steps, keep: str = "*") -> str:
    """Wrap a DuckDB SELECT in one nested select per step, then drop the
    helper step columns (``__`` prefix) or project ``keep``."""
    sql = select_sql
    for i, (name, expr) in enumerate(steps):
        sql = f"SELECT *, {expr} AS {name} FROM ({sql}) AS s{i}"
    if keep == "*":
        helpers = [name for name, _ in steps[:-1] if name.startswith("__")]
        if not helpers:
            return sql
        return f"SELECT * EXCLUDE ({', '.join(helpers)}) FROM ({sql}) AS s_out"
    return f"SELECT {keep} FROM ({sql}) AS s_out"
