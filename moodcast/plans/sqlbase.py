"""The stand-in views and shared steps as DuckDB SQL (oracle side).

These CTEs restate, in plain SQL, what ``sources.testdata`` and the
operators build with DataFrames, so the oracle is an independent
second implementation over the same parquet tables.
"""

from __future__ import annotations


from ..constants import (
    COMMUNITIES,
    COMPOUND_ALPHA,
    ELEMENTS,
    MISSING_SENTINEL,
    NEGATIVE_AT,
    POSITIVE_AT,
    SLUG_EXCEPTIONS,
    TOMBSTONES,
)
from ..sources.testdata import (
    DOC_EVENT_STRIDE,
    DRY_BELOW,
    EVENT_ELEMENT,
    LEXICON_ROWS,
    NO_STATION_SEGMENT,
    ORDER_RAIN_DIVISOR,
    OTHER_COMMUNITY,
    REMOVED_SOURCES,
    SENSOR_LIMIT,
)
from .workspace import TESTDATA, Params


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def city_sql(key: str) -> str:
    idx = f"((({key}) % {len(COMMUNITIES)}) + {len(COMMUNITIES)}) % {len(COMMUNITIES)}"
    whens = " ".join(f"WHEN {i} THEN {q(c)}" for i, c in enumerate(COMMUNITIES))
    return f"(CASE {idx} {whens} END)"


def community_sql(key: str) -> str:
    names = [*COMMUNITIES, OTHER_COMMUNITY]
    whens = " ".join(f"WHEN {i} THEN {q(c)}" for i, c in enumerate(names))
    return f"(CASE (({key}) % {len(names)} + {len(names)}) % {len(names)} {whens} END)"


def slug_sql(city: str) -> str:
    whens = " ".join(f"WHEN {city} = {q(k)} THEN {q(v)}" for k, v in SLUG_EXCEPTIONS.items())
    return f"(CASE {whens} ELSE lower({city}) END)"


def parts(d: str) -> str:
    return (f"CAST(year({d}) AS INTEGER) AS year, CAST(month({d}) AS INTEGER) AS month, "
            f"CAST(day({d}) AS INTEGER) AS day")


def r6(x: str, alias: str, decimals: int = 6) -> str:
    return f"round(CAST({x} AS DOUBLE), {decimals}) AS {alias}"


def base_ctes(p: Params = TESTDATA) -> str:
    element_case = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in EVENT_ELEMENT.items())
    removed = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in REMOVED_SOURCES.items())
    rain_event = next(k for k, v in EVENT_ELEMENT.items() if v == "PRCP")
    sums = ", ".join(f"sum(CASE WHEN element = {q(e)} THEN data_value END) AS {e}" for e in ELEMENTS)
    lex_values = ", ".join(f"({q(t)}, CAST({v!r} AS DOUBLE))" for t, v in LEXICON_ROWS)
    tmax, tmin = "(TMAX / 10.0)", "(TMIN / 10.0)"
    tavg = f"(({tmax} + {tmin}) / 2)"
    return f"""
readings AS (
  SELECT CAST(user_id AS VARCHAR) AS station_id,
         CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS date,
         CASE event_type {element_case} ELSE event_type END AS element,
         CASE WHEN value > {SENSOR_LIMIT} THEN {MISSING_SENTINEL}
              WHEN event_type = {q(rain_event)} AND value < {DRY_BELOW} THEN 0.0 ELSE CAST(value AS DOUBLE) END AS data_value,
         CAST(NULL AS VARCHAR) AS m_flag, CAST(NULL AS VARCHAR) AS q_flag, CAST(NULL AS VARCHAR) AS s_flag,
         CAST(hour(ts) * 100 + minute(ts) AS INTEGER) AS obs_time
  FROM events),
lookup AS (
  SELECT CAST(c_custkey AS VARCHAR) AS station_id, {city_sql('c_custkey')} AS city
  FROM customer WHERE c_mktsegment <> {q(NO_STATION_SEGMENT)}),
readings_kept AS (
  SELECT * FROM readings
  WHERE element IN {in_list(ELEMENTS)} AND data_value <> {MISSING_SENTINEL}),
weather_wide AS (
  SELECT station_id, city, date, {sums}
  FROM (SELECT r.station_id, l.city, CAST(strptime(CAST(r.date AS VARCHAR), '%Y%m%d') AS DATE) AS date,
               r.element, r.data_value
        FROM readings_kept r JOIN lookup l ON r.station_id = l.station_id) x
  GROUP BY station_id, city, date),
weather AS (
  SELECT station_id, date, {parts('date')}, city, PRCP, SNOW, SNWD,
         {tmax} AS TMAX, {tmin} AS TMIN, {tavg} AS TAVG,
         CASE WHEN {tavg} > {p.hot} THEN 'hot' ELSE 'cold' END AS T_label
  FROM weather_wide),
raw_comments AS (
  SELECT d.doc_id AS comment_id, {community_sql('e.user_id')} AS subreddit,
         CAST(epoch_us(e.ts) // 1000000 AS VARCHAR) AS created_utc, CASE d.source {removed} ELSE d.text END AS body
  FROM documents d JOIN events e
    ON e.event_id = (d.doc_id * {DOC_EVENT_STRIDE}) % (SELECT count(*) FROM events)),
comment_subset AS (
  SELECT comment_id, subreddit, created_utc, body FROM raw_comments
  WHERE subreddit IN {in_list(COMMUNITIES)}),
comments AS (
  SELECT comment_id, subreddit, date, {parts('date')}, body
  FROM (SELECT *, CAST(DATE '1970-01-01' + CAST(floor(TRY_CAST(created_utc AS BIGINT) / 86400.0) AS INTEGER)
                  AS DATE) AS date
        FROM comment_subset
        WHERE {' AND '.join(f'body <> {q(t)}' for t in TOMBSTONES)}) x),
lexicon(token, valence) AS (VALUES {lex_values}),
scores AS (
  SELECT w.comment_id, sum(l.valence) AS s
  FROM (SELECT comment_id, unnest(regexp_split_to_array(lower(body), '[^\\p{{L}}]+')) AS token
        FROM comments) w
  JOIN lexicon l ON w.token = l.token
  GROUP BY w.comment_id),
scored AS (
  SELECT c.*, round(coalesce(s.s, 0.0) / sqrt(coalesce(s.s, 0.0) * coalesce(s.s, 0.0) + {COMPOUND_ALPHA}), 4)
         AS compound
  FROM comments c LEFT JOIN scores s ON c.comment_id = s.comment_id),
classified_rows AS (
  SELECT *, CASE WHEN compound >= {POSITIVE_AT} THEN 'positive' WHEN compound > {NEGATIVE_AT} THEN 'neutral'
                 ELSE 'negative' END AS sentiment
  FROM scored),
classified AS (
  SELECT comment_id, subreddit, date, year, month, day, sentiment FROM classified_rows),
daily_counts AS (
  SELECT year, month, day, sentiment, count(*) AS count FROM classified GROUP BY year, month, day, sentiment),
rain AS (
  SELECT c.year, c.month, c.day, c.sentiment, c.count, w.station_id, w.city, w.PRCP / 10.0 AS PRCP,
         coalesce(w.PRCP / 10.0 > {p.rain}, false) AS has_rain
  FROM (SELECT * FROM weather WHERE PRCP / 10.0 IS NOT NULL) w
  JOIN daily_counts c ON c.year = w.year AND c.month = w.month AND c.day = w.day),
snow AS (
  SELECT c.year, c.month, c.day, c.sentiment, c.count, w.station_id, w.city, w.SNOW,
         coalesce(w.SNOW > {p.snow}, false) AS has_snow
  FROM (SELECT * FROM weather WHERE SNOW IS NOT NULL) w
  JOIN daily_counts c ON c.year = w.year AND c.month = w.month AND c.day = w.day),
joined_rows AS (
  SELECT w.station_id, w.date, w.year, w.month, w.day, w.city, w.TMAX, w.TMIN, w.TAVG, w.T_label,
         c.subreddit, c.body, c.sentiment
  FROM weather w JOIN classified_rows c ON w.date = c.date AND w.city = c.subreddit
  WHERE w.TMAX IS NOT NULL AND w.TMIN IS NOT NULL AND w.TAVG IS NOT NULL AND c.body IS NOT NULL),
base AS (
  SELECT T_label, sentiment, subreddit, TAVG, date, year, month, day, count(*) AS count
  FROM joined_rows GROUP BY T_label, sentiment, subreddit, TAVG, date, year, month, day),
label_daily AS (
  SELECT T_label, sentiment, year, month, day, CAST(sum(count) AS BIGINT) AS count
  FROM base GROUP BY T_label, sentiment, year, month, day),
class_daily AS (
  SELECT sentiment, year, month, day, CAST(sum(count) AS BIGINT) AS count
  FROM base GROUP BY sentiment, year, month, day),
temp_points AS (
  SELECT T_label, sentiment, subreddit, TAVG, CAST(sum(count) AS BIGINT) AS count
  FROM base GROUP BY T_label, sentiment, subreddit, TAVG),
line_classes AS (
  SELECT {city_sql('l_suppkey')} AS city, CAST(l_shipdate AS DATE) AS date,
         CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         l_returnflag AS sentiment
  FROM lineitem),
monthly_counts AS (
  SELECT city, year, month, sentiment, count(*) AS count FROM line_classes GROUP BY city, year, month, sentiment),
monthly_prcp AS (
  SELECT city, year, month, sum(PRCP / 10.0) AS prcp_mm
  FROM (SELECT {city_sql('o_custkey')} AS city, CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month, o_totalprice / {ORDER_RAIN_DIVISOR} AS PRCP
        FROM orders) o
  WHERE PRCP IS NOT NULL
  GROUP BY city, year, month),
lines AS (
  SELECT l_returnflag AS sentiment, l_linestatus AS status, CAST(l_shipdate AS DATE) AS date,
         l_quantity AS quantity, l_discount AS discount, l_extendedprice AS price
  FROM lineitem),
monthly AS (
  SELECT c.city, c.year, c.month, c.sentiment, c.count, m.prcp_mm,
         coalesce(m.prcp_mm > {p.monthly_rain}, false) AS has_rain
  FROM monthly_counts c JOIN monthly_prcp m ON c.city = m.city AND c.year = m.year AND c.month = m.month)
"""


def positive_zero_rounding(sql: str) -> str:
    """Rewrite every ``round(...)`` call as ``(round(...) + 0.0)``.

    DuckDB rounds a tiny negative number to -0.0 where Spark gives 0.0;
    adding 0.0 turns -0.0 into 0.0 and leaves every other value as it is.
    String literals are left alone.
    """
    out: list[str] = []
    stack: list[bool] = []  # one entry per open parenthesis: closes a round( call?
    i, n, quote = 0, len(sql), False
    while i < n:
        ch = sql[i]
        if ch == "'":
            quote = not quote
            out.append(ch)
        elif quote:
            out.append(ch)
        elif sql[i:i + 6].lower() == "round(" and (i == 0 or not (sql[i - 1].isalnum() or sql[i - 1] == "_")):
            out.append("(round(")
            stack.append(True)
            i += 6
            continue
        elif ch == "(":
            stack.append(False)
            out.append(ch)
        elif ch == ")":
            out.append(") + 0.0)" if stack and stack.pop() else ")")
        else:
            out.append(ch)
        i += 1
    return "".join(out)


def with_base(select_sql: str, p: Params = TESTDATA) -> str:
    return positive_zero_rounding(f"WITH {base_ctes(p)}\n{select_sql}")
