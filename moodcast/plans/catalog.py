"""Every query of the library, each with its DuckDB oracle (or none).

A query takes a ``Workspace`` (session + data folder) and returns a lazy
DataFrame.  ``sql`` is the equivalent DuckDB statement over the provided
tables; ``None`` marks results that SQL cannot express (model output,
numerical integration, polynomial solves), which are checked by tests.
Floating outputs are rounded to 6 decimals on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..constants import CLASSES, COLD, HOT, NEGATIVE, NEUTRAL, POSITIVE
from ..functions import comment_date, rounded, slug_of
from ..operators import (
    align,
    anova,
    comments,
    contingency,
    histogram,
    joins,
    ml,
    ranks,
    regression,
    weather,
)
from ..session import checkpoint_root, scratch_path
from ..sources import files
from . import sqlstats as S
from . import sqltukey as T
from .sqlbase import parts, q, slug_sql, with_base
from .workspace import TESTDATA, Workspace


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[Workspace], DataFrame]
    sql: str | None
    covers: str


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None, covers: str):
    def deco(fn):
        REGISTRY[name] = Entry(name, fn, with_base(sql) if sql else None, covers)
        return fn
    return deco


def _round(df: DataFrame, *cols: str) -> DataFrame:
    wanted = set(cols)
    return df.select(*[rounded(c).alias(c) if c in wanted else F.col(c) for c in df.columns])


def _r(cols: str) -> str:
    return ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in cols.split())


P = TESTDATA
WEATHER_DOUBLES = "PRCP SNOW SNWD TMAX TMIN TAVG"
LIN_DOUBLES = ("slope", "intercept", "r_value", "p_value", "stderr", "intercept_stderr")


# ----------------------------------------------------------------------
# Scans and sinks
# ----------------------------------------------------------------------


@query("scan_readings_csv", "SELECT * FROM readings", "S1 S2")
def scan_readings_csv(ws: Workspace) -> DataFrame:
    path = files.write_csv_gzip(ws.readings, scratch_path(ws.spark, "readings-csv"))
    return files.read_csv(ws.spark, [path], schemas.READINGS)


@query("scan_comments_json", "SELECT * FROM raw_comments", "S3 S4")
def scan_comments_json(ws: Workspace) -> DataFrame:
    path = files.write_json_gzip(ws.raw_comments, scratch_path(ws.spark, "comments-json"))
    return files.read_json(ws.spark, [path], schemas.RAW_COMMENTS)


@query("scan_comments_full", "SELECT subreddit, created_utc, body FROM comment_subset", "S3 P1 P5")
def scan_comments_full(ws: Workspace) -> DataFrame:
    """Records with all their fields on file, read with the whole declared
    schema; three fields are kept of them, and only those are parsed."""
    wide = ws.raw_comments.withColumn("id", F.col("comment_id").cast("string")).withColumn("score", F.length("body"))
    absent = [f for f in schemas.FULL_COMMENTS if f.name not in wide.columns]
    wide = wide.select(*[F.lit(None).cast(f.dataType).alias(f.name) if f in absent
                         else F.col(f.name).cast(f.dataType) for f in schemas.FULL_COMMENTS])
    path = files.write_json_gzip(wide, scratch_path(ws.spark, "comments-full"))
    return comments.select_communities(files.read_json(ws.spark, [path], schemas.FULL_COMMENTS),
                                       columns=("subreddit", "created_utc", "body"))


@query(
    "scan_year_pruned",
    f"""SELECT comment_id, subreddit, created_utc, body, {parts('d').replace(', CAST(day(d) AS INTEGER) AS day', '')}
        FROM (SELECT *, CAST(DATE '1970-01-01' + CAST(floor(CAST(created_utc AS BIGINT) / 86400.0) AS INTEGER) AS DATE)
                    AS d FROM comment_subset) x
        WHERE year(d) BETWEEN {P.first_year} AND {P.last_year}""",
    "S6",
)
def scan_year_pruned(ws: Workspace) -> DataFrame:
    d = comment_date("created_utc")
    laid = comments.select_communities(ws.raw_comments).withColumn("year", F.year(d)).withColumn("month", F.month(d))
    path = files.write_partitioned(laid, scratch_path(ws.spark, "comments-by-year"), ["year", "month"],
                                   fmt="json", compression="gzip")
    return files.read_years(ws.spark, path, ws.params.first_year, ws.params.last_year, fmt="json",
                            schema=schemas.RAW_COMMENTS)


@query(
    "station_lookup",
    """SELECT r.station_id, r.date, r.element, r.data_value, l.city
       FROM readings_kept r LEFT JOIN lookup l ON r.station_id = l.station_id""",
    "S7 J1",
)
def station_lookup(ws: Workspace) -> DataFrame:
    r = weather.filter_readings(ws.readings).select("station_id", "date", "element", "data_value")
    return weather.attach_city(r, ws.lookup, "left")


@query("city_slug", f"SELECT DISTINCT city, {slug_sql('city')} AS slug FROM lookup", "S11")
def city_slug(ws: Workspace) -> DataFrame:
    return ws.lookup.select("city").distinct().withColumn("slug", slug_of("city"))


@query("sink_json_roundtrip", "SELECT * FROM comment_subset", "S8")
def sink_json_roundtrip(ws: Workspace) -> DataFrame:
    subset = comments.select_communities(ws.raw_comments)
    path = files.write_json_gzip(subset, scratch_path(ws.spark, "subset-json"))
    return files.read_json(ws.spark, [path], schemas.RAW_COMMENTS)


def _weather_sink(ws: Workspace) -> str:
    return files.write_partitioned(weather.with_slug(ws.weather), scratch_path(ws.spark, "weather-by-city"),
                                   ["slug"])


@query(
    "partitioned_sink_weather",
    f"SELECT station_id, date, year, month, day, city, {_r(WEATHER_DOUBLES)}, T_label, {slug_sql('city')} AS slug "
    f"FROM weather",
    "S9 S11",
)
def partitioned_sink_weather(ws: Workspace) -> DataFrame:
    back = files.read_partitioned(ws.spark, _weather_sink(ws))
    return _round(back, *WEATHER_DOUBLES.split())


@query(
    "city_partition_scan",
    f"SELECT station_id, date, year, month, day, city, {_r(WEATHER_DOUBLES)}, T_label, {slug_sql('city')} AS slug "
    f"FROM weather WHERE {slug_sql('city')} = {q(P.city)}",
    "S5 O8",
)
def city_partition_scan(ws: Workspace) -> DataFrame:
    back = files.read_city(ws.spark, _weather_sink(ws), ws.params.city, column="slug")
    return _round(back, *WEATHER_DOUBLES.split())


@query(
    "partitioned_sink_comments",
    f"SELECT *, {slug_sql('subreddit')} AS slug FROM classified",
    "S10 S11",
)
def partitioned_sink_comments(ws: Workspace) -> DataFrame:
    df = ws.classified.drop("compound").withColumn("slug", slug_of("subreddit"))
    path = files.write_partitioned(df, scratch_path(ws.spark, "comments-by-city"), ["slug"])
    return files.read_partitioned(ws.spark, path)


@query(
    "streaming_ingest",
    f"SELECT *, {slug_sql('subreddit')} AS slug FROM classified",
    "S3 S10 P8 F2 V2 (stream)",
)
def streaming_ingest(ws: Workspace) -> DataFrame:
    """Raw comments land as JSON files; a checkpointed file stream cleans,
    classifies and writes them by city; the sink is read back."""
    from ..streaming import run_ingest
    src = files.write_json_gzip(ws.raw_comments, scratch_path(ws.spark, "comment-files"))
    return run_ingest(ws.spark, src, ws.lexicon, scratch_path(ws.spark, "stream-sink"),
                      scratch_path(ws.spark, "stream-checkpoint"))


# ----------------------------------------------------------------------
# Projections, filters, scalar functions
# ----------------------------------------------------------------------


@query("comment_subset", "SELECT * FROM comment_subset", "P1 P5")
def comment_subset(ws: Workspace) -> DataFrame:
    return comments.select_communities(ws.raw_comments)


@query(
    "readings_filtered",
    "SELECT * FROM readings_kept WHERE station_id IN (SELECT station_id FROM lookup)",
    "P5 P6 P7",
)
def readings_filtered(ws: Workspace) -> DataFrame:
    kept = weather.filter_readings(ws.readings)
    return kept.join(joins.bounded(ws.lookup.select("station_id")), "station_id", "left_semi")


@query(
    "reading_dates",
    f"""SELECT station_id, d AS date, {parts('d')}, element, data_value
        FROM (SELECT *, CAST(strptime(CAST(date AS VARCHAR), '%Y%m%d') AS DATE) AS d FROM readings) r""",
    "F1 F3",
)
def reading_dates(ws: Workspace) -> DataFrame:
    return weather.with_reading_dates(ws.readings).select(
        "station_id", "date", "year", "month", "day", "element", "data_value")


@query("comments_clean", "SELECT * FROM comments", "P8 F2 F3")
def comments_clean(ws: Workspace) -> DataFrame:
    return ws.comments


@query(
    "weather_wide",
    f"SELECT station_id, date, year, month, day, city, {_r(WEATHER_DOUBLES)}, T_label FROM weather",
    "A7 F4 P3 J1 M2 M3",
)
def weather_wide(ws: Workspace) -> DataFrame:
    return _round(ws.weather, *WEATHER_DOUBLES.split())


@query(
    "temp_label",
    """SELECT city, T_label, count(*) AS n_days, count(TAVG) AS n_with_tavg,
              round(min(TAVG), 6) AS min_tavg, round(max(TAVG), 6) AS max_tavg
       FROM weather GROUP BY city, T_label""",
    "F5 M5",
)
def temp_label(ws: Workspace) -> DataFrame:
    out = ws.weather.groupBy("city", "T_label").agg(
        F.count(F.lit(1)).alias("n_days"), F.count("TAVG").alias("n_with_tavg"),
        F.min("TAVG").alias("min_tavg"), F.max("TAVG").alias("max_tavg"))
    return _round(out, "min_tavg", "max_tavg")


# ----------------------------------------------------------------------
# Sentiment
# ----------------------------------------------------------------------


@query("sentiment_bag", "SELECT comment_id, compound FROM scored", "V2")
def sentiment_bag(ws: Workspace) -> DataFrame:
    return ws.classified.select("comment_id", "compound")


@query("sentiment_class", "SELECT sentiment, count(*) AS count FROM classified GROUP BY sentiment", "F8 M7")
def sentiment_class(ws: Workspace) -> DataFrame:
    return ws.classified.groupBy("sentiment").agg(F.count(F.lit(1)).alias("count"))


def _rules_sql() -> str:
    from ..constants import NEGATIVE_AT, POSITIVE_AT
    from ..functions import rules
    from ..functions.special import apply_sql
    from ..sources.testdata import LEXICON_ROWS
    steps = rules.compound_sql("body", rules.lexicon_map_sql(LEXICON_ROWS))
    scored = apply_sql("SELECT comment_id, body FROM comments", steps)
    return (f"SELECT comment_id, __rules_compound AS compound, CASE WHEN __rules_compound >= {POSITIVE_AT} "
            f"THEN 'positive' WHEN __rules_compound > {NEGATIVE_AT} THEN 'neutral' ELSE 'negative' END AS sentiment "
            f"FROM ({scored}) r")


@query("sentiment_rules", _rules_sql(), "V1 V2")
def sentiment_rules(ws: Workspace) -> DataFrame:
    return ws.scored("rules").select("comment_id", "compound", "sentiment")


@query("sentiment_rules_filtered", f"SELECT * FROM ({_rules_sql()}) r WHERE sentiment = {q(POSITIVE)}", "V1 V2 P13")
def sentiment_rules_filtered(ws: Workspace) -> DataFrame:
    return sentiment_rules(ws).where(F.col("sentiment") == POSITIVE)


# ----------------------------------------------------------------------
# Alignment and counts
# ----------------------------------------------------------------------


@query("daily_class_counts", "SELECT * FROM daily_counts", "A1")
def daily_class_counts(ws: Workspace) -> DataFrame:
    return ws.daily_counts


@query(
    "daily_rain",
    "SELECT year, month, day, sentiment, count, station_id, city, round(PRCP, 6) AS PRCP, has_rain FROM rain",
    "J4 P2 P9 F4 F6 O3 M9 M15",
)
def daily_rain(ws: Workspace) -> DataFrame:
    return _round(ws.rain, "PRCP")


@query(
    "daily_snow",
    "SELECT year, month, day, sentiment, count, station_id, city, round(SNOW, 6) AS SNOW, has_snow FROM snow",
    "J4 P2 P9 F6 M9 M15",
)
def daily_snow(ws: Workspace) -> DataFrame:
    return _round(ws.snow, "SNOW")


@query(
    "daily_rain_sorted",
    "SELECT year, month, day, sentiment, count, station_id, city, round(PRCP, 6) AS PRCP, has_rain FROM rain",
    "O3",
)
def daily_rain_sorted(ws: Workspace) -> DataFrame:
    """The aligned rows in (year, month, day, class) order: a range-partitioned
    distributed sort, kept apart so analyses that only aggregate skip it.
    The station is a tie-breaker, so the rows of one busy day can be spread
    over several range partitions (equal sort keys cannot be split)."""
    return daily_rain(ws).orderBy("year", "month", "day", "sentiment", "station_id")


@query("monthly_class_counts", "SELECT * FROM monthly_counts", "A2")
def monthly_class_counts(ws: Workspace) -> DataFrame:
    return ws.monthly_counts


@query(
    "monthly_rain",
    "SELECT city, year, month, sentiment, count, round(prcp_mm, 6) AS prcp_mm, has_rain FROM monthly",
    "J5 A8 P4 F6 M15",
)
def monthly_rain(ws: Workspace) -> DataFrame:
    return _round(ws.monthly, "prcp_mm")


ROW_SQL = ("w.station_id, w.date, w.year, w.month, w.day, w.city, round(w.TMAX, 6) AS TMAX, round(w.TMIN, 6) AS TMIN, "
           "round(w.TAVG, 6) AS TAVG, w.T_label, c.subreddit, c.body, c.sentiment")


@query(
    "aligned_city_day_left",
    f"SELECT {ROW_SQL} FROM weather w LEFT JOIN classified_rows c ON w.date = c.date AND w.city = c.subreddit",
    "J2",
)
def aligned_city_day_left(ws: Workspace) -> DataFrame:
    return _round(align.city_day_rows(ws.weather, ws.classified, ws.texts, "left"), "TMAX", "TMIN", "TAVG")


@query(
    "aligned_city_day",
    "SELECT station_id, date, year, month, day, city, round(TMAX, 6) AS TMAX, round(TMIN, 6) AS TMIN, "
    "round(TAVG, 6) AS TAVG, T_label, subreddit, body, sentiment FROM joined_rows",
    "J3 P11 M10 O6 O9",
)
def aligned_city_day(ws: Workspace) -> DataFrame:
    rows = align.city_day_rows(ws.weather, ws.classified, ws.texts, "inner")
    return _round(rows, "TMAX", "TMIN", "TAVG")


@query(
    "aligned_sorted",
    "SELECT station_id, date, year, month, day, city, round(TMAX, 6) AS TMAX, round(TMIN, 6) AS TMIN, "
    "round(TAVG, 6) AS TAVG, T_label, subreddit, body, sentiment FROM joined_rows",
    "O2",
)
def aligned_sorted(ws: Workspace) -> DataFrame:
    """Joined rows ordered by (year, month, day) ascending, as a distributed sort.

    What is sorted are the pieces of a (city, date), before they become
    rows; within a piece rows come by station and hash of the text.  So a
    day that holds a large share of the rows is spread over range
    partitions, and no text is shuffled once per row."""
    rows = align.city_day_rows(ws.weather, ws.classified, ws.texts, "inner", ordered=True)
    return _round(rows, "TMAX", "TMIN", "TAVG")


@query(
    "temp_class_counts",
    "SELECT T_label, sentiment, subreddit, round(TAVG, 6) AS TAVG, count FROM temp_points",
    "A3 M13",
)
def temp_class_counts(ws: Workspace) -> DataFrame:
    return _round(ws.temp_points, "TAVG")


@query("label_daily_counts", "SELECT * FROM label_daily", "A4 P10 M11 M12")
def label_daily_counts(ws: Workspace) -> DataFrame:
    return ws.label_daily


@query("class_daily_counts", "SELECT * FROM class_daily", "A5")
def class_daily_counts(ws: Workspace) -> DataFrame:
    return ws.class_daily


@query(
    "label_class_totals",
    "SELECT T_label, sentiment, CAST(sum(count) AS BIGINT) AS count FROM base GROUP BY T_label, sentiment",
    "A6",
)
def label_class_totals(ws: Workspace) -> DataFrame:
    return align.label_class_totals(ws.base)


@query(
    "class_by_flag_counts",
    "SELECT sentiment, has_rain, count(*) AS n_rows, CAST(sum(count) AS BIGINT) AS total FROM rain "
    "GROUP BY sentiment, has_rain",
    "P12",
)
def class_by_flag_counts(ws: Workspace) -> DataFrame:
    return ws.rain.groupBy("sentiment", "has_rain").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("count").alias("total"))


@query(
    "preview",
    "SELECT * FROM classified ORDER BY year NULLS FIRST, month NULLS FIRST, day NULLS FIRST, comment_id LIMIT 20",
    "O4",
)
def preview(ws: Workspace) -> DataFrame:
    return ws.classified.drop("compound").orderBy("year", "month", "day", "comment_id").limit(20)


# ----------------------------------------------------------------------
# Contingency tables and chi-square
# ----------------------------------------------------------------------

TABLES = {
    # name: (source attr, row, col, col values, weight)
    "rain_2x2": ("rain", "has_rain", "sentiment", [NEGATIVE, POSITIVE], "count"),
    "rain_2x3": ("rain", "has_rain", "sentiment", [NEGATIVE, NEUTRAL, POSITIVE], "count"),
    "snow_2x2": ("snow", "has_snow", "sentiment", [NEGATIVE, POSITIVE], "count"),
    "snow_2x3": ("snow", "has_snow", "sentiment", [NEGATIVE, NEUTRAL, POSITIVE], "count"),
    "temp_3x2": ("base", "sentiment", "T_label", [COLD, HOT], "count"),
}


def _table_input(ws: Workspace, name: str) -> DataFrame:
    return getattr(ws, TABLES[name][0])


def _register_tables():
    for name, (src, row, col, values, weight) in TABLES.items():
        base = name.split("_")[0]
        shape = name.split("_")[1]
        cont_name = f"{base}_contingency_{shape}"
        chi_name = "chi2_temp" if base == "temp" else f"chi2_{name}"
        covers = "A11" if base == "temp" else ("A9 P13" if shape == "2x2" else "A10")

        def build_pivot(ws, _n=name, _row=row, _col=col, _v=values, _w=weight):
            return contingency.pivot(_table_input(ws, _n), _row, _col, _v, _w)

        def build_chi(ws, _n=name, _row=row, _col=col, _v=values, _w=weight):
            return _round(contingency.chi2_test(_table_input(ws, _n), _row, _col, _v, _w), "chi2", "p_value")

        src_sql = f"SELECT * FROM {src}"
        query(cont_name, S.pivot_sql(src_sql, row, col, values, weight), covers)(build_pivot)
        query(chi_name, S.chi2_sql(S.cells_sql(src_sql, row, col, values, weight), row, col), "T5")(build_chi)


_register_tables()


def _expected_sql() -> str:
    parts_ = []
    for name, (src, row, col, values, weight) in TABLES.items():
        cells = S.cells_sql(f"SELECT * FROM {src}", row, col, values, weight)
        parts_.append(f"SELECT {q(name)} AS test, CAST({row} AS VARCHAR) AS row_value, CAST({col} AS VARCHAR) "
                      f"AS col_value, observed, round(expected, 6) AS expected "
                      f"FROM ({S.expected_sql(cells, row, col)}) e")
    return " UNION ALL ".join(parts_)


@query("chi2_expected", _expected_sql(), "T5")
def chi2_expected(ws: Workspace) -> DataFrame:
    frames = []
    for name, (src, row, col, values, weight) in TABLES.items():
        e = contingency.expected(_table_input(ws, name), row, col, values, weight)
        frames.append(e.select(F.lit(name).alias("test"), F.col(row).cast("string").alias("row_value"),
                               F.col(col).cast("string").alias("col_value"), "observed",
                               rounded("expected").alias("expected")))
    return reduce(DataFrame.unionByName, frames)


@query("daily_count_histogram", S.histogram_sql("SELECT * FROM rain", "sentiment", "count"), "A12")
def daily_count_histogram(ws: Workspace) -> DataFrame:
    return _round(histogram.shared_histogram(ws.rain, "sentiment", "count", 10), "bin_lo", "bin_hi")


@query("snow_count_histogram", S.histogram_sql("SELECT * FROM snow", "sentiment", "count"), "A12")
def snow_count_histogram(ws: Workspace) -> DataFrame:
    return _round(histogram.shared_histogram(ws.snow, "sentiment", "count", 10), "bin_lo", "bin_hi")


# ----------------------------------------------------------------------
# Samples
# ----------------------------------------------------------------------


@query(
    "labelled_samples_union",
    f"SELECT sentiment, year, month, day, count FROM label_daily WHERE T_label = {q(COLD)}",
    "U1",
)
def labelled_samples_union(ws: Workspace) -> DataFrame:
    cold = ws.label_daily.where(F.col("T_label") == COLD)
    frames = [cold.where(F.col("sentiment") == c).select(F.lit(c).alias("sentiment"), "year", "month", "day", "count")
              for c in CLASSES]
    return reduce(DataFrame.unionByName, frames)


def _six(flag: str, yes: str, no: str):
    return F.concat_ws("-", F.when(F.col(flag), F.lit(yes)).otherwise(F.lit(no)), F.col("sentiment"))


@query(
    "six_group_samples",
    "SELECT CASE WHEN has_rain THEN 'rain' ELSE 'noRain' END || '-' || sentiment AS grp, count FROM rain",
    "U2",
)
def six_group_samples(ws: Workspace) -> DataFrame:
    return ws.rain.select(_six("has_rain", "rain", "noRain").alias("grp"), "count")


# ----------------------------------------------------------------------
# Regression
# ----------------------------------------------------------------------


def _lin(df: DataFrame, x: str, y: str, by: list[str]) -> DataFrame:
    return _round(regression.linregress(df, x, y, by), *LIN_DOUBLES)


@query("linreg_rain", S.linreg_out("SELECT * FROM rain", "count", "PRCP", ["sentiment"]), "T1 M14")
def linreg_rain(ws: Workspace) -> DataFrame:
    return _lin(ws.rain, "count", "PRCP", ["sentiment"])


@query("linreg_rain_filtered",
       f"SELECT * FROM ({S.linreg_out('SELECT * FROM rain', 'count', 'PRCP', ['sentiment'])}) f WHERE p_value < 0.5",
       "T1 P13")
def linreg_rain_filtered(ws: Workspace) -> DataFrame:
    return linreg_rain(ws).where(F.col("p_value") < 0.5)


@query("linreg_snow", S.linreg_out("SELECT * FROM snow", "count", "SNOW", ["sentiment"]), "T1 M14")
def linreg_snow(ws: Workspace) -> DataFrame:
    return _lin(ws.snow, "count", "SNOW", ["sentiment"])


@query("linreg_temp", S.linreg_out("SELECT * FROM temp_points", "TAVG", "count", ["T_label", "sentiment"]),
       "T1 M13 M14")
def linreg_temp(ws: Workspace) -> DataFrame:
    return _lin(ws.temp_points, "TAVG", "count", ["T_label", "sentiment"])


@query("linreg_monthly", S.linreg_out("SELECT * FROM monthly", "count", "prcp_mm", ["city", "sentiment"]),
       "T1 M14")
def linreg_monthly(ws: Workspace) -> DataFrame:
    return _lin(ws.monthly, "count", "prcp_mm", ["city", "sentiment"])


def _pred_sql(src: str, x: str, y: str, by: list[str], keep: str) -> str:
    fit = S.linreg_sql(src, x, y, by)
    on = " AND ".join(f"d.{b} = f.{b}" for b in by)
    return (f"SELECT {keep}, round(f.slope * d.{x} + f.intercept, 6) AS lin_predict "
            f"FROM ({src}) d LEFT JOIN ({fit}) f ON {on}")


@query(
    "linreg_predictions",
    _pred_sql("SELECT * FROM monthly", "prcp_mm", "count", ["city", "sentiment"],
              "d.city, d.sentiment, d.year, d.month, round(d.prcp_mm, 6) AS prcp_mm, d.count"),
    "T2 F9",
)
def linreg_predictions(ws: Workspace) -> DataFrame:
    fit = regression.linregress(ws.monthly, "prcp_mm", "count", ["city", "sentiment"])
    pts = ws.monthly.select("city", "sentiment", "year", "month", "prcp_mm", "count")
    return _round(regression.with_line(pts, fit, "prcp_mm", ["city", "sentiment"]), "prcp_mm", "lin_predict")


@query(
    "fit_series",
    _pred_sql("SELECT * FROM rain", "count", "PRCP", ["sentiment"],
              "d.sentiment, d.year, d.month, d.day, d.station_id, d.count, round(d.PRCP, 6) AS PRCP"),
    "T11 F9",
)
def fit_series(ws: Workspace) -> DataFrame:
    fit = regression.linregress(ws.rain, "count", "PRCP", ["sentiment"])
    pts = ws.rain.select("sentiment", "year", "month", "day", "station_id", "count", "PRCP")
    return _round(regression.with_line(pts, fit, "count", ["sentiment"]), "PRCP", "lin_predict")


@query(
    "fit_series_snow",
    _pred_sql("SELECT * FROM snow", "count", "SNOW", ["sentiment"],
              "d.sentiment, d.year, d.month, d.day, d.station_id, d.count, round(d.SNOW, 6) AS SNOW"),
    "T11 F9",
)
def fit_series_snow(ws: Workspace) -> DataFrame:
    fit = regression.linregress(ws.snow, "count", "SNOW", ["sentiment"])
    pts = ws.snow.select("sentiment", "year", "month", "day", "station_id", "count", "SNOW")
    return _round(regression.with_line(pts, fit, "count", ["sentiment"]), "SNOW", "lin_predict")


@query(
    "rain_loglog_series",
    f"""SELECT sentiment, year, month, day, station_id, count, PRCP, round(log10(count), 6) AS log_count,
               round(log10(PRCP), 6) AS log_prcp, lin_predict
        FROM ({_pred_sql('SELECT * FROM rain', 'count', 'PRCP', ['sentiment'],
                         'd.sentiment, d.year, d.month, d.day, d.station_id, d.count, round(d.PRCP, 6) AS PRCP')}) s
        WHERE count > 0 AND PRCP > 0""",
    "T12",
)
def rain_loglog_series(ws: Workspace) -> DataFrame:
    s = fit_series(ws).where((F.col("count") > 0) & (F.col("PRCP") > 0))
    return s.select("sentiment", "year", "month", "day", "station_id", "count", "PRCP",
                    rounded(F.log10("count")).alias("log_count"), rounded(F.log10("PRCP")).alias("log_prcp"),
                    "lin_predict")


def _poly_sql(src: str, x: str, y: str, degree: int, by: list[str], rest: list[str]) -> str:
    keep = by + rest + [x, y]
    poly = S.polyfit_sql(src, x, y, degree, by, keep)
    fit = S.linreg_sql(src, x, y, by)
    on = " AND ".join(f"p.{b} = f.{b}" for b in by)
    cols = ", ".join(f"p.{c}" for c in by + rest)
    return (f"SELECT {cols}, round(p.{x}, 6) AS {x}, p.{y}, round(f.slope * p.{x} + f.intercept, 6) AS lin_predict, "
            f"p.poly_predict FROM ({poly}) p LEFT JOIN ({fit}) f ON {on}")


@query("polyfit4_temp",
       _poly_sql("SELECT * FROM temp_points", "TAVG", "count", 4, ["T_label", "sentiment"], ["subreddit"]),
       "T3 T11 P14")
def polyfit4_temp(ws: Workspace) -> DataFrame:
    by = ["T_label", "sentiment"]
    pts = ws.temp_points.withColumn("TAVG", F.col("TAVG").cast("double")).withColumn("count", F.col("count").cast("long"))
    return _round(regression.fit_series(pts, "TAVG", "count", 4, by), "TAVG", "lin_predict", "poly_predict")


@query("polyfit11_monthly",
       _poly_sql("SELECT * FROM monthly", "prcp_mm", "count", 11, ["city", "sentiment"], ["year", "month"]),
       "T4 T2")
def polyfit11_monthly(ws: Workspace) -> DataFrame:
    by = ["city", "sentiment"]
    pts = ws.monthly.select("city", "sentiment", "year", "month", "prcp_mm", "count")
    return _round(regression.fit_series(pts, "prcp_mm", "count", 11, by), "prcp_mm", "lin_predict", "poly_predict")


# ----------------------------------------------------------------------
# ANOVA, Tukey, Mann-Whitney
# ----------------------------------------------------------------------

SAMPLES = {
    # name: (source attr, filter (SQL, both dialects), group SQL, (flag, yes, no) for two-part groups)
    "cold": ("label_daily", f"T_label = {q(COLD)}", "sentiment", None),
    "hot": ("label_daily", f"T_label = {q(HOT)}", "sentiment", None),
    "rain": ("rain", "has_rain", "sentiment", None),
    "snow": ("snow", "has_snow", "sentiment", None),
    "rain_combined": ("rain", "true", "CASE WHEN has_rain THEN 'rain' ELSE 'noRain' END || '-' || sentiment",
                      ("has_rain", "rain", "noRain")),
    "snow_combined": ("snow", "true", "CASE WHEN has_snow THEN 'snow' ELSE 'noSnow' END || '-' || sentiment",
                      ("has_snow", "snow", "noSnow")),
}


def _samples(ws: Workspace, name: str) -> DataFrame:
    src, cond, _, six = SAMPLES[name]
    df = getattr(ws, src).where(F.expr(cond))
    grp = _six(*six) if six else F.col("sentiment")
    return df.select(grp.alias("grp"), F.col("count"))


def _samples_sql(name: str) -> str:
    src, cond_sql, grp_sql, _ = SAMPLES[name]
    return f"SELECT {grp_sql} AS grp, count FROM {src} WHERE {cond_sql}"


def _register_tests():
    for name in SAMPLES:
        covers_a = "T8" if "combined" in name else "T7"
        covers_t = "T10" if "combined" in name else "T9"

        def build_anova(ws, _n=name):
            return _round(anova.one_way_anova(_samples(ws, _n), "grp", "count"), "f_stat", "p_value")

        def build_tukey(ws, _n=name):
            return _round(anova.tukey_hsd(_samples(ws, _n), "grp", "count"), "meandiff", "p_adj", "lower", "upper")

        query(f"anova_{name}", S.anova_sql(_samples_sql(name), "grp", "count"), covers_a)(build_anova)
        query(f"tukey_{name}", T.tukey_sql(_samples_sql(name), "grp", "count"), covers_t)(build_tukey)


_register_tests()

MW_PAIRS = [(POSITIVE, NEGATIVE), (NEUTRAL, NEGATIVE), (POSITIVE, NEUTRAL)]


@query("mannwhitney_pairs", S.mannwhitney_sql("SELECT * FROM class_daily", "sentiment", "count", MW_PAIRS), "T6")
def mannwhitney_pairs(ws: Workspace) -> DataFrame:
    return _round(ranks.mann_whitney(ws.class_daily, "sentiment", "count", MW_PAIRS), "u_stat", "p_value")


# ----------------------------------------------------------------------
# The same statistics over order lines (the largest provided table)
# ----------------------------------------------------------------------

LINE_FLAGS = ["A", "N", "R"]
LINE_PAIRS = [("A", "N"), ("A", "R"), ("N", "R")]


@query("lines_daily_counts",
       "SELECT date, sentiment, count(*) AS count FROM lines GROUP BY date, sentiment", "A1")
def lines_daily_counts(ws: Workspace) -> DataFrame:
    return align.class_counts(ws.lines, ["date", "sentiment"])


@query("lines_contingency_2x3", S.pivot_sql("SELECT * FROM lines", "status", "sentiment", LINE_FLAGS, None), "A10")
def lines_contingency_2x3(ws: Workspace) -> DataFrame:
    return contingency.pivot(ws.lines, "status", "sentiment", LINE_FLAGS)


@query("lines_chi2", S.chi2_sql(S.cells_sql("SELECT * FROM lines", "status", "sentiment", LINE_FLAGS, None),
                                "status", "sentiment"), "T5")
def lines_chi2(ws: Workspace) -> DataFrame:
    return _round(contingency.chi2_test(ws.lines, "status", "sentiment", LINE_FLAGS), "chi2", "p_value")


@query("lines_anova", S.anova_sql("SELECT sentiment AS grp, quantity FROM lines", "grp", "quantity"), "T7")
def lines_anova(ws: Workspace) -> DataFrame:
    df = ws.lines.select(F.col("sentiment").alias("grp"), "quantity")
    return _round(anova.one_way_anova(df, "grp", "quantity"), "f_stat", "p_value")


@query("lines_tukey", T.tukey_sql("SELECT sentiment AS grp, quantity FROM lines", "grp", "quantity"), "T9")
def lines_tukey(ws: Workspace) -> DataFrame:
    df = ws.lines.select(F.col("sentiment").alias("grp"), "quantity")
    return _round(anova.tukey_hsd(df, "grp", "quantity"), "meandiff", "p_adj", "lower", "upper")


@query("lines_linreg", S.linreg_out("SELECT * FROM lines", "quantity", "price", ["sentiment"]), "T1")
def lines_linreg(ws: Workspace) -> DataFrame:
    return _lin(ws.lines, "quantity", "price", ["sentiment"])


@query("lines_mannwhitney", S.mannwhitney_sql("SELECT * FROM lines", "sentiment", "price", LINE_PAIRS), "T6")
def lines_mannwhitney(ws: Workspace) -> DataFrame:
    return _round(ranks.mann_whitney(ws.lines, "sentiment", "price", LINE_PAIRS), "u_stat", "p_value")


@query("lines_histogram", S.histogram_sql("SELECT * FROM lines", "sentiment", "discount"), "A12")
def lines_histogram(ws: Workspace) -> DataFrame:
    return _round(histogram.shared_histogram(ws.lines, "sentiment", "discount", 10), "bin_lo", "bin_hi")


# ----------------------------------------------------------------------
# Machine learning
# ----------------------------------------------------------------------

FOREST_SQL = ("SELECT w.station_id, w.date, c.comment_id, w.city, w.PRCP, w.SNOW, w.TMAX, w.TMIN, w.TAVG, c.sentiment "
              "FROM weather w JOIN classified c ON w.date = c.date AND w.city = c.subreddit "
              "WHERE w.PRCP IS NOT NULL AND w.SNOW IS NOT NULL AND w.TMAX IS NOT NULL AND w.TMIN IS NOT NULL "
              "AND w.TAVG IS NOT NULL AND c.sentiment IS NOT NULL")


def _index_sql(col: str) -> str:
    return (f"SELECT {q(col)} AS column_name, value, CAST(row_number() OVER (ORDER BY n DESC, value) - 1 AS DOUBLE) "
            f"AS idx FROM (SELECT {col} AS value, count(*) AS n FROM ({FOREST_SQL}) f GROUP BY {col}) g")


@query("string_index", f"{_index_sql('sentiment')} UNION ALL {_index_sql('city')}", "L1")
def string_index(ws: Workspace) -> DataFrame:
    """The labels of the fitted model are the answer: no pass of its own."""
    labels = ml.index_labels(ml.forest_index(ws.weather, ws.classified))
    rows = [(c, v, float(i)) for c, vs in zip(["sentiment", "city"], labels) for i, v in enumerate(vs)]
    return ws.spark.createDataFrame(rows, "column_name string, value string, idx double")


def _feature_sql() -> str:
    def idx(col: str) -> str:
        return (f"SELECT value AS {col}, CAST(row_number() OVER (ORDER BY n DESC, value) - 1 AS DOUBLE) AS {col}_index "
                f"FROM (SELECT {col} AS value, count(*) AS n FROM ({FOREST_SQL}) f GROUP BY {col}) g")
    return (f"SELECT f.station_id, f.date, f.comment_id, "
            f"list_transform([c.city_index, f.PRCP, f.SNOW, f.TMAX, f.TMIN, f.TAVG], lambda v: round(v, 6)) "
            f"AS features, s.sentiment_index "
            f"FROM ({FOREST_SQL}) f JOIN ({idx('city')}) c ON f.city = c.city "
            f"JOIN ({idx('sentiment')}) s ON f.sentiment = s.sentiment")


@query("feature_vector", _feature_sql(), "L2")
def feature_vector(ws: Workspace) -> DataFrame:
    data = ml.prepared(ws.weather, ws.classified)
    arr = F.transform(vector_to_array("features"), lambda v: F.round(v, 6))
    return data.select("station_id", "date", "comment_id", arr.alias("features"), "sentiment_index")


def _bucket_sql() -> str:
    key = "concat_ws('|', CAST(station_id AS VARCHAR), CAST(date AS VARCHAR), CAST(comment_id AS VARCHAR))"
    return f"CAST(CAST('0x' || substr(md5({key}), 1, 7) AS BIGINT) % 100 AS INTEGER)"


@query(
    "train_test_split",
    f"SELECT station_id, date, comment_id, bucket, CASE WHEN bucket < 75 THEN 'train' ELSE 'test' END AS part "
    f"FROM (SELECT *, {_bucket_sql()} AS bucket FROM ({FOREST_SQL}) f) b",
    "L3 D7",
)
def train_test_split(ws: Workspace) -> DataFrame:
    rows = ml.forest_rows(ws.weather, ws.classified).withColumn(
        "bucket", ml.split_bucket(["station_id", "date", "comment_id"]))
    return rows.select("station_id", "date", "comment_id", "bucket",
                       F.when(F.col("bucket") < 75, F.lit("train")).otherwise(F.lit("test")).alias("part"))


def _forest_fit(ws: Workspace):
    """The indexer, the split counted by features and class, and the forest,
    trained on those counts once per workspace."""
    fit = ws.__dict__.get("_forest_fit")
    if fit is None:
        checkpoint_root(ws.spark)
        index = ml.forest_index(ws.weather, ws.classified)
        counted = joins.keep(ml.assemble(index.transform(ml.split_counts(ws.weather, ws.classified))))
        model = ml.train_forest(counted.where("n_train > 0"), cities=len(ml.index_labels(index)[1]), count="n_train")
        fit = ws.__dict__["_forest_fit"] = (index, counted.where("n_test > 0"), model)
    return fit


def _test_rows(ws: Workspace):
    index, _, _ = _forest_fit(ws)
    return ml.hash_split(ml.prepared(ws.weather, ws.classified, index), ml.ROW_KEYS)[1]


def _forest(ws: Workspace):
    """Test rows with predictions."""
    cached = ws.__dict__.get("_forest")
    if cached is None:
        _, kinds, model = _forest_fit(ws)
        cached = ws.__dict__["_forest"] = ml.scored(model, _test_rows(ws), kinds=kinds)
    return cached


def _test_sql() -> str:
    return (f"SELECT f.station_id, f.date, f.comment_id, f.sentiment_index, count(*) OVER () AS n_test "
            f"FROM ({_feature_sql()}) f JOIN (SELECT *, {_bucket_sql()} AS bucket FROM ({FOREST_SQL}) r) b "
            f"ON f.station_id = b.station_id AND f.date = b.date AND f.comment_id = b.comment_id WHERE b.bucket >= 75")


@query("rf_scored_keys", _test_sql(), "L4 L5")
def rf_scored_keys(ws: Workspace) -> DataFrame:
    """What SQL can say of the scored test set: its keys, its labels and
    its size, each row with a prediction that is one of the labels."""
    scored = _forest(ws)
    n = scored.agg(F.count(F.lit(1)).alias("n")).scalar()
    p = F.col("prediction")
    return (scored.where((p >= 0) & (p < len(CLASSES)) & (p == F.floor(p)))
            .select("station_id", "date", "comment_id", "sentiment_index", n.alias("n_test")))


@query("rf_predictions", None, "L4 L5")
def rf_predictions(ws: Workspace) -> DataFrame:
    return _forest(ws).select("station_id", "date", "comment_id", "sentiment_index", "prediction")


@query("rf_replayed", None, "L4 L5")
def rf_replayed(ws: Workspace) -> DataFrame:
    """The predictions once more: the fitted trees as rows, walked by joins."""
    _, _, model = _forest_fit(ws)
    return ml.replay(_test_rows(ws), ml.tree_rows(model), ml.ROW_KEYS)


@query("rf_accuracy", None, "L6")
def rf_accuracy(ws: Workspace) -> DataFrame:
    """Over the counted test rows: equal rows have the same prediction."""
    _, test, model = _forest_fit(ws)
    return _round(ml.accuracy(ml.scored(model, test), "n_test"), "accuracy")


# ----------------------------------------------------------------------
# Public helpers
# ----------------------------------------------------------------------


def run(name: str, spark, sf_dir: str) -> DataFrame:
    from .workspace import workspace
    return REGISTRY[name].build(workspace(spark, sf_dir))
