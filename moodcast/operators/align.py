"""Line up comment classes with weather by day (or month) and place.

Counting happens before joining wherever only counts are used: comments
collapse to (day, class) or (city, day, class) counts, which are bounded
by the calendar, so the join streams the weather rows past a counted
broadcast instead of shuffling either side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import TENTHS
from ..functions import flag
from . import joins

DAY = ["year", "month", "day"]
MONTH = ["year", "month"]


def class_counts(classified: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key; a key without a comment of a class has no row."""
    return classified.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def daily_class_counts(classified: DataFrame) -> DataFrame:
    return class_counts(classified, DAY + ["sentiment"])


def monthly_class_counts(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return class_counts(classified, list(by) + MONTH + ["sentiment"])


def align_daily(counts: DataFrame, weather: DataFrame, measure: str, flag_name: str,
                threshold: float, scale: float | None = None) -> DataFrame:
    """Daily class counts x every station reporting ``measure`` that day.

    The join is on the date only, so one daily count meets every station
    of that day.  ``scale`` divides the measure first (PRCP is stored in
    tenths); rows without the measure are dropped.
    """
    value = F.col(measure) / F.lit(scale) if scale else F.col(measure)
    w = (weather.select(*DAY, "station_id", "city", value.alias(measure))
         .where(F.col(measure).isNotNull()))
    joined = w.join(joins.bounded(counts), DAY)
    return joined.select(*DAY, "sentiment", "count", "station_id", "city", measure,
                         flag(measure, threshold).alias(flag_name))


def monthly_measure(daily: DataFrame, measure: str = "PRCP", out: str = "prcp_mm",
                    by: Sequence[str] = ()) -> DataFrame:
    """Monthly total of a tenths-of-mm measure in mm (NULL days skipped)."""
    return (daily.where(F.col(measure).isNotNull())
            .groupBy(*by, *MONTH).agg(F.sum(F.col(measure) / TENTHS).alias(out)))


def align_monthly(counts: DataFrame, monthly: DataFrame, threshold: float,
                  by: Sequence[str] = (), measure: str = "prcp_mm",
                  flag_name: str = "has_rain") -> DataFrame:
    """Monthly class counts x monthly measure on (by..., year, month)."""
    joined = counts.join(joins.bounded(monthly), list(by) + MONTH)
    return joined.withColumn(flag_name, flag(measure, threshold))


# ----------------------------------------------------------------------
# City x day alignment.
# ----------------------------------------------------------------------

ROW_COLUMNS = ["station_id", "date", "year", "month", "day", "city", "TMAX", "TMIN",
               "TAVG", "T_label", "subreddit", "body", "sentiment"]
STATION_COLUMNS = ["station_id", "year", "month", "day", "TMAX", "TMIN", "TAVG", "T_label"]

#: Comments and station days that a piece of a (city, date) holds, about.  A
#: task groups up to 128 pieces at once, in memory, and comments can be long.
PIECE_COMMENTS, PIECE_STATIONS = 256, 8192


def _weather_columns(weather: DataFrame, how: str) -> DataFrame:
    w = weather.select("station_id", "date", "year", "month", "day", "city",
                       "TMAX", "TMIN", "TAVG", "T_label")
    if how == "inner":  # incomplete station days go before anything is joined to them
        for name in w.columns:
            w = w.where(F.col(name).isNotNull())
    return w


def city_day_pieces(w: DataFrame, classified: DataFrame, texts: DataFrame) -> DataFrame:
    """(city, date, s_piece, c_piece, stations, comments): the station days
    and the comments, with text, of every (city, date) that has both.

    Both sides of a large (city, date) are cut into pieces of bounded size,
    and each piece of the one is put beside each of the other, so a row is
    bounded and hot days spread over tasks.  The text crosses one join, to
    its comment, and one grouping.  Comments are in order of the hash of the
    text; station days are in no order.
    """
    c = classified.select("comment_id", "date", F.col("subreddit").alias("city"), "sentiment")
    n_c = c.groupBy("city", "date").agg(F.ceil(F.count(F.lit(1)) / PIECE_COMMENTS).alias("c_pieces"))
    n_s = w.groupBy("city", "date").agg(F.ceil(F.count(F.lit(1)) / PIECE_STATIONS).alias("s_pieces"))
    pieces = joins.bounded(n_c.join(n_s, ["city", "date"]))  # cities x days
    c = c.join(pieces, ["city", "date"]).join(texts.select("comment_id", "body"), "comment_id")
    c = c.select("city", "date", F.explode(F.sequence(F.lit(0), F.col("s_pieces") - 1)).alias("s_piece"),
                 F.pmod(F.xxhash64("comment_id"), "c_pieces").alias("c_piece"),
                 F.struct(F.xxhash64("body").alias("hash"), "body", "sentiment").alias("comment"))
    s = w.join(pieces, ["city", "date"])
    s = s.select("city", "date", F.pmod(F.xxhash64("station_id"), "s_pieces").alias("s_piece"),
                 F.explode(F.sequence(F.lit(0), F.col("c_pieces") - 1)).alias("c_piece"),
                 F.struct(*STATION_COLUMNS).alias("station"))
    return (c.unionByName(s, allowMissingColumns=True).groupBy("city", "date", "s_piece", "c_piece")
            .agg(F.collect_list("station").alias("stations"),
                 F.array_sort(F.collect_list("comment")).alias("comments")))


def _expanded(pieces: DataFrame) -> DataFrame:
    """Pieces to rows, by station and then by comment.

    Generated code holds all rows that it makes of one row it reads, so two
    compiled explodes would hold every pair of a piece, each with its text.
    ``array_sort`` is not compiled, and so neither is the explode above it,
    which hands on one station day at a time: what is held are the rows of
    one station day, the comments of a piece.
    """
    rows = pieces.select("city", "date", F.explode(F.array_sort("stations")).alias("s"), "comments")
    rows = rows.select("city", "date", "s", F.explode("comments").alias("c"))
    return rows.select("city", "date", "s.*", "c.body", "c.sentiment", F.col("city").alias("subreddit")).select(*ROW_COLUMNS)


def city_day_rows(weather: DataFrame, classified: DataFrame, texts: DataFrame, how: str = "inner",
                  ordered: bool = False) -> DataFrame:
    """Row-level weather x comments on (date, city = community), with text.

    Every comment meets its text first, once; station days and comments
    are then brought together in pieces of a (city, date)
    (``city_day_pieces``), and become rows in the tasks that hold them.  So
    what is shuffled grows with the two inputs, not with the rows, of which
    each repeats a text.  ``how='inner'`` drops incomplete rows.
    ``how='left'`` keeps station days without comments, with NULL comment
    fields, written as the inner join plus the station days whose
    (city, date) has no comment at all (anti join against the counted,
    broadcast set of comment keys).  ``ordered`` sorts the rows of an inner
    join by date and city: the pieces are sorted before they become rows.
    """
    if how not in ("inner", "left") or (ordered and how == "left"):
        raise ValueError("how must be 'inner' or 'left', and 'inner' if ordered")
    w = _weather_columns(weather, how)
    pieces = city_day_pieces(w, classified, texts)
    if ordered:
        pieces = pieces.orderBy("date", "city", "s_piece", "c_piece")
    joined = _expanded(pieces)
    if how == "inner":
        return joined.where(F.col("body").isNotNull() & F.col("sentiment").isNotNull())
    keys = classified.select(F.col("subreddit").alias("city"), "date").distinct()
    lonely = w.join(joins.bounded(keys), ["city", "date"], "left_anti")
    lonely = lonely.select(*[F.col(x) if x in w.columns else F.lit(None).cast("string").alias(x)
                             for x in ROW_COLUMNS])
    return joined.unionByName(lonely)


def city_day_counts(classified: DataFrame) -> DataFrame:
    """(city, date, class) -> comments."""
    return (classified.groupBy(F.col("subreddit").alias("city"), "date", "sentiment")
            .agg(F.count(F.lit(1)).alias("n_comments")))


def city_day_base(weather: DataFrame, classified: DataFrame) -> DataFrame:
    """Counts of the row-level inner join, at grain (label, class, city, TAVG, day).

    ``count`` equals the number of joined rows (station day x comment)
    with that key, so every count the row-level join would give (per
    label, class, day, city or temperature) is a sum of this column.  The
    comment side is pre-counted per (city, date, class) and broadcast; the
    weather rows with a temperature stream past it.
    """
    w = weather.where(F.col("TAVG").isNotNull()).select(
        "city", "date", "year", "month", "day", "TAVG", "T_label")
    joined = w.join(joins.bounded(city_day_counts(classified)), ["city", "date"])
    return (joined.groupBy("T_label", "sentiment", F.col("city").alias("subreddit"), "TAVG",
                           "date", "year", "month", "day")
            .agg(F.sum("n_comments").alias("count")))


def label_daily_counts(base: DataFrame) -> DataFrame:
    """(label, class, day) -> joined rows: daily samples per class within a label."""
    return base.groupBy("T_label", "sentiment", *DAY).agg(F.sum("count").alias("count"))


def class_daily_counts(base: DataFrame) -> DataFrame:
    """(class, day) -> joined rows, all labels together."""
    return base.groupBy("sentiment", *DAY).agg(F.sum("count").alias("count"))


def label_class_totals(base: DataFrame) -> DataFrame:
    return base.groupBy("T_label", "sentiment").agg(F.sum("count").alias("count"))


def temp_class_counts(base: DataFrame) -> DataFrame:
    """(label, class, community, TAVG) -> joined rows (regression points)."""
    return base.groupBy("T_label", "sentiment", "subreddit", "TAVG").agg(F.sum("count").alias("count"))
