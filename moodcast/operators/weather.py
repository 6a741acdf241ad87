"""Readings (long) -> daily weather (wide), one row per station and day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import ELEMENTS, HOT_THRESHOLD, MISSING_SENTINEL, TENTHS
from ..functions import date_parts, reading_date, slug_of, temperature_label
from . import joins


def with_reading_dates(readings: DataFrame) -> DataFrame:
    """Replace the yyyyMMdd int with a date and add year, month, day."""
    d = reading_date("date")
    return readings.withColumn("date", d).select("*", *date_parts("date"))


def stored_filter(readings: DataFrame, elements: Sequence[str], sentinel: float) -> list[Column]:
    """The filter on readings as predicates on the columns that they are
    derived from, which a scan can use where it cannot see through the
    derivation.

    A derived column says so in its metadata, under ``stored``: an element
    lists the ``values`` of its ``column`` that stand for it, and a measured
    value is the ``sentinel`` exactly where its ``column`` is ``above`` a
    limit.  The predicates are implied by the filter, and added to it.
    """
    out = []
    by = {f.name: f.metadata.get("stored", {}) for f in readings.schema}
    element, value = by.get("element", {}), by.get("data_value", {})
    if value and value["sentinel"] == sentinel:
        stored = F.col(value["column"])
        out += [stored != F.lit(sentinel), stored <= F.lit(value["above"])]
    if element:
        known = element["values"]
        out.append(F.col(element["column"]).isin([v for e in elements for v in known.get(e, [e])]))
    return out


def filter_readings(readings: DataFrame, elements: Sequence[str] = ELEMENTS,
                    sentinel: float = MISSING_SENTINEL) -> DataFrame:
    """Keep the listed elements and drop the sentinel.

    ``data_value != sentinel`` is NULL for a NULL value, so NULL readings
    go too.  Quality flags are not looked at.  Both predicates reach the
    Parquet scan as pushed filters when the input is a plain scan, or a
    projection of one whose derived columns name what is stored.
    """
    kept = readings.where(F.col("element").isin(list(elements))
                          & (F.col("data_value") != F.lit(sentinel)))
    for predicate in stored_filter(readings, elements, sentinel):
        kept = kept.where(predicate)
    return kept


def attach_city(readings: DataFrame, lookup: DataFrame, how: str = "left") -> DataFrame:
    """Station -> city lookup join; the lookup is counted, then broadcast."""
    return readings.join(joins.bounded(lookup.select("station_id", "city")), "station_id", how)


def widen(readings: DataFrame, elements: Sequence[str] = ELEMENTS,
          keys: Sequence[str] = ("station_id", "city", "date")) -> DataFrame:
    """Pivot elements to columns, summing duplicates (missing -> NULL).

    Conditional sums give the same rows as ``pivot(...).sum`` with one
    partial/final aggregate and a single exchange (the pivot operator
    stacks two).
    """
    sums = [F.sum(F.when(F.col("element") == e, F.col("data_value"))).alias(e) for e in elements]
    return readings.groupBy(*keys).agg(*sums)


def finish_weather(wide: DataFrame, hot_threshold: float = HOT_THRESHOLD) -> DataFrame:
    """TMAX/TMIN from tenths to units, TAVG, hot/cold label, date parts."""
    tmax = F.col("TMAX") / TENTHS
    tmin = F.col("TMIN") / TENTHS
    tavg = (tmax + tmin) / 2
    return wide.select(
        "station_id", "date", *date_parts("date"), "city",
        "PRCP", "SNOW", "SNWD",
        tmax.alias("TMAX"), tmin.alias("TMIN"), tavg.alias("TAVG"),
        temperature_label(tavg, hot_threshold).alias("T_label"),
    )


def weather_table(readings: DataFrame, lookup: DataFrame,
                  hot_threshold: float = HOT_THRESHOLD,
                  elements: Sequence[str] = ELEMENTS) -> DataFrame:
    """Raw readings -> canonical daily weather.

    The station filter and the city lookup are one inner broadcast join
    (a station outside the lookup is dropped, as with a station list
    filter followed by a left lookup join), placed before the aggregate
    so that unknown stations never reach the shuffle.
    """
    r = filter_readings(readings, elements).withColumn("date", reading_date("date"))
    r = attach_city(r.select("station_id", "date", "element", "data_value"), lookup, "inner")
    return finish_weather(widen(r, elements), hot_threshold)


def with_slug(df: DataFrame, city: str = "city") -> DataFrame:
    return df.withColumn("slug", slug_of(city))
