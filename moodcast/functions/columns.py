"""Scalar column expressions.  All are built-in Spark functions, so they
stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    COLD,
    HOT,
    HOT_THRESHOLD,
    NEGATIVE,
    NEGATIVE_AT,
    NEUTRAL,
    OUT_DECIMALS,
    POSITIVE,
    POSITIVE_AT,
    SLUG_EXCEPTIONS,
)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def reading_date(yyyymmdd: Column | str) -> Column:
    """int yyyyMMdd -> date; an impossible date gives NULL instead of
    failing the job under ANSI mode."""
    return F.call_function("try_to_date", _c(yyyymmdd).cast("string"), F.lit("yyyyMMdd"))


def comment_date(epoch_seconds: Column | str) -> Column:
    """Epoch seconds held as a string -> date in the session time zone (UTC).

    ``try_cast`` turns a malformed value into NULL instead of failing the
    job under ANSI mode.
    """
    secs = F.expr(f"try_cast({epoch_seconds} AS BIGINT)") if isinstance(epoch_seconds, str) \
        else epoch_seconds.try_cast("bigint")
    return F.to_date(F.timestamp_seconds(secs))


def date_parts(date: Column | str) -> list[Column]:
    d = _c(date)
    return [F.year(d).alias("year"), F.month(d).alias("month"), F.dayofmonth(d).alias("day")]


def temperature_label(tavg: Column | str, threshold: float = HOT_THRESHOLD) -> Column:
    """Strictly above the threshold is hot; everything else, NULL included, is cold."""
    return F.when(_c(tavg) > F.lit(threshold), F.lit(HOT)).otherwise(F.lit(COLD))


def flag(value: Column | str, threshold: float) -> Column:
    """Strictly above the threshold; NULL compares false."""
    return F.coalesce(_c(value) > F.lit(threshold), F.lit(False))


def class_of_compound(compound: Column | str) -> Column:
    c = _c(compound)
    return (F.when(c >= F.lit(POSITIVE_AT), F.lit(POSITIVE))
            .when(c > F.lit(NEGATIVE_AT), F.lit(NEUTRAL))
            .otherwise(F.lit(NEGATIVE)))


def tokens(text: Column | str) -> Column:
    """Lower-case words: split on every run of non-letters."""
    return F.split(F.lower(_c(text)), r"[^\p{L}]+")


def slug_of(city: Column | str) -> Column:
    c = _c(city)
    expr = None
    for name, slug in SLUG_EXCEPTIONS.items():
        expr = (F.when if expr is None else expr.when)(c == name, F.lit(slug))
    return expr.otherwise(F.lower(c))


def rounded(col: Column | str, decimals: int = OUT_DECIMALS) -> Column:
    return F.round(_c(col).cast("double"), decimals)
