"""Comment records -> dated, cleaned comments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import COMMUNITIES, TOMBSTONES
from ..functions import comment_date, date_parts


def select_communities(raw: DataFrame, communities: Sequence[str] = COMMUNITIES,
                       columns: Sequence[str] = ("comment_id", "subreddit", "created_utc", "body")
                       ) -> DataFrame:
    """Project the needed fields and keep the listed communities (case-sensitive)."""
    return raw.select(*columns).where(F.col("subreddit").isin(list(communities)))


def drop_tombstones(df: DataFrame, body: str = "body") -> DataFrame:
    """Drop removed comments; ``body != x`` is NULL for a NULL body, so those go too."""
    cond = None
    for t in TOMBSTONES:
        c = F.col(body) != F.lit(t)
        cond = c if cond is None else cond & c
    return df.where(cond)


def with_comment_dates(df: DataFrame, epoch: str = "created_utc") -> DataFrame:
    d = comment_date(epoch)
    return df.withColumn("date", d).select("*", *date_parts("date"))


def clean_comments(raw: DataFrame) -> DataFrame:
    """comment_id, subreddit, date, year, month, day, body."""
    df = drop_tombstones(select_communities(raw))
    return with_comment_dates(df).select("comment_id", "subreddit", "date", "year", "month", "day", "body")
