"""Declared schemas: every scan applies one, nothing is inferred."""

from pyspark.sql import types as T

# Long readings, headerless CSV, positional; date is yyyyMMdd as an int.
READINGS = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("date", T.IntegerType()),
    T.StructField("element", T.StringType()),
    T.StructField("data_value", T.DoubleType()),
    T.StructField("m_flag", T.StringType()),
    T.StructField("q_flag", T.StringType()),
    T.StructField("s_flag", T.StringType()),
    T.StructField("obs_time", T.IntegerType()),
])

STATION_LOOKUP = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("city", T.StringType()),
])

# Canonical wide daily weather (one row per station and day).
WEATHER = T.StructType([
    T.StructField("station_id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("city", T.StringType()),
    T.StructField("PRCP", T.DoubleType()),
    T.StructField("SNOW", T.DoubleType()),
    T.StructField("SNWD", T.DoubleType()),
    T.StructField("TMAX", T.DoubleType()),
    T.StructField("TMIN", T.DoubleType()),
    T.StructField("TAVG", T.DoubleType()),
    T.StructField("T_label", T.StringType()),
])

# Raw comments as JSON lines; epoch seconds arrive as a string.
RAW_COMMENTS = T.StructType([
    T.StructField("comment_id", T.LongType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("created_utc", T.StringType()),
    T.StructField("body", T.StringType()),
])

# All fields of a raw comment record, as published.
FULL_COMMENTS = T.StructType([
    T.StructField("archived", T.BooleanType()),
    T.StructField("author", T.StringType()),
    T.StructField("author_flair_css_class", T.StringType()),
    T.StructField("author_flair_text", T.StringType()),
    T.StructField("body", T.StringType()),
    T.StructField("controversiality", T.LongType()),
    T.StructField("created_utc", T.StringType()),
    T.StructField("distinguished", T.StringType()),
    T.StructField("downs", T.LongType()),
    T.StructField("edited", T.StringType()),
    T.StructField("gilded", T.LongType()),
    T.StructField("id", T.StringType()),
    T.StructField("link_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("retrieved_on", T.LongType()),
    T.StructField("score", T.LongType()),
    T.StructField("score_hidden", T.BooleanType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("subreddit_id", T.StringType()),
    T.StructField("ups", T.LongType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
])

CLASSIFIED_COMMENTS = T.StructType([
    T.StructField("comment_id", T.LongType()),
    T.StructField("subreddit", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("day", T.IntegerType()),
    T.StructField("sentiment", T.StringType()),
])

LEXICON = T.StructType([
    T.StructField("token", T.StringType(), False),
    T.StructField("valence", T.DoubleType(), False),
])
