"""Scans and sinks on a small literal fixture (two years, three cities)."""

from pyspark.sql import functions as F

from moodcast import schemas
from moodcast.session import scratch_path
from moodcast.sources import files


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_year_range_prunes_partitions(spark):
    rows = [(i, "nyc", str(1420070400 + i * 86400 * 200), f"text {i}", 2015 + i % 2, 1 + i % 3) for i in range(12)]
    df = spark.createDataFrame(rows, "comment_id long, subreddit string, created_utc string, body string, "
                                     "year int, month int")
    path = files.write_partitioned(df, scratch_path(spark, "t-years"), ["year", "month"], fmt="json",
                                   compression="gzip")
    got = files.read_years(spark, path, 2016, 2016, fmt="json", schema=schemas.RAW_COMMENTS)
    assert sorted(r.comment_id for r in got.collect()) == [i for i in range(12) if i % 2 == 1]
    assert "PartitionFilters: [isnotnull(year" in _plan(got)
    assert set(got.columns) == {"comment_id", "subreddit", "created_utc", "body", "year", "month"}


def test_city_partition_read(spark):
    df = spark.createDataFrame([("a", "nyc", 1.0), ("b", "Seattle", 2.0), ("c", "nyc", 3.0)],
                               "station_id string, city string, v double")
    path = files.write_partitioned(df, scratch_path(spark, "t-cities"), ["city"])
    got = files.read_city(spark, path, "nyc")
    assert sorted(r.station_id for r in got.collect()) == ["a", "c"]
    assert "PartitionFilters" in _plan(got) and "nyc" in _plan(got)


def test_csv_and_json_scans_apply_the_declared_schema(spark):
    rows = [("S1", 20240101, "PRCP", 4.5, None, None, None, 700), ("S2", 20240102, "TMAX", 9999.0, "x", None, None, None)]
    df = spark.createDataFrame(rows, schemas.READINGS)
    csv = files.write_csv_gzip(df, scratch_path(spark, "t-csv"))
    back = files.read_csv(spark, [csv], schemas.READINGS)
    assert back.schema == schemas.READINGS
    assert sorted(tuple(r) for r in back.collect()) == sorted(rows)
    js = files.write_json_gzip(df.withColumn("extra", F.lit(1)), scratch_path(spark, "t-json"))
    jback = files.read_json(spark, [js], schemas.READINGS)
    assert jback.columns == [f.name for f in schemas.READINGS.fields]
    assert jback.count() == 2
