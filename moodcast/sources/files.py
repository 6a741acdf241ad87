"""File scans with declared schemas, partition-pruned reads and sinks.

Text formats are read with an explicit schema (no inference pass).  Sinks
write one job for all keys with ``partitionBy`` instead of one filtered
write per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, paths: str | Sequence[str], schema: StructType) -> DataFrame:
    """Headerless CSV (gzip or plain) with a positional schema."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).option("header", "false").csv(paths)


def read_json(spark: SparkSession, paths: str | Sequence[str], schema: StructType) -> DataFrame:
    """JSON lines (gzip or plain); fields are matched by name."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.schema(schema).json(paths)


def read_partitioned(spark: SparkSession, root: str, fmt: str = "parquet",
                     schema: StructType | None = None) -> DataFrame:
    """A partitioned folder; filters on partition columns prune folders."""
    reader = spark.read.option("basePath", root)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.format(fmt).load(root)


def read_years(spark: SparkSession, root: str, first: int, last: int,
               fmt: str = "json", schema: StructType | None = None) -> DataFrame:
    """Year range of a ``year=YYYY/...`` layout, selected by partition pruning."""
    df = read_partitioned(spark, root, fmt, schema)
    return df.where(F.col("year").between(first, last))


def read_city(spark: SparkSession, root: str, city: str, column: str = "city") -> DataFrame:
    """One city of a table written with ``partitionBy(column)``."""
    return read_partitioned(spark, root).where(F.col(column) == city)


def write_json_gzip(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("compression", "gzip").json(path)
    return path


def write_csv_gzip(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("compression", "gzip").option("header", "false").csv(path)
    return path


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], fmt: str = "parquet",
                      compression: str | None = None) -> str:
    """One job for every key value.

    The ``rebalance`` hint clusters rows by the partition columns so each
    task writes few folders, and lets adaptive execution split a key that
    holds a large share of the rows across several tasks (and merge small
    ones), so a hot city does not end up in a single writer.
    """
    writer = df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by)
    if compression:
        writer = writer.option("compression", compression)
    writer.format(fmt).save(path)
    return path
