"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moodcast.session import scratch_path, ship_package

# The white space that separates words.
SPACE_CHARS = " \t\n\x0b\f\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

# Rows of one Arrow batch of texts.  Texts are a few kB on average, and the
# byte limit of the session (spark.sql.execution.arrow.maxBytesPerBatch)
# holds for batches of long ones.
TEXT_ROWS_PER_BATCH = 512
TEXT_BYTES_PER_BATCH = 8 << 20


def prepare(spark: SparkSession) -> None:
    """Ship the package to the workers and bound the Arrow batches of texts."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BYTES_PER_BATCH))


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of up to ``rows`` short rows for what is run inside;
    batches of texts again afterwards."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS_PER_BATCH))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared scratch folder: its lineage is cut,
    and a lost executor costs no recomputation."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_struct(docs: DataFrame) -> Column:
    """All columns as one, out of the way of an operator's own names;
    ``select("x.*")`` on it gives them back unchanged."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def unpacked(docs: DataFrame, row: str, added: dict[str, Column]) -> list[Column]:
    """The columns of ``docs`` out of struct ``row``, then the added ones;
    an added column takes the place of one of the same name."""
    return [*[added.get(c, F.col(f"{row}.`{c}`")).alias(c) for c in docs.columns],
            *[v.alias(c) for c, v in added.items() if c not in docs.columns]]


def row_hash(*cols: Column) -> Column:
    """A second identity of a row beside its key; nulls differ from ''."""
    return F.xxhash64(*[x for c in cols for x in (c.isNull(), c)])


def rekeyed(df: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    """Copies of the keys that Spark does not know to be partitioned already.

    A join on them gets an exchange on both sides, so that adaptive
    execution can split the partitions of a hot key, which it cannot do
    where one side is joined as an aggregate left it.
    """
    for k in keys:
        df = df.withColumn(prefix + k, F.concat(F.col(k), F.lit("")) if dict(df.dtypes)[k] == "string"
                           else F.col(k).bitwiseXOR(F.lit(1)))
    return df


def recounted(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is such a column, follows the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))
