"""Comment ingest as a stream: new JSON files -> cleaned, classified rows
-> city-partitioned Parquet.

The operators of the batch path (community filter, tombstones, dates,
lexicon class), applied to each micro-batch of a file stream.  No state
is kept between batches.  A batch is written to a folder of its own, and
written over when it is retried, so a restarted query neither loses nor
repeats a file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..functions import slug_of
from ..operators import comments, sentiment

OUTPUT_COLUMNS = ["comment_id", "subreddit", "date", "year", "month", "day", "sentiment"]


def read_stream(spark: SparkSession, source: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schemas.RAW_COMMENTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(source)


def classify_batch(raw: DataFrame, lexicon: DataFrame, mode: str = "bag") -> DataFrame:
    scored = sentiment.classify(comments.clean_comments(raw), lexicon, mode=mode)
    return scored.select(*OUTPUT_COLUMNS).withColumn("slug", slug_of("subreddit"))


def write_classified(raw: DataFrame, lexicon: DataFrame, path: str, checkpoint: str, mode: str = "bag",
                     available_now: bool = True) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int) -> None:
        classify_batch(batch, lexicon, mode).write.mode("overwrite").partitionBy("slug").parquet(
            f"{path}/batch={batch_id}")

    writer = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def run_ingest(spark: SparkSession, source: str, lexicon: DataFrame, sink: str, checkpoint: str,
               mode: str = "bag") -> DataFrame:
    """Process every file now in ``source`` and return the sink as a batch frame."""
    q = write_classified(read_stream(spark, source), lexicon, sink, checkpoint, mode)
    q.awaitTermination()
    return spark.read.parquet(sink).select(*OUTPUT_COLUMNS, F.col("slug"))
