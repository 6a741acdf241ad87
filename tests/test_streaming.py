"""The comment ingest as a file stream: same rows as the batch path, and a
restart on the same checkpoint neither loses nor repeats a file."""

from pyspark.sql import functions as F

from moodcast.plans.workspace import workspace
from moodcast.session import scratch_path
from moodcast.sources import files
from moodcast.streaming import run_ingest

from conftest import SF0001


def test_stream_matches_batch_and_restarts_cleanly(spark):
    ws = workspace(spark, SF0001)
    src = files.write_json_gzip(ws.raw_comments, scratch_path(spark, "t-stream-src"))
    sink, ckpt = scratch_path(spark, "t-stream-sink"), scratch_path(spark, "t-stream-ckpt")
    first = run_ingest(spark, src, ws.lexicon, sink, ckpt)
    batch = ws.classified.select("comment_id", "sentiment")
    assert first.count() == batch.count()
    assert first.select("comment_id", "sentiment").exceptAll(batch).count() == 0
    again = run_ingest(spark, src, ws.lexicon, sink, ckpt)
    assert again.count() == first.count()
    assert again.groupBy("comment_id").count().where(F.col("count") > 1).count() == 0
