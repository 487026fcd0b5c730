"""The foreachBatch merge adapter driven by a Structured Streaming file source."""

import datetime as dt
import tempfile

from tidemark.sources.merge_table import MergeTable
from tidemark.streaming.incremental import foreach_batch_upsert


def test_stream_of_change_files_merges_into_sink(spark):
    base = tempfile.mkdtemp(prefix="tidemark-stream-")
    sink = MergeTable("streamed_history", ["k"], buckets=4)
    sink.create(spark.createDataFrame([(1, dt.date(2021, 1, 1), "a"), (2, dt.date(2021, 1, 1), "b")],
                                      "k long, s date, v string"))
    schema = "k long, s date, v string"
    spark.createDataFrame([(1, dt.date(2021, 1, 1), "A")], schema).write.parquet(f"{base}/in/batch=1")
    spark.createDataFrame([(3, dt.date(2021, 2, 1), "c")], schema).write.parquet(f"{base}/in/batch=2")
    stream = spark.readStream.schema(schema).parquet(f"{base}/in/*")
    q = (stream.writeStream.foreachBatch(foreach_batch_upsert(sink, ["k", "s"]))
         .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination(120)
    out = {r.k: r.v for r in sink.read(spark).collect()}
    assert out == {1: "A", 2: "b", 3: "c"}
