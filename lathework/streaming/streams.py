"""Streams: an idempotent ledger over micro-batches, and event-time windows (an extension)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def collect_once(stream: DataFrame, keys: list[str], path: str, checkpoint: str) -> StreamingQuery:
    """Appends rows whose keys the ledger at ``path`` does not hold yet; a batch that is repeated adds nothing."""

    def merge(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = batch.dropDuplicates(keys)
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        if jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath):
            fresh = fresh.join(spark.read.parquet(path).select(keys), keys, "left_anti")
        fresh.write.mode("append").parquet(path)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, size: str = "1 hour", late: str | None = None) -> DataFrame:
    """Counts and sums by tumbling window and type, of a batch or, with a watermark, of a stream."""
    source = events.withWatermark("ts", late) if late else events
    w = F.window("ts", size)
    return source.groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    source = events.withWatermark("ts", late) if late else events
    return source.groupBy(F.session_window("ts", gap).alias("s"), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("s.start").alias("start"), "n")
