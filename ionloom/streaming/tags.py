"""Spectral counts kept up to date from a stream of tag files; reference pipelines re-run whole samples instead."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

EVIDENCE = "file string, acc string, sample string, scan string"


def follow_evidence(spark: SparkSession, source: str, target: str, checkpoint: str) -> StreamingQuery:
    """Append arriving evidence files (JSON lines) to ``target``, partitioned by file, so that a file that comes again
    replaces itself: a repeated batch after a failure changes nothing."""

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file").parquet(target)

    stream = spark.readStream.schema(EVIDENCE).json(source)
    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, window: str = "1 hour", lateness: str = "2 hours") -> DataFrame:
    """Events by window and type of a stream (or table) with ``ts`` and ``event_type``; late rows beyond the watermark go."""
    at = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lateness)
    return at.groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
