"""Windowed counts, deduplication and upserts over an event stream with a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.relational import latest_each


def source(spark: SparkSession, path: str, schema: StructType, files_a_batch: int = 16) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_batch).parquet(path)


def timed(events: DataFrame, time: str, late: str = "10 minutes") -> DataFrame:
    """Event time as a timestamp with a watermark."""
    return events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)


def tumbling(events: DataFrame, time: str, span: str, keys: list[str], slide: str | None = None) -> DataFrame:
    """Counts and sums by window (sliding with ``slide``) and keys. The same plan serves streams and batches."""
    w = F.window(time, span, slide) if slide else F.window(time, span)
    g = events.groupBy(w.alias("w"), *keys).agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"))
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *keys, "n", "total")


def sessions(events: DataFrame, time: str, gap: str, keys: list[str]) -> DataFrame:
    """Sessions of each key that a gap parts."""
    g = events.groupBy(F.session_window(time, gap).alias("s"), *keys).agg(F.count("*").alias("n"))
    return g.select(F.col("s.start").alias("start"), F.col("s.end").alias("end"), *keys, "n")


def once(events: DataFrame, keys: list[str]) -> DataFrame:
    """Each key once, as far back as the watermark keeps state; in batches each key once."""
    return events.dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)


def run_available(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process all that is there into Parquet files and stop."""
    df.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_upserts(df: DataFrame, checkpoint: str, keys: list[str], order: list[str], sink: Callable[[DataFrame, int], None]) -> None:
    """Hand each micro-batch, reduced to the newest row of each key, to an idempotent sink (it gets the batch number)."""
    df.writeStream.foreachBatch(lambda rows, k: sink(latest_each(rows, keys, order), k)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
