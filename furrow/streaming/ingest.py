"""Scenes that arrive date by date: running per-pixel figures and windowed counts as Structured Streaming plans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

PIXEL_TABLE = "r long, c long, doy int, value double"


def scene_stream(spark: SparkSession, folder: str, schema: str = PIXEL_TABLE, files_each: int = 1) -> DataFrame:
    """A stream of Parquet scenes, files_each a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_each).parquet(folder)


def running_pixels(stream: DataFrame) -> DataFrame:
    """Per pixel: dates so far, mean, greatest, least. State is one row a pixel, kept by Spark's state store."""
    return stream.where("value IS NOT NULL").groupBy("r", "c").agg(F.count("*").alias("dates"), F.avg("value").alias("mean"), F.max("value").alias("most"), F.min("value").alias("least"))


def windowed(stream: DataFrame, time: str = "ts", length: str = "1 day", late: str = "2 days", key: str = "event_type", value: str = "value") -> DataFrame:
    """Counts and sums a window and key; what comes later than `late` is left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, length).alias("w"), key).agg(F.count("*").alias("n"), F.sum(value).alias("total"))


def upsert_pixels(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Write the running pixels after each batch as a new version folder; reruns of a batch overwrite their own version only."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{target}/version={batch}")

    return running_pixels(stream).writeStream.outputMode("complete").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()


def drain(df: DataFrame, name: str, mode: str = "complete") -> DataFrame:
    """All there is in a stream now, as a table in memory: for tests and small sources."""
    query = df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return df.sparkSession.table(name)


def on_each(stream: DataFrame, f: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run a batch function on every micro-batch that there is now."""
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(f).start()
