"""Incremental ingest: files of chunks as they arrive, each chunk once, and sessions over event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def follow(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    """New JSON-lines files of a folder, as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)


def append_once(stream: DataFrame, target: str, keys: Sequence[str], state: str, done: str | None = None) -> StreamingQuery:
    """Append the rows of a stream to a Parquet table, one for each key, also after a restart or a repeated batch.

    A batch writes to a folder of its own number, which a repeated batch replaces. Rows whose keys earlier batches hold
    are left out by an anti-join; ``done`` is a condition that a row must meet to count (a chunk with text and no error),
    others wait for a later delivery.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = batch.filter(done) if done else batch
        new = new.dropDuplicates(list(keys))
        try:
            earlier = spark.read.parquet(target).filter(F.col("batch") < number)
            new = new.join(earlier.select(*keys).distinct(), list(keys), "left_anti")
        except AnalysisException:  # no batch is written yet
            pass
        new.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", state).trigger(availableNow=True).start()


def event_sessions(stream: DataFrame, key: str, at: str, pause: str, late: str) -> DataFrame:
    """Sessions of a key with less than ``pause`` between events; events later than ``late`` behind the newest are dropped.

    The same on a static table, where lateness means nothing. Returns ``key, start, end, events``.
    """
    w = stream.withWatermark(at, late).groupBy(F.session_window(at, pause), key).agg(F.count(F.lit(1)).alias("events"))
    return w.select(key, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "events")


def event_windows(stream: DataFrame, keys: Sequence[str], at: str, width: str, step: str, late: str) -> DataFrame:
    """Counts in sliding windows. Returns ``keys, start, end, events``."""
    w = stream.withWatermark(at, late).groupBy(F.window(at, width, step), *keys).agg(F.count(F.lit(1)).alias("events"))
    return w.select(*keys, F.col("window.start").alias("start"), F.col("window.end").alias("end"), "events")
