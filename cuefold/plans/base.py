"""The relations that queries start from, and the SQL that states them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table, to_ms


def cues(spark: SparkSession, folder: str, timed: bool = True, together: bool = False) -> DataFrame:
    """``episode_id, track, seq, s, e, text``: each cue once, the delivery loaded last; with ``timed`` only those with both times.

    With ``together`` a track lies in one partition, and that is the only shuffle.
    """
    raw = table(spark, folder, "cues").select("episode_id", "track", "seq", to_ms("start_s").alias("s"), to_ms("end_s").alias("e"), "text", "loaded_at", "cue_id")
    raw = raw.repartition("episode_id", "track") if together else raw
    once = raw.groupBy("episode_id", "track", "seq").agg(F.max_by(F.struct("s", "e", "text"), F.struct("loaded_at", "cue_id")).alias("r")).select("episode_id", "track", "seq", "r.*")
    return once.filter("s IS NOT NULL AND e IS NOT NULL") if timed else once


def segments(spark: SparkSession, folder: str) -> DataFrame:
    """``episode_id, name, s, e, ws, we, text``: each segment once, the delivery loaded last."""
    raw = table(spark, folder, "segments").select(
        "episode_id", "name", to_ms("seg_start").alias("s"), to_ms("seg_end").alias("e"), to_ms("window_start").alias("ws"), (to_ms("window_start") + to_ms("window_dur")).alias("we"), "text", "loaded_at", "seg_id"
    )
    return raw.groupBy("episode_id", "name").agg(F.max_by(F.struct("s", "e", "ws", "we", "text"), F.struct("loaded_at", "seg_id")).alias("r")).select("episode_id", "name", "r.*")


def intervals(spark: SparkSession, folder: str) -> DataFrame:
    """``event_type, event_id, s, e``: events as intervals from their time for ``value`` seconds."""
    ts = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, folder, "events").filter("value IS NOT NULL AND ts IS NOT NULL").select("event_type", "event_id", ts.alias("s"), (ts + F.round(F.col("value") * 1000).cast("long")).alias("e"))


CUES = """
cue AS (
  SELECT episode_id, track, seq, s, e, text FROM (
    SELECT episode_id, track, seq, CAST(round(start_s * 1000) AS BIGINT) AS s, CAST(round(end_s * 1000) AS BIGINT) AS e, text,
      row_number() OVER (PARTITION BY episode_id, track, seq ORDER BY loaded_at DESC, cue_id DESC) AS rn
    FROM cues) WHERE rn = 1),
timed AS (SELECT * FROM cue WHERE s IS NOT NULL AND e IS NOT NULL)"""

SEGMENTS = """
seg AS (
  SELECT episode_id, name, s, e, ws, we, text FROM (
    SELECT episode_id, name, CAST(round(seg_start * 1000) AS BIGINT) AS s, CAST(round(seg_end * 1000) AS BIGINT) AS e,
      CAST(round(window_start * 1000) AS BIGINT) AS ws,
      CAST(round(window_start * 1000) AS BIGINT) + CAST(round(window_dur * 1000) AS BIGINT) AS we, text,
      row_number() OVER (PARTITION BY episode_id, name ORDER BY loaded_at DESC, seg_id DESC) AS rn
    FROM segments) WHERE rn = 1)"""

INTERVALS = """
iv AS (
  SELECT event_type, event_id, epoch_us(ts) // 1000 AS s, epoch_us(ts) // 1000 + CAST(round(value * 1000) AS BIGINT) AS e
  FROM events WHERE value IS NOT NULL AND ts IS NOT NULL)"""
