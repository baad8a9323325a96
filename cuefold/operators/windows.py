"""Two transcripts compared in sliding windows: where the second holds much more than the first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import squeeze


def sliding_windows(primary: DataFrame, secondary: DataFrame, keys: Sequence[str], width_ms: int, step_ms: int) -> DataFrame:
    """``keys, start_ms, end_ms, primary_text, secondary_text, primary_chars, secondary_chars`` of every window that meets text.

    primary, secondary: ``keys, s, e, seq, text``. Windows start at every multiple of ``step_ms`` from 0 and end at the
    last end of either side. Texts of the rows that overlap a window are joined by `` / `` in order of ``seq``; blank
    texts don't count. A window no row meets gives no row, as it holds nothing to compare.
    """
    sides = primary.select(*keys, "s", "e", "seq", "text", F.lit(0).alias("side")).unionByName(secondary.select(*keys, "s", "e", "seq", "text", F.lit(1).alias("side")))
    last = sides.groupBy(*keys).agg(F.max("e").alias("last"))
    # window k covers [k*step, k*step + width): the ones a row may meet
    first = F.greatest(F.lit(0), F.floor((F.col("s") - width_ms) / step_ms))
    rows = sides.filter("s IS NOT NULL AND e IS NOT NULL").withColumn("text", F.trim("text")).filter("length(text) > 0").withColumn("k", F.explode(F.sequence(first, F.greatest(first, F.floor(F.col("e") / step_ms)))))
    at, to = F.col("k") * step_ms, F.least(F.col("last"), F.col("k") * step_ms + width_ms)
    met = rows.join(last, list(keys)).withColumn("start_ms", at).withColumn("end_ms", to).filter("start_ms < last AND s < end_ms AND e > start_ms")
    said = lambda side: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("side") == side, F.struct("seq", "text")))), lambda x: x["text"]), " / ")
    out = met.groupBy(*keys, "start_ms", "end_ms").agg(said(0).alias("primary_text"), said(1).alias("secondary_text"))
    return out.withColumn("primary_chars", F.length(squeeze("primary_text"))).withColumn("secondary_chars", F.length(squeeze("secondary_text")))


def flagged(windows: DataFrame, least_secondary: int = 12, most_primary: int = 4, least_extra: int = 12) -> DataFrame:
    """Windows in which the second side has enough text and the first nearly none, or half as much, and ``least_extra`` less."""
    p, s = F.col("primary_chars"), F.col("secondary_chars")
    return windows.filter((s >= least_secondary) & ((p <= most_primary) | (s >= F.greatest(p * 2, p + least_extra))))


def merge_windows(windows: DataFrame, keys: Sequence[str], gap_ms: int) -> DataFrame:
    """Flagged windows at most ``gap_ms`` apart as one: last end, largest counts, the texts of the first window."""
    w = Window.partitionBy(*keys).orderBy("start_ms", "end_ms")
    reach = F.max("end_ms").over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(reach.isNull() | (F.col("start_ms") > reach + gap_ms), 1).otherwise(0)
    grouped = windows.withColumn("_new", new).withColumn("region", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    first = lambda c: F.min_by(c, F.struct("start_ms", "end_ms")).alias(c)
    return grouped.groupBy(*keys, "region").agg(
        F.min("start_ms").alias("start_ms"), F.max("end_ms").alias("end_ms"), first("primary_text"), first("secondary_text"), F.max("primary_chars").alias("primary_chars"), F.max("secondary_chars").alias("secondary_chars"), F.count(F.lit(1)).alias("windows")
    )
