"""Lines without times of their own, between timed lines of one chunk: where they stand, and whether they replace speech.

A chunk is a minute or a few of one episode, so windows over a chunk see few rows, however long the episode is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import SCREEN_NARRATION, holds_any


def _around(df: DataFrame, keys: Sequence[str], order: str, lost: str, span: tuple[str, str]) -> DataFrame:
    """Rows that are ``lost``, with ``_k`` of ``_c`` in their run, and the end before and the start after it, null where none is."""
    w = Window.partitionBy(*keys).orderBy(order)
    known = lambda c: F.when(~F.col(lost), F.col(c))
    rows = df.withColumn("_before", F.last(known(span[1]), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_after", F.first(known(span[0]), ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    rows = rows.withColumn("_run", F.sum(F.when(F.col(lost), 0).otherwise(1)).over(w.rowsBetween(Window.unboundedPreceding, 0))).filter(F.col(lost))
    run = Window.partitionBy(*keys, "_run")
    return rows.withColumn("_k", F.row_number().over(run.orderBy(order)) - 1).withColumn("_c", F.count(F.lit(1)).over(run))


def fill_visual(df: DataFrame, keys: Sequence[str], order: str, visual: str, span: tuple[str, str], chunk: tuple[str, str]) -> DataFrame:
    """``keys, order, start_ms, end_ms`` of visual lines: equal slots between the spoken ones before and after.

    With a neighbour on one side alone the run has 0.3 s a line, 0.6 s at least, within the ``chunk``; with none the whole
    chunk. A line has 50 ms at least.
    """
    v = _around(df, keys, order, visual, span)
    reach = F.greatest(F.lit(600), 300 * F.col("_c"))
    left = F.when(F.col("_before").isNotNull(), F.col("_before")).when(F.col("_after").isNotNull(), F.greatest(F.col(chunk[0]), F.col("_after") - reach)).otherwise(F.col(chunk[0]))
    right = F.when(F.col("_after").isNotNull(), F.col("_after")).when(F.col("_before").isNotNull(), F.least(F.col(chunk[1]), F.col("_before") + reach)).otherwise(F.col(chunk[1]))
    v = v.withColumn("_l", left).withColumn("_r", right)
    at = lambda k: F.least(F.col("_r"), F.col("_l") + F.floor(k * F.greatest(F.lit(50), F.col("_r") - F.col("_l")) / F.col("_c")))
    start = F.when(F.col("_k") == 0, F.col("_l")).otherwise(at(F.col("_k")))
    return v.select(*keys, order, start.alias("start_ms"), F.greatest(start + 50, at(F.col("_k") + 1)).alias("end_ms"))


def place_unaligned(df: DataFrame, keys: Sequence[str], order: str, lost: str, span: tuple[str, str], slot_ms: int = 80) -> DataFrame:
    """``df``'s lost rows with ``mode, start_ms, end_ms``: slots of at most ``slot_ms`` in the room between the timed rows around.

    Without room they follow the row before, without one they stand before the row after, without any they start at 0.
    """
    v = _around(df, keys, order, lost, span)
    before, after, k, c = (F.col(x) for x in ("_before", "_after", "_k", "_c"))
    between = F.coalesce(after > before, F.lit(False))
    room = F.least(slot_ms * c, after - before)
    at = lambda n: before + F.floor(n * room / c)
    base = F.when(before.isNotNull(), before).when(after.isNotNull(), F.greatest(F.lit(0), after - slot_ms * c)).otherwise(0)
    mode = F.when(between, "between_neighbors").when(before.isNotNull(), "after_previous").when(after.isNotNull(), "before_next").otherwise("fallback_from_zero")
    placed = v.withColumn("mode", mode).withColumn("start_ms", F.when(between, at(k)).otherwise(base + slot_ms * k)).withColumn("end_ms", F.when(between, F.greatest(at(k) + 1, at(k + 1))).otherwise(base + slot_ms * (k + 1)))
    return placed.drop("_before", "_after", "_run", "_k", "_c")


def visual_runs(df: DataFrame, keys: Sequence[str], order: str, visual: str, text: str, long: int = 14) -> DataFrame:
    """``keys, first_item, lines, long_lines, hinted, suspicious`` of each run of visual lines.

    Suspicious are two lines or more between speech that narrate, or of which two have ``long`` characters.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    speech = F.when(~F.col(visual), 1)
    rows = df.withColumn("_run", F.count(speech).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_all", F.count(speech).over(Window.partitionBy(*keys))).filter(F.col(visual))
    r = rows.groupBy(*keys, "_run").agg(
        F.min(order).alias("first_item"), F.count(F.lit(1)).alias("lines"), F.count(F.when(F.length(text) >= long, 1)).alias("long_lines"), F.bool_or(holds_any(F.col(text), SCREEN_NARRATION)).alias("hinted"), F.max("_all").alias("_all")
    )
    odd = (F.col("lines") >= 2) & (F.col("_run") > 0) & (F.col("_run") < F.col("_all")) & (F.col("hinted") | (F.col("long_lines") >= 2))
    return r.withColumn("suspicious", odd).drop("_run", "_all")
