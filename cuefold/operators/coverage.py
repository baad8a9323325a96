"""Covered periods and gaps of interval sets, by a sweep over boundary events in two levels of prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Milliseconds a sweep block spans. A block holds at most this many distinct instants, whatever the skew.
BLOCK_MS = 600_000


def sweep(df: DataFrame, keys: Sequence[str], start_ms: str, end_ms: str, block_ms: int = BLOCK_MS) -> DataFrame:
    """Continuous periods and the gaps between them, per ``keys``.

    Returns ``keys, kind ('period' or 'gap'), start_ms, end_ms``. Rows with a null bound or ``end <= start`` don't count;
    touching intervals are continuous; null keys form a group of their own; repeated rows change nothing; an empty
    input gives an empty result. Other columns of ``df`` are ignored, also those named like the result's.

    Events are summed per instant before they are moved, so a key that holds most rows costs no more than its distinct
    instants, and each window sees one block of ``block_ms``; only block totals are ordered per whole key.
    """
    keyed = df.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(start_ms).cast("long").alias("_s"),
        F.col(end_ms).cast("long").alias("_e"),
    ).filter("_s < _e")
    ks = [f"_k{i}" for i in range(len(keys))]
    events = keyed.select(
        *ks,
        F.explode(
            F.array(
                F.struct(F.col("_s").alias("at"), F.lit(1).cast("long").alias("d")),
                F.struct(F.col("_e").alias("at"), F.lit(-1).cast("long").alias("d")),
            )
        ).alias("_v"),
    )
    net = (
        events.select(*ks, "_v.at", "_v.d")
        .groupBy(*ks, "at")
        .agg(F.sum("d").alias("d"))
        .filter("d <> 0")
        .withColumn("block", F.floor(F.col("at") / block_ms))
    )
    on_block = [*ks, "block"]
    in_block = Window.partitionBy(*on_block).orderBy("at")
    blocks = Window.partitionBy(*ks).orderBy("block")
    before = (
        net.groupBy(*on_block)
        .agg(F.sum("d").alias("total"))
        .select(*on_block, F.coalesce(F.sum("total").over(blocks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    )
    active = _join(net.withColumn("run", F.sum("d").over(in_block.rowsBetween(Window.unboundedPreceding, 0))), before, on_block)
    bounds = active.select(*on_block, "at", (F.col("run") + F.col("base")).alias("after"), (F.col("run") + F.col("base") - F.col("d")).alias("prior")).filter("after = 0 OR prior = 0")
    first = bounds.groupBy(*on_block).agg(F.min("at").alias("first")).select(*on_block, F.lead("first").over(blocks).alias("beyond"))
    paired = _join(bounds.withColumn("next", F.lead("at").over(in_block)), first, on_block)
    until = F.coalesce("next", "beyond")
    return paired.filter(until.isNotNull()).select(
        *[F.col(f"_k{i}").alias(k) for i, k in enumerate(keys)],
        F.when(F.col("prior") == 0, "period").otherwise("gap").alias("kind"),
        F.col("at").alias("start_ms"),
        until.alias("end_ms"),
    )


def _join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Null-safe inner join on equal names, keeping the left's copies of the keys."""
    other = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    cond = None
    for c in on:
        eq = left[c].eqNullSafe(other[f"_r_{c}"])
        cond = eq if cond is None else cond & eq
    return left.join(other, cond).drop(*[f"_r_{c}" for c in on])
