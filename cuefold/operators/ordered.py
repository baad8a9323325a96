"""Running values over ordered rows in two levels: blocks of a key run side by side, block summaries in order.

A window over a whole key puts a key that holds a third of all rows into one task. Here the caller names a ``block``
column that grows with the order (a time slot, say), so that a task sees one block, and only one row a block is ordered
per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .coverage import _join


def carry_forward(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], value: str, into: str) -> DataFrame:
    """``into``: the last ``value`` that isn't null, of the row itself or those before it; null where there is none.

    Ties in ``order`` are taken in no fixed order, so it should be unique. Null keys form a key of their own.
    """
    on, blocks, rows = _windows(keys, block, order)
    own = F.last(value, ignorenulls=True).over(rows.rowsBetween(Window.unboundedPreceding, 0))
    last = df.filter(F.col(value).isNotNull()).groupBy(*on).agg(F.max_by(value, F.struct(*order)).alias("_last"))
    every = df.select(*on).distinct()
    known = every.join(last, [every[c].eqNullSafe(last[c]) for c in on], "left").select(*[every[c] for c in on], "_last")
    prior = known.select(*on, F.last("_last", ignorenulls=True).over(blocks.rowsBetween(Window.unboundedPreceding, -1)).alias("_prior"))
    return _join(df.withColumn(into, own), prior, on).withColumn(into, F.coalesce(into, "_prior")).drop("_prior")


def previous(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], value: str, into: str) -> DataFrame:
    """``into``: ``value`` of the row before, null for a key's first row. ``value`` must not be null."""
    on, blocks, rows = _windows(keys, block, order)
    last = df.groupBy(*on).agg(F.max_by(value, F.struct(*order)).alias("_last"))
    prior = last.select(*on, F.lag("_last").over(blocks).alias("_prior"))
    return _join(df.withColumn(into, F.lag(value).over(rows)), prior, on).withColumn(into, F.coalesce(into, "_prior")).drop("_prior")


def running_sum(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], value: str, into: str) -> DataFrame:
    """``into``: the sum of ``value`` over the row and all before it; null counts as nothing."""
    on, blocks, rows = _windows(keys, block, order)
    base = df.groupBy(*on).agg(F.sum(value).alias("_sum"))
    prior = base.select(*on, F.coalesce(F.sum("_sum").over(blocks.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_prior"))
    own = F.coalesce(F.sum(value).over(rows.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    return _join(df.withColumn(into, own), prior, on).withColumn(into, F.col(into) + F.col("_prior")).drop("_prior")


def _windows(keys, block, order):
    on = [*keys, block]
    return on, Window.partitionBy(*keys).orderBy(block), Window.partitionBy(*on).orderBy(*order)
