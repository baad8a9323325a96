"""Gaps and islands over ordered rows: pauses, runs, merged windows. Blocks of time keep hot keys from one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import previous, running_sum

BLOCK_MS = 600_000


def gaps(df: DataFrame, keys: Sequence[str], start: str, end: str, order: Sequence[str], least_ms: int = 0) -> DataFrame:
    """``keys, gap_start, gap_end, gap_ms, mid2`` between each row's start and the end of the row before it in ``order``.

    Only gaps of ``least_ms`` or more; with 0 an overlap of rows gives none. ``mid2`` is twice the midpoint, as a whole
    number. ``order`` starts with ``start``. Rows with a null bound are left out.
    """
    rows = df.filter(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn("_block", F.floor(F.col(start) / BLOCK_MS))
    seen = previous(rows, keys, "_block", order, end, "gap_start")
    return seen.filter(F.col(start) - F.col("gap_start") >= least_ms).select(*keys, "gap_start", F.col(start).alias("gap_end"), (F.col(start) - F.col("gap_start")).alias("gap_ms"), (F.col(start) + F.col("gap_start")).alias("mid2"))


def sessions(df: DataFrame, keys: Sequence[str], start: str, end: str, order: Sequence[str], pause_ms: int, strict: bool = False) -> DataFrame:
    """``df`` with ``session``, from 1 per key: a new one begins where the pause since the row before is long enough.

    Long enough is ``pause_ms`` or more, or more than it if ``strict``. Rows with a null bound or without duration are
    dropped first.
    """
    rows = df.filter(F.col(start) < F.col(end)).withColumn("_block", F.floor(F.col(start) / BLOCK_MS))
    seen = previous(rows, keys, "_block", order, end, "_before")
    pause = F.col(start) - F.col("_before")
    new = F.when(F.col("_before").isNull() | ((pause > pause_ms) if strict else (pause >= pause_ms)), 1).otherwise(0)
    return running_sum(seen.withColumn("_new", new), keys, "_block", order, "_new", "session").drop("_block", "_before", "_new")


def whole_sessions(df: DataFrame, keys: Sequence[str], start: str, end: str, order: Sequence[str], pause_ms: int, strict: bool = False, block_ms: int = BLOCK_MS) -> DataFrame:
    """``df`` with ``block``: parts of a key that hold whole sessions, each of those that begin within ``block_ms``."""
    from pyspark.sql import Window

    own = sessions(df, keys, start, end, order, pause_ms, strict)
    return own.withColumn("block", F.floor(F.min(start).over(Window.partitionBy(*keys, "session")) / block_ms)).drop("session")


def runs(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], value: str) -> DataFrame:
    """``df`` with ``run``, from 1 per key: a new one begins where ``value`` (not null) changes."""
    seen = previous(df, keys, block, order, value, "_before").withColumn("_new", F.when(F.col("_before") == F.col(value), 0).otherwise(1))
    return running_sum(seen, keys, block, order, "_new", "run").drop("_before", "_new")


def longest_run(df: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """``keys, longest_run``: the most whole numbers in a row among the distinct values of ``number``."""
    from pyspark.sql import Window

    one = df.select(*keys, F.col(number).cast("long").alias("_n")).dropna().distinct()
    group = F.col("_n") - F.row_number().over(Window.partitionBy(*keys).orderBy("_n"))
    return one.withColumn("_g", group).groupBy(*keys, "_g").agg(F.count(F.lit(1)).alias("_c")).groupBy(*keys).agg(F.max("_c").alias("longest_run"))
