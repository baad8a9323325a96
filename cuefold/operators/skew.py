"""Equi-joins that stay even when one key holds a third of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets that keys are counted in. Their counts are all that is sent to every task, so what is sent has this size at most.
BUCKETS = 4096


def hot_join(left: DataFrame, right: DataFrame, on: Sequence[str], spread: Sequence[str], how: str = "inner", least: int = 20_000, tasks: int | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``left`` joined with ``right`` on equal columns ``on``; a key with very many left rows is split over tasks.

    Left rows are counted in ``buckets`` buckets of their key's digest. Where a bucket holds over ``least`` rows and over
    four times the mean of all buckets, its left rows are dealt to parts by the digest of ``spread``, and its right rows
    stand in every part. ``how`` is ``inner``, ``left`` or ``left_semi``. Null keys match nothing. The columns are those of
    the left, then the right's others. ``left`` is read twice, so it should be cheap or materialised. ``tasks`` sets the
    number of tasks where rows are few bytes and much work.
    """
    at = lambda: F.pmod(F.xxhash64(*[F.col(c) for c in on]), F.lit(buckets)).cast("int")
    counted = left.groupBy(at().alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    limit = F.greatest(F.lit(least), (4 * F.col("_all") / buckets).cast("long"))
    hot = counted.crossJoin(F.broadcast(counted.agg(F.sum("_n").alias("_all")))).withColumn("_limit", limit).filter("_n > _limit")  # one row meets the buckets
    hot = hot.select("_bucket", F.ceil(F.col("_n") / F.col("_limit")).cast("int").alias("_parts"))
    salted = left.withColumn("_bucket", at()).join(F.broadcast(hot), "_bucket", "left").drop("_bucket")
    salted = salted.withColumn("_part", _part(F.col("_parts"), spread)).drop("_parts")
    every = right.withColumn("_bucket", at()).join(F.broadcast(hot), "_bucket", "left").drop("_bucket")
    every = every.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))).drop("_parts")
    if tasks:
        salted, every = (x.repartition(tasks, *on, "_part") for x in (salted, every))
    return salted.join(every, [*on, "_part"], how).drop("_part")


def _part(parts: Column, spread: Sequence[str]) -> Column:
    digest = F.pmod(F.xxhash64(F.lit(17), *[F.col(c) for c in spread]), F.coalesce(parts, F.lit(1)))
    return digest.cast("int")
