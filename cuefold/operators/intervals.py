"""Joins of time intervals. Equal keys and time slots make them equi-joins, so that no join compares all with all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .islands import BLOCK_MS
from .ordered import carry_forward


def _slots(df: DataFrame, start: str, end: str, width: int, into: str) -> DataFrame:
    first, last = F.floor(F.col(start) / width), F.floor(F.greatest(F.col(end), F.col(start)) / width)
    return df.withColumn(into, F.explode(F.sequence(first, last)))


def overlap_join(left: DataFrame, right: DataFrame, keys: Sequence[str], a: tuple[str, str], b: tuple[str, str], slot_ms: int = 10_000, closed: bool = False) -> DataFrame:
    """Pairs of one key whose intervals overlap, each once, with ``overlap_ms``.

    The bounds are strict on both sides, so touching intervals don't overlap and an empty one only inside another;
    ``closed`` takes touching as overlap. Null keys and bounds match nothing. ``left`` and ``right`` share the key columns
    and nothing else. A pair is found in the slot where the later of both starts, so no deduplication follows; a hot key
    is spread over its slots.
    """
    x = _slots(left.filter(F.col(a[0]).isNotNull() & F.col(a[1]).isNotNull()), *a, slot_ms, "_slot")
    y = _slots(right.filter(F.col(b[0]).isNotNull() & F.col(b[1]).isNotNull()), *b, slot_ms, "_slot")
    joined = x.join(y, [*keys, "_slot"])
    meets = (F.col(a[0]) <= F.col(b[1])) & (F.col(a[1]) >= F.col(b[0])) if closed else (F.col(a[0]) < F.col(b[1])) & (F.col(a[1]) > F.col(b[0]))
    once = F.col("_slot") == F.floor(F.greatest(F.col(a[0]), F.col(b[0])) / slot_ms)
    return joined.filter(meets & once).withColumn("overlap_ms", overlap_ms(F.col(a[0]), F.col(a[1]), F.col(b[0]), F.col(b[1]))).drop("_slot")


def overlap_ms(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Length of the common part, 0 if there is none."""
    return F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))


def best_overlap(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: Sequence[str], a: tuple[str, str], b: tuple[str, str], first: Sequence[str], slot_ms: int = 10_000) -> DataFrame:
    """Each left row with the right row of the longest overlap; of equal ones the first by ``first``. Rows without one are left out."""
    pairs = overlap_join(left, right, keys, a, b, slot_ms).filter("overlap_ms > 0")
    every = F.struct(*pairs.columns)
    picked = pairs.groupBy(*keys, *left_id).agg(F.min_by(every, F.struct(-F.col("overlap_ms"), *first)).alias("_r"))
    return picked.select("_r.*")


def nearest(left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: Sequence[str], a: tuple[str, str], b: tuple[str, str], right_id: Sequence[str], slot_ms: int = 10_000, partial: int = 64) -> DataFrame:
    """Each left row of which no right row overlaps, with the right row at the least distance between the intervals.

    Ties go to the first by ``right_id``. The nearest lie among the last right row to end before and the first to start
    after, so two ordered passes find them. Rows of a key without right rows are left out.
    """
    met = overlap_join(left, right.select(*keys, *b), keys, a, b, slot_ms).select(*keys, *left_id).distinct()
    alone = left.join(met, [*keys, *left_id], "left_anti").filter(F.col(a[0]).isNotNull() & F.col(a[1]).isNotNull())
    good = right.filter(F.col(b[0]).isNotNull() & F.col(b[1]).isNotNull())
    ends = good.groupBy(*keys, F.col(b[1]).alias("_at")).agg(F.min(F.struct(*right_id)).alias("_id"))
    starts = good.groupBy(*keys, F.col(b[0]).alias("_at")).agg(F.min(F.struct(*right_id)).alias("_id"))
    points = alone.select(*keys, *left_id, *a)

    def side(events: DataFrame, at: str, sign: int) -> DataFrame:
        # sign -1 turns time around: what follows comes first
        both = events.select(*keys, (F.col("_at") * sign).alias("_at"), F.lit(0).alias("_kind"), "_id", F.lit(None).alias("_left")).unionByName(
            points.select(*keys, (F.col(at) * sign).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).alias("_id"), F.struct(*left_id, *a).alias("_left"))
        )
        both = both.withColumn("_block", F.floor(F.col("_at") / BLOCK_MS)).withColumn("_event", F.when(F.col("_kind") == 0, F.struct("_at", "_id")))
        near = carry_forward(both, keys, "_block", ["_at", "_kind", "_left"], "_event", "_near").filter("_kind = 1 AND _near IS NOT NULL")
        return near.select(*keys, "_left.*", (F.col("_at") - F.col("_near._at")).alias("distance_ms"), F.col("_near._id").alias("_id"))

    either = side(ends, a[0], 1).unionByName(side(starts, a[1], -1))
    best = either.groupBy(*keys, *left_id).agg(F.min(F.struct("distance_ms", "_id")).alias("_b"))
    return best.select(*keys, *left_id, "_b.distance_ms", *[F.col(f"_b._id.{c}").alias(c) for c in right_id])


def point_in_interval(points: DataFrame, spans: DataFrame, keys: Sequence[str], at: str, span: tuple[str, str], slot_ms: int = 10_000) -> DataFrame:
    """Pairs of one key with ``span[0] <= at < span[1]``; null points and bounds match nothing."""
    x = points.withColumn("_slot", F.floor(F.col(at) / slot_ms))
    y = _slots(spans.filter(F.col(span[0]) < F.col(span[1])), *span, slot_ms, "_slot")
    return x.join(y, [*keys, "_slot"]).filter((F.col(at) >= F.col(span[0])) & (F.col(at) < F.col(span[1]))).drop("_slot")
