"""What a reviewer or a later step asks of cues: neighbours, batches with context, times by characters, merged results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.predicates import ENDED, looks_split
from ..functions.text import char_counts
from .ordered import previous, running_sum


def neighbours(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``df`` with structs ``prev`` and ``next`` of the rows' neighbours' ``columns``, null at the ends. ``order`` is unique and numeric."""
    rows = df.withColumn("_own", F.struct(*columns))
    fore = previous(rows, keys, block, order, "_own", "prev")
    turned = fore.withColumn("_turn", -F.col(block)).withColumns({f"_o{i}": -F.col(c) for i, c in enumerate(order)})
    both = previous(turned, keys, "_turn", [f"_o{i}" for i in range(len(order))], "_own", "next")
    return both.drop("_own", "_turn", *[f"_o{i}" for i in range(len(order))])


def boundary_marks(df: DataFrame, start: str, end: str, text: str) -> DataFrame:
    """``df`` (with ``prev`` and ``next`` that hold ``text``) with ``fragment, is_short, is_long``.

    A fragment has two characters, or four and no final mark, or is part of a sentence over a border with ten characters
    on its own side (or, at its end, the next). Short: under 0.8 s, four characters, or a fragment. Long: over 6.5 s or 42 characters.
    """
    flat = lambda c: F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(""))
    t, n = flat(F.col(text)), F.length(flat(F.col(text)))
    chars = char_counts(text)["chars_compact"]
    after = char_counts(F.col(f"next.{text}"))["chars_compact"]
    split_next = looks_split(F.col(text), F.col(f"next.{text}")) & ((n <= 10) | (after <= 10))
    split_prev = looks_split(F.col(f"prev.{text}"), F.col(text)) & (n <= 10)
    fragment = (n > 0) & ((n <= 2) | ((n <= 4) & ~t.rlike(ENDED)) | split_next | split_prev)
    ms = F.col(end) - F.col(start)
    return df.withColumn("fragment", fragment).withColumn("is_short", (ms < 800) | (chars <= 4) | F.col("fragment")).withColumn("is_long", (ms > 6500) | (chars > 42))


def positions(df: DataFrame, keys: Sequence[str], block: str, order: Sequence[str], into: str = "i") -> DataFrame:
    """``df`` with its row's number from 1 per key, counted in blocks."""
    return running_sum(df.withColumn("_one", F.lit(1)), keys, block, order, "_one", into).drop("_one")


def time_at_offset(df: DataFrame, keys: Sequence[str], order: Sequence[str], start: str, end: str, chars: str, offset: Column) -> DataFrame:
    """``keys, at_ms``: the time at which a region of cues has said ``offset`` characters (an expression over the region's ``total``).

    Time runs evenly within a cue; cues without characters are passed over. Regions without characters are left out.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    rows = df.filter(F.col(chars) > 0).withColumn("_to", F.sum(chars).over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("total", F.sum(chars).over(Window.partitionBy(*keys)))
    rows = rows.withColumn("_at", offset)
    hit = rows.filter((F.col("_at") <= F.col("_to")) & ((F.col("_at") > F.col("_to") - F.col(chars)) | ((F.col("_at") <= 0) & (F.col("_to") == F.col(chars)))))
    into = F.floor(F.greatest(F.lit(0), F.col(end) - F.col(start)) * F.greatest(F.lit(0), F.col("_at") - F.col("_to") + F.col(chars)) / F.col(chars))
    return hit.select(*keys, (F.col(start) + into).alias("at_ms"))


def take_done(rows: DataFrame, later: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``rows`` with ``value`` from ``later`` (unique keys) where that holds one, else their own."""
    other = later.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    return rows.join(other, list(keys), "left").withColumn(value, F.coalesce("_v", value)).drop("_v")


def final_texts(rows: DataFrame, answer: str, text: str, partial: bool = False) -> DataFrame:
    """``rows`` with ``text`` replaced by ``answer``; a missing answer keeps the text if ``partial``, else raises an error when read."""
    good = F.length(F.trim(F.coalesce(answer, F.lit("")))) > 0
    return rows.withColumn(text, F.when(good, F.col(answer)).otherwise(F.col(text) if partial else F.raise_error(F.lit("a cue has no answer"))))


def timing_faults(a: DataFrame, b: DataFrame, keys: Sequence[str], order: str, span: tuple[str, str]) -> DataFrame:
    """``keys, order, fault``: rows of two versions that differ in times (``moved``) or stand in one alone (``missing``, ``extra``)."""
    x = a.select(*keys, order, F.struct(*span).alias("_a"))
    y = b.select(*keys, order, F.struct(*span).alias("_b"))
    fault = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "extra").when(F.col("_a") != F.col("_b"), "moved")
    return x.join(y, [*keys, order], "full").select(*keys, order, fault.alias("fault")).filter("fault IS NOT NULL")
