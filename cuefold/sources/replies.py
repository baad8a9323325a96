"""Replies of language models: JSON found in free text, checked and put back to the cues they answer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bare_json(reply: Column) -> Column:
    """A reply without code fences, as text; if that is no JSON, what lies from its first to its last brace."""
    t = F.trim(F.regexp_replace(F.coalesce(reply, F.lit("")), r"^\s+|\s+$", ""))
    t = F.when(t.startswith("```"), F.regexp_replace(F.regexp_replace(t, r"^```[a-zA-Z0-9_-]*\s*", ""), r"\s*```$", "")).otherwise(t)
    inner = F.regexp_extract(t, r"(?s)(\{.*\})", 1)
    return F.when(F.try_parse_json(t).isNotNull(), t).when(F.try_parse_json(inner).isNotNull() & (F.length(inner) > 0), inner)


def answers(df: DataFrame, keys: Sequence[str], reply: str) -> DataFrame:
    """``keys, pos, id, text`` of the list ``translations`` in replies.

    An id may be a number or text; one that is missing or no whole number is the item's place, from 1. A missing text is ''.
    Replies without such a list give no rows.
    """
    items = F.from_json(F.get_json_object(bare_json(F.col(reply)), "$.translations"), "array<struct<id:string,text:string>>")
    rows = df.select(*keys, F.posexplode(items).alias("pos", "r"))
    number = F.expr("try_cast(r.id AS double)")
    own = F.when(number == F.floor(number), number.cast("long")).otherwise((F.col("pos") + 1).cast("long"))
    return rows.select(*keys, "pos", own.alias("id"), F.coalesce("r.text", F.lit("")).alias("text"))


def put_back(cues: DataFrame, replies: DataFrame, keys: Sequence[str], number: str, text: str) -> DataFrame:
    """``cues`` with ``answer`` and ``fallback``: the first answer of each cue's number, else the cue's own text.

    Answers to numbers that no cue has are ignored; an empty answer counts as none.
    """
    first = replies.groupBy(*keys, F.col("id").alias(number)).agg(F.min_by("text", "pos").alias("_a"))
    joined = cues.join(first, [*keys, number], "left")
    good = F.length(F.trim(F.coalesce("_a", F.lit("")))) > 0
    return joined.withColumn("answer", F.when(good, F.col("_a")).otherwise(F.col(text))).withColumn("fallback", ~good).drop("_a")
