"""Documents drawn from sources to target shares of all tokens: hash order, distributed prefix sums, exact cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import running_sum
from ..operators.skew import hot_join
from ..session import cut
from .tokens import DEFAULT_FILE, count_tokens

#: Sources that may be sent to every task; a longer list meets the documents in a join that splits hot sources.
MOST_SOURCES = 100_000


def mix(df: DataFrame, targets: DataFrame, doc_id: str, source: str, text: str, total_tokens: int | None = None, seed: int = 11, block_rows: int = 50_000, file: str = DEFAULT_FILE) -> tuple[DataFrame, DataFrame]:
    """The drawn documents and the report on shares.

    Drawn: ``source, doc_id, epoch, mix_key, n_tokens, used_tokens``, one row for each use of a document. A source's
    documents are used whole, epoch by epoch, in the order of a digest; the one on the budget's edge gives
    ``used_tokens`` up to it, all others all their tokens. Report, a row for each source of ``targets``: ``source,
    target_share, max_repeats, documents, available_tokens, asked_tokens, budget_tokens, drawn_tokens, uses, most_repeats,
    actual_share, shortfall_tokens``.

    targets: ``source, target_share, max_repeats``; of equal sources the greatest share counts. The total is
    ``total_tokens`` or, if that is null or more, the most that all sources with tokens can fill within ``max_repeats``,
    so that shares hold; the shares of those are scaled to 1. What is asked and can't be drawn is each source's shortfall. Documents of other sources, of a null source or without
    tokens aren't drawn; repeated rows are documents of their own; no usable target gives no drawn row. Building the result runs jobs.
    """
    want = targets.select(F.col("source").alias("s"), F.col("target_share").cast("decimal(30,18)").alias("share"), F.col("max_repeats").cast("long").alias("most")).dropna()
    want = want.groupBy("s").agg(F.max(F.struct("share", "most")).alias("r")).select("s", "r.*")
    few = want.limit(MOST_SOURCES + 1).count() <= MOST_SOURCES
    meet = lambda left, right, how="inner": left.join(F.broadcast(right), "s", how) if few else hot_join(left, right, ["s"], ["doc_id"], how)
    texts = meet(df.select(F.col(source).alias("s"), F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("t")).filter("s IS NOT NULL AND length(t) > 0"), want.select("s"), "left_semi")
    docs = cut(count_tokens(texts, ["doc_id", "s"], "t", file).filter("n_tokens > 0"))
    have = docs.groupBy("s").agg(F.count(F.lit(1)).alias("docs"), F.sum("n_tokens").alias("tokens"))
    plan = cut(want.join(have, "s", "left").fillna(0, ["docs", "tokens"]).withColumn("live", F.expr("tokens > 0 AND share > 0 AND most > 0")))
    live = plan.filter("live")
    scale = float(live.agg(F.sum("share").alias("x")).first().x or 1)  # a sum of decimals: the same in any order
    fills = live.agg(F.min((F.col("most") * F.col("tokens") * scale / F.col("share").cast("double")).cast("long")).alias("x")).first().x or 0
    total = fills if total_tokens is None else min(total_tokens, fills)
    asked = total if total_tokens is None else total_tokens
    part = lambda x: F.when(F.col("live"), F.bround(x * F.col("share").cast("double") / scale).cast("long")).otherwise(0)
    per = plan.withColumn("budget", F.least(F.col("most") * F.col("tokens"), part(total))).withColumn("asked", part(asked)).withColumn("share", F.col("share").cast("double"))
    per = per.withColumn("whole", F.when(F.col("tokens") > 0, F.expr("budget DIV tokens")).otherwise(0)).withColumn("rest", F.col("budget") - F.col("whole") * F.col("tokens")).withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("docs") / block_rows)))
    joined = meet(docs, per.select("s", "whole", "rest", "blocks")).filter("whole > 0 OR rest > 0")
    full = joined.select("s", "doc_id", F.explode(F.expr("CASE WHEN whole > 0 THEN sequence(1L, whole) ELSE array() END")).alias("epoch"), "n_tokens")
    full = full.select("s", "doc_id", "epoch", F.xxhash64("doc_id", "epoch", F.lit(seed)).alias("mix_key"), "n_tokens", F.col("n_tokens").alias("used_tokens"))
    last = joined.filter("rest > 0").withColumn("epoch", F.col("whole") + 1).withColumn("mix_key", F.xxhash64("doc_id", "epoch", F.lit(seed)))
    # slots of the digest's range hold about block_rows documents each, and stand in its order
    last = last.withColumn("block", F.floor((F.col("mix_key").cast("double") / F.lit(2.0**64) + 0.5) * F.col("blocks")))
    summed = running_sum(last, ["s"], "block", ["mix_key", "doc_id"], "n_tokens", "reach")
    cutoff = summed.filter("reach - n_tokens < rest").select("s", "doc_id", "epoch", "mix_key", "n_tokens", F.least(F.col("n_tokens"), F.col("rest") - F.col("reach") + F.col("n_tokens")).alias("used_tokens"))
    drawn = full.unionByName(cutoff).withColumnRenamed("s", "source")
    used = drawn.groupBy("source").agg(F.sum("used_tokens").alias("drawn_tokens"), F.count(F.lit(1)).alias("uses"), F.max("epoch").alias("most_repeats"))
    every = used.agg(F.sum("drawn_tokens").alias("_all"))
    report = (
        per.select(F.col("s").alias("source"), F.col("share").alias("target_share"), F.col("most").alias("max_repeats"), F.col("docs").alias("documents"), F.col("tokens").alias("available_tokens"), F.col("asked").alias("asked_tokens"), F.col("budget").alias("budget_tokens"))
        .join(used, "source", "left")
        .fillna(0, ["drawn_tokens", "uses", "most_repeats"])
        .crossJoin(F.broadcast(every))  # one row
        .withColumn("actual_share", F.when(F.col("_all") > 0, F.col("drawn_tokens") / F.col("_all")).otherwise(0.0))
        .withColumn("shortfall_tokens", F.col("asked_tokens") - F.col("drawn_tokens"))
        .drop("_all")
    )
    return drawn, report
