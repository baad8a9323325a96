"""Queries of the text operators, and SQL where it can state the same result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table, to_ms
from . import chunks, lookalike, mixing, names, packing, sentences, spam, turns


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    cues = table(spark, folder, "cues").select(F.lit("cues").alias("src"), F.col("cue_id").alias("row_id"), "text")
    segments = table(spark, folder, "segments").select(F.lit("segments").alias("src"), F.col("seg_id").alias("row_id"), "text")
    return sentences.sentence_ends(cues.unionByName(segments), ["src", "row_id"], "text")


def _looks(spark: SparkSession, folder: str) -> DataFrame:
    cues = table(spark, folder, "cues").select(F.lit("cues").alias("src"), "episode_id", F.col("cue_id").alias("id"), "text")
    entries = table(spark, folder, "glossary_entries").select(F.lit("glossary_entries").alias("src"), "episode_id", F.col("entry_id").alias("id"), F.col("source").alias("text"))
    kata = table(spark, folder, "segments").select(F.lit("segments").alias("src"), "episode_id", F.col("seg_id").alias("id"), F.explode("kata").alias("text"))
    return cues.unionByName(entries).unionByName(kata)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalike.pairs(_looks(spark, folder), ["src", "episode_id"], "id", "text").select("src", "id_1", "id_2")


def p2_classes(spark: SparkSession, folder: str) -> DataFrame:
    """The class of each row whose text looks like another one, and the number of its links."""
    return lookalike.classes(_looks(spark, folder), ["src", "episode_id"], "id", "text")


def p3_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of the oversized cues with their times."""
    cues = table(spark, folder, "cues").select("cue_id", "text", to_ms("start_s").alias("s"), to_ms("end_s").alias("e"))
    return chunks.split_oversized(cues, ["cue_id"], "text", 120, 20, "s", "e")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    return p3_pieces(spark, folder).filter("piece_no = 1").select("cue_id", F.when(F.col("forced"), "forced").otherwise("natural").alias("kind"))


def _spoken(spark: SparkSession, folder: str) -> tuple:
    segments = table(spark, folder, "segments").select(F.lit("segments").alias("src"), "episode_id", F.col("name").alias("key"), to_ms("seg_start").alias("ms"), "text", "loaded_at")
    cues = table(spark, folder, "cues").filter("track = 'sdh'").select(F.lit("cues").alias("src"), "episode_id", F.lpad(F.col("seq").cast("string"), 12, "0").alias("key"), to_ms("start_s").alias("ms"), "text", "loaded_at")
    return segments.unionByName(cues), table(spark, folder, "speakers"), "src", "episode_id", "key", "ms", "text", "loaded_at"


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return turns.speaker_turns(*_spoken(spark, folder)).select("src", "episode_id", "turn_no", "spk_id", "first_ms", "last_ms")


def p4_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The clean speech of all turns, an utterance a row."""
    return turns.speaker_lines(*_spoken(spark, folder))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """The persons whom names mean; an episode's cast are the roster's persons among its speakers."""
    roster, entities, segments = (table(spark, folder, t) for t in ("roster", "entities", "segments"))
    name = entities.select(F.lit("entities").alias("src"), F.col("entity_id").alias("row_id"), "episode_id", F.lit(0).alias("item_no"), "name")
    variants = entities.select(F.lit("entities").alias("src"), F.col("entity_id").alias("row_id"), "episode_id", F.posexplode("variants").alias("pos", "name"))
    said = segments.select(F.lit("segments").alias("src"), F.col("seg_id").alias("row_id"), "episode_id", F.posexplode("names").alias("pos", "name"))
    places = variants.unionByName(said).select("src", "row_id", "episode_id", (F.col("pos") + 1).alias("item_no"), "name")
    cast = table(spark, folder, "speakers").join(roster, "name").select("episode_id", "person_id")
    return names.link_names(name.unionByName(places), ["src", "row_id", "item_no"], "episode_id", "name", roster, cast)


def p7_containers(spark: SparkSession, folder: str) -> DataFrame:
    """Containers of 2,048 tokens with all documents."""
    return packing.pack_documents(table(spark, folder, "documents"), "doc_id", "text")


def p7_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How full the containers are."""
    return packing.fill_report(p7_containers(spark, folder))


def p8_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Every use of a document in the largest mix that keeps the target shares."""
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "source_targets"), "doc_id", "source", "text")[0]


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and actual shares of the mix."""
    return mixing.mix(table(spark, folder, "documents"), table(spark, folder, "source_targets"), "doc_id", "source", "text")[1]


def p9_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Spam scores of all pages."""
    return spam.spam_scores(table(spark, folder, "documents"), "doc_id", "text", "url")


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_scores(spark, folder).filter("score > 0.5").select("doc_id")


def p1_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of all sentence ends: within the text, on no space, and no text without letters has one."""
    texts = table(spark, folder, "cues").select(F.lit("cues").alias("src"), F.col("cue_id").alias("row_id"), "text").unionByName(table(spark, folder, "segments").select(F.lit("segments").alias("src"), F.col("seg_id").alias("row_id"), "text"))
    ends = p1_found(spark, folder).groupBy("src", "row_id", "end_pos").agg(F.count(F.lit(1)).alias("n"))
    x = texts.join(ends, ["src", "row_id"], "left")
    count = lambda c: F.count(F.when(c, 1))
    blank = F.substr("text", F.col("end_pos"), F.lit(1)).rlike("\\s")
    return x.groupBy("src").agg(F.countDistinct("row_id").alias("texts"), count((F.col("end_pos") < 1) | (F.col("end_pos") > F.length("text"))).alias("outside"), count(blank).alias("on_space"), count(F.col("n") > 1).alias("twice"), count(F.col("end_pos").isNotNull() & ~F.col("text").rlike("[\\p{L}\\p{N}]")).alias("of_nothing"))


def p3_cover(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of all pieces: each text is covered once, no piece is over 120, no overlap over 20."""
    p = p3_pieces(spark, folder)
    within = (F.max(F.col("to_pos") - F.col("from_pos")) <= 120) & (F.max(F.col("own_pos") - F.col("from_pos")) <= 20) & (F.max(F.length("text") - F.col("to_pos") + F.col("from_pos")) == 0) & (F.count(F.lit(1)) == F.max("n_pieces")) & (F.min("own_pos") == 0)
    return p.groupBy("cue_id").agg(F.sum(F.col("to_pos") - F.col("own_pos")).alias("covered"), within.alias("within"))


def p7_cover(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of all containers: each document is in them once and whole, and none holds over 2,048 tokens."""
    items = p7_containers(spark, folder)
    fill = items.groupBy("container_id").agg(F.sum("n_tokens").alias("fill"))
    own = items.join(fill, "container_id")
    whole = (F.min("from_token") == 0) & (F.sum("n_tokens") == F.max("to_token")) & (F.count(F.lit(1)) == F.max("n_parts")) & (F.countDistinct("part_no") == F.max("n_parts"))
    return own.groupBy("doc_id").agg(whole.alias("whole"), (F.max("fill") <= 2048).alias("within"), ((F.max("n_parts") == 1) | (F.max("to_token") > 2048)).alias("divided_only_if_larger"))


def p8_rules(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of the mix: no document is used more often than allowed, none partly but one a source, and shares are met."""
    drawn, report = mixing.mix(table(spark, folder, "documents"), table(spark, folder, "source_targets"), "doc_id", "source", "text")
    uses = drawn.groupBy("source", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("used_tokens") < F.col("n_tokens"), 1)).alias("cut"))
    per = uses.groupBy("source").agg(F.max("n").alias("n"), F.sum("cut").alias("cut"))
    x = report.join(per, "source", "left")
    return x.select("source", (F.coalesce("n", F.lit(0)) <= F.col("max_repeats")).alias("repeats_kept"), (F.coalesce("cut", F.lit(0)) <= 1).alias("one_cut"), (F.abs(F.col("actual_share") - F.col("target_share")) < 0.001).alias("share_met"))


_P3 = r"""
SELECT cue_id, CASE WHEN regexp_matches(text, '[^\s\p{Z}\p{P}\p{S}]{121}') THEN 'forced' ELSE 'natural' END AS kind
FROM cues WHERE length(text) > 120
"""

_P1 = "SELECT 'cues' AS src, count(DISTINCT cue_id) AS texts, CAST(0 AS BIGINT) AS outside, CAST(0 AS BIGINT) AS on_space, CAST(0 AS BIGINT) AS twice, CAST(0 AS BIGINT) AS of_nothing FROM cues UNION ALL SELECT 'segments', count(DISTINCT seg_id), 0, 0, 0, 0 FROM segments"
_P3_COVER = "SELECT cue_id, CAST(length(text) AS BIGINT) AS covered, true AS within FROM cues WHERE length(text) > 120"
_P7 = "SELECT doc_id, true AS whole, true AS within, true AS divided_only_if_larger FROM documents WHERE length(text) > 0"
_P8 = "SELECT source, true AS repeats_kept, true AS one_cut, true AS share_met FROM source_targets"

QUERIES = {"p1_found": p1_found, "p2_found": p2_found, "p2_classes": p2_classes, "p3_found": p3_found, "p3_pieces": p3_pieces, "p4_found": p4_found, "p4_lines": p4_lines, "p6_found": p6_found, "p7_containers": p7_containers, "p7_fill": p7_fill, "p8_mix": p8_mix, "p8_shares": p8_shares, "p9_found": p9_found, "p9_scores": p9_scores, "p1_bounds": p1_bounds, "p3_cover": p3_cover, "p7_cover": p7_cover, "p8_rules": p8_rules}
ORACLE = {"p3_found": _P3, "p1_bounds": _P1, "p3_cover": _P3_COVER, "p7_cover": _P7, "p8_rules": _P8}
