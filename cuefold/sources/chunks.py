"""Files of chunks: bounds, texts in two dialects, one file a chunk, caches that count whole or not at all; and their sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timecode
from .files import WORD


def _ms(c) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c) * 1000).cast("long")


def _lists(spark: SparkSession, path: str, item: str) -> DataFrame:
    """``path, at, r``: the items of files that hold one JSON list each; items that can't be read are null."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return raw.select("path", F.posexplode(F.from_json("value", f"array<struct<{item}>>")).alias("at", "r"))


def read_bounds(spark: SparkSession, path: str) -> DataFrame:
    """``path, chunk, start_ms, end_ms`` of files of chunk bounds, in the file's order."""
    return _lists(spark, path, "start_sec:double,end_sec:double").select("path", F.col("at").alias("chunk"), _ms("r.start_sec").alias("start_ms"), _ms("r.end_sec").alias("end_ms"))


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``path, chunk, start_ms, end_ms, text, error`` of chunks that name their times in either way; a chunk with neither is an error when read."""
    rows = _lists(spark, path, "chunk:int,start:double,end:double,chunk_start_s:double,chunk_end_s:double,text:string,error:string")
    none = F.raise_error(F.concat(F.col("path"), F.lit(": a chunk without times")))
    time = lambda a, b: _ms(F.coalesce(F.col(f"r.{a}"), F.col(f"r.{b}"), none.cast("double")))
    return rows.select("path", F.coalesce("r.chunk", "at").alias("chunk"), time("chunk_start_s", "start").alias("start_ms"), time("chunk_end_s", "end").alias("end_ms"), "r.text", "r.error")


def read_chunk_files(spark: SparkSession, folder: str, pattern: str = "chunk_*.json") -> DataFrame:
    """``path, chunk, start_ms, end_ms, text, error`` of a folder with one JSON object a file; files that can't be read are skipped."""
    schema = "chunk int, chunk_start_s double, chunk_end_s double, text string, error string, _bad string"
    rows = spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", "_bad").option("pathGlobFilter", pattern).option("ignoreCorruptFiles", True).json(folder)
    good = rows.select("*", F.col("_metadata.file_path").alias("path")).filter("_bad IS NULL AND chunk_start_s IS NOT NULL")
    return good.select("path", "chunk", _ms("chunk_start_s").alias("start_ms"), _ms("chunk_end_s").alias("end_ms"), "text", "error")


def assembled(chunks: DataFrame) -> DataFrame:
    """Chunk files as one list: ordered by ``chunk``, then start."""
    return chunks.orderBy("chunk", "start_ms")


def read_cached(spark: SparkSession, path: str) -> DataFrame:
    """``path, seq, s, e, text`` of cached transcripts; a file with any item that lacks a time or a text counts as none."""
    rows = _lists(spark, path, "start:double,end:double,text:string")
    bad = rows.filter("r.start IS NULL OR r.end IS NULL OR r.text IS NULL").select("path").distinct()
    return rows.join(bad, "path", "left_anti").select("path", (F.col("at") + 1).alias("seq"), _ms("r.start").alias("s"), _ms("r.end").alias("e"), F.col("r.text").alias("text"))


def prepass(segments: DataFrame, keys: Sequence[str], text: str, least: int = 10) -> DataFrame:
    """Segments with a text, of those transcripts that have ``least`` of them: shorter ones aren't worth a comparison."""
    own = segments.filter(F.length(F.trim(F.coalesce(text, F.lit("")))) > 0)
    enough = own.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= least).select(*keys)
    return own.join(enough, list(keys), "left_semi")


def shifted(df: DataFrame, by_ms: str, start: str, end: str, words: str | None = None) -> DataFrame:
    """Times of a chunk as times of the whole: ``by_ms`` added to start and end, and to the words' seconds."""
    out = df.withColumn(start, F.col(start) + F.col(by_ms)).withColumn(end, F.col(end) + F.col(by_ms))
    if words:
        off = F.col(by_ms) / 1000
        out = out.withColumn(words, F.transform(words, lambda w: F.struct((w["start"] + off).alias("start"), (w["end"] + off).alias("end"), w["word"].alias("word"), w["probability"].alias("probability"))))
    return out


def repaired_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path, chunk, line, text, mode, start_ms, end_ms``: the lines that alignment diagnostics say were placed anew, as times of the whole.

    Missing lists give no rows; times that the file gives for the whole win over those inside the chunk.
    """
    schema = "chunks array<struct<chunk:int,chunk_start_s:double,repaired_unaligned_details:array<struct<line_index_in_chunk:int,text:string,repair_mode:string,repaired_start_s:double,repaired_end_s:double,repaired_local_start_s:double,repaired_local_end_s:double>>>>"
    raw = spark.read.schema(schema).option("multiLine", True).json(path).select(F.col("_metadata.file_path").alias("path"), F.explode("chunks").alias("c"))
    d = raw.select("path", "c.chunk", "c.chunk_start_s", F.explode("c.repaired_unaligned_details").alias("d"))
    at = lambda k: _ms(F.coalesce(F.col(f"d.repaired_{k}_s"), F.col("chunk_start_s") + F.col(f"d.repaired_local_{k}_s")))
    return d.select("path", "chunk", F.col("d.line_index_in_chunk").alias("line"), "d.text", F.col("d.repair_mode").alias("mode"), at("start").alias("start_ms"), at("end").alias("end_ms"))


def write_words(df: DataFrame, path: str, keys: Sequence[str]) -> None:
    """Segments ``keys, s, e, text, words`` as JSON lines with times in seconds, a folder for each of ``keys``.

    A write that fails leaves no finished file; one that has succeeded isn't overwritten.
    """
    words = F.coalesce("words", F.array().cast(f"array<{WORD.simpleString()}>"))
    df.select(*keys, (F.col("s") / 1000).alias("start"), (F.col("e") / 1000).alias("end"), "text", words.alias("words")).write.partitionBy(*keys).mode("errorifexists").json(path)


def spoken_blocks(df: DataFrame, start_ms: str, end_ms: str, text: str, speaker: str | None = None, note: str | None = None) -> DataFrame:
    """``df`` with ``block``: a cue with hours only from one hour on, its speaker before the text and a note block before the cue."""
    said = F.coalesce(F.col(text), F.lit(""))
    if speaker:
        said = F.when(F.length(speaker) > 0, F.concat(F.col(speaker), F.lit(": "), said)).otherwise(said)
    head = F.concat(timecode.render(F.col(start_ms), hours=False), F.lit(" --> "), timecode.render(F.col(end_ms), hours=False), F.lit("\n"), said, F.lit("\n"))
    if note:
        head = F.when(F.length(note) > 0, F.concat(F.lit("NOTE\n"), F.col(note), F.lit("\n\n"), head)).otherwise(head)
    return df.withColumn("block", head)


def side_by_side(pairs: DataFrame, start_ms: str, end_ms: str, a: str, b: str, names: tuple[str, str] = ("A", "B")) -> DataFrame:
    """``pairs`` with ``shown``: both texts of a pair under its time, each line behind its side's name; a missing text shows ``(none)``."""
    lines = lambda c, n: F.array_join(F.transform(F.split(F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("(none)")), "\n"), lambda x: F.concat(F.lit(f"{n}: "), x)), "\n")
    head = F.concat(F.lit("["), timecode.render(F.col(start_ms)), F.lit(" - "), timecode.render(F.col(end_ms)), F.lit("]\n"))
    return pairs.withColumn("shown", F.concat(head, lines(a, names[0]), F.lit("\n"), lines(b, names[1])))
