"""Readers and writers of subtitle, diarisation, glossary and transcript files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import timecode


def read_cues(spark: SparkSession, path: str, keep_empty: bool = True) -> DataFrame:
    """``path, seq, start_ms, end_ms, text`` of the cues in WebVTT and SubRip files.

    A byte order mark and carriage returns are dropped; blocks without an arrow line (headers, notes, styles) are skipped,
    and what stands before the arrow line of a block (an id or a number) too; settings after the end time are ignored.
    A cue without text stays with ``keep_empty``. Times that can't be read give null. ``seq`` counts from 1 per file.
    """
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return parse_cues(raw, "path", "value", keep_empty)


def parse_cues(df: DataFrame, key: str, text: str, keep_empty: bool = True) -> DataFrame:
    """As :func:`read_cues`, for texts of files in a column; null texts give no cue."""
    plain = F.replace(F.regexp_replace(F.regexp_replace(F.col(text), "^\ufeff", ""), "\r\n?", "\n"), F.lit("\ufeff"), F.lit(""))
    blocks = df.select(F.col(key), F.posexplode(F.split(plain, "\n[ \t]*\n+")).alias("_at", "_block")).filter(F.contains("_block", F.lit("-->")))
    arrow = F.regexp_extract("_block", "(?m)^([^\n]*-->[^\n]*)$", 1)
    body = F.expr("substring(_block, instr(_block, '-->'))")
    said = F.when(F.contains(body, F.lit("\n")), F.expr("substring(substring(_block, instr(_block, '-->')), instr(substring(_block, instr(_block, '-->')), '\n') + 1)")).otherwise("")
    code = lambda side: timecode.parse(F.regexp_extract(arrow, r"((?:\d+:)?\d{1,2}:\d{2}[.,]\d{3})\s*-->\s*((?:\d+:)?\d{1,2}:\d{2}[.,]\d{3})", side))
    rows = blocks.select(key, "_at", code(1).alias("start_ms"), code(2).alias("end_ms"), F.rtrim(F.regexp_replace(said, "\n+$", "")).alias("text"))
    rows = rows if keep_empty else rows.filter("length(trim(text)) > 0")
    from pyspark.sql import Window

    return rows.withColumn("seq", F.row_number().over(Window.partitionBy(key).orderBy("_at"))).select(key, "seq", "start_ms", "end_ms", "text")


def cue_blocks(df: DataFrame, start_ms: str, end_ms: str, text: str, number: str | None = None) -> DataFrame:
    """``df`` with ``block``: the cue as a WebVTT block or, with a column ``number``, as a SubRip one."""
    mark = "," if number else "."
    head = F.concat(timecode.render(F.col(start_ms), mark), F.lit(" --> "), timecode.render(F.col(end_ms), mark), F.lit("\n"), F.coalesce(F.col(text), F.lit("")), F.lit("\n"))
    return df.withColumn("block", F.concat(F.col(number).cast("string"), F.lit("\n"), head) if number else head)


def write_cues(df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], start_ms: str, end_ms: str, text: str) -> None:
    """Cue blocks as text files, a folder for each value of ``keys``, in ``order`` within it.

    Rows are range-partitioned by keys and order, so a file's size is the engine's to choose, and a key of any size is
    written by many tasks; the files' names sort in the cues' order.
    """
    blocks = cue_blocks(df, start_ms, end_ms, text).select(*keys, *order, "block")
    ranged = blocks.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    ranged.select(*keys, F.col("block").alias("value")).write.partitionBy(*keys).mode("errorifexists").text(path)


def read_rttm(spark: SparkSession, path: str) -> DataFrame:
    """``path, speaker, start_ms, end_ms`` of the SPEAKER rows of diarisation files; short rows are skipped."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.split(F.trim("value"), "\\s+").alias("f")).filter("f[0] = 'SPEAKER' AND size(f) >= 8")
    ms = lambda i: F.round(F.expr(f"try_cast(f[{i}] AS double)") * 1000).cast("long")
    return raw.select("path", F.col("f")[7].alias("speaker"), ms(3).alias("start_ms"), (ms(3) + ms(4)).alias("end_ms"))


def read_glossary(spark: SparkSession, path: str) -> DataFrame:
    """``source, target, shown`` of tab-separated glossaries without their header; ``shown`` is ``source (target)``."""
    rows = spark.read.schema("source string, target string").option("sep", "\t").csv(path).filter("source IS NOT NULL AND lower(source) <> 'source'")
    return rows.withColumn("shown", F.when(F.length("target") > 0, F.concat("source", F.lit(" ("), "target", F.lit(")"))).otherwise(F.col("source")))


WORD = T.StructType([T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType()), T.StructField("word", T.StringType()), T.StructField("probability", T.DoubleType())])
SEGMENT = T.StructType([T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType()), T.StructField("text", T.StringType()), T.StructField("turn_index", T.IntegerType()), T.StructField("starts_new_turn", T.BooleanType()), T.StructField("words", T.ArrayType(WORD))])


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """``path, seq, s, e, text, turn_index, starts_new_turn, words`` of files that hold one JSON list of segments; another root raises an error when read."""
    raw = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    sound = raw.withColumn("value", F.when(F.regexp_like("value", F.lit(r"^\s*\[")), F.col("value")).otherwise(F.raise_error(F.concat(F.col("path"), F.lit(": no list of segments")))))
    rows = sound.select("path", F.posexplode(F.from_json("value", T.ArrayType(SEGMENT))).alias("at", "r"))
    ms = lambda c: F.round(F.col(c) * 1000).cast("long")
    return rows.select("path", (F.col("at") + 1).alias("seq"), ms("r.start").alias("s"), ms("r.end").alias("e"), "r.text", "r.turn_index", "r.starts_new_turn", "r.words")


def words_of(segments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys, i, s, e, word``: the words of segments in order of time, numbered from 1; empty words are left out."""
    from pyspark.sql import Window

    rows = segments.select(*keys, "seq", F.posexplode("words").alias("at", "w")).filter("length(trim(w.word)) > 0")
    ms = lambda c: F.round(F.col(c) * 1000).cast("long")
    timed = rows.select(*keys, "seq", "at", ms("w.start").alias("s"), ms("w.end").alias("e"), F.col("w.word").alias("word"))
    return timed.withColumn("i", F.row_number().over(Window.partitionBy(*keys).orderBy("s", "e", "seq", "at"))).select(*keys, "i", "s", "e", "word")


def read_frames(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """``frame, frame_no, time_sec, lines`` of JSON lines; rows that can't be read or lack ``lines`` are dropped or, if ``strict``, an error."""
    rows = spark.read.schema("frame string, frame_no long, time_sec double, lines array<string>").option("mode", "FAILFAST" if strict else "DROPMALFORMED").json(path)
    return rows.filter("lines IS NOT NULL")


def clamp_parts(df: DataFrame, chunk: tuple[str, str], part: tuple[str, str]) -> DataFrame:
    """Parts with times inside their chunk as times of the whole, cut to the chunk; parts left without length are dropped."""
    s = F.greatest(F.col(chunk[0]), F.col(chunk[0]) + F.col(part[0]))
    e = F.least(F.col(chunk[1]), F.col(chunk[0]) + F.col(part[1]))
    return df.withColumn("_e", e).withColumn(part[0], s).withColumn(part[1], F.col("_e")).drop("_e").filter(F.col(part[1]) > F.col(part[0]))
