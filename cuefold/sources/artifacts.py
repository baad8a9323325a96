"""Which of many files is meant: candidates by name and folder, scores by name, the latest, and what their names tell."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What names of repaired and reflowed cues add, and what those of aligned words end in.
ADDED = ("_reflow_repaired", "_repaired", "_reflow")
WORDS = "_ctc_words"


def listing(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """``path, folder, stem, modified`` of all files below a folder, without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.regexp_extract("path", "([^/]*)/[^/]*$", 1).alias("folder"), F.regexp_extract("path", "([^/]*?)(?:\\.[^./]*)?$", 1).alias("stem"), F.col("modificationTime").alias("modified"))


def word_stems(stem: str) -> list[str]:
    """Names that the aligned words of a file of cues may have, the likeliest first."""
    bases = [stem, *(stem[: -len(x)] for x in ADDED if stem.endswith(x))]
    every = [y for x in bases if x for y in ((x,) if x.endswith(WORDS) else (x, x + WORDS))]
    return list(dict.fromkeys(every))


def first_match(files: DataFrame, stems: Sequence[str], folders: Sequence[str]) -> DataFrame:
    """The file whose stem comes first in ``stems``, of equal ones the first in ``folders``; no row if there is none."""
    place = lambda c, names: F.array_position(F.array(*map(F.lit, names)), F.col(c))
    return files.filter(F.col("stem").isin(*stems) & F.col("folder").isin(*folders)).orderBy(place("stem", stems), place("folder", folders), "path").limit(1)


def aligned_words(files: DataFrame, stem: str, folder: str) -> DataFrame:
    """The words of a file of cues: beside it or, for one under ``translation``, under ``transcription``."""
    return first_match(files, word_stems(stem), [folder, "transcription"] if folder == "translation" else [folder])


def best_named(files: DataFrame, points: dict[str, int]) -> DataFrame:
    """The file whose name holds what gives most points in sum; of equal ones the last name."""
    score = sum((F.when(F.contains(F.lower("stem"), F.lit(k)), v).otherwise(0) for k, v in points.items()), F.lit(0))
    return files.withColumn("score", score).filter("score > 0").orderBy(F.col("score").desc(), F.col("stem").desc()).limit(1)


def latest(files: DataFrame) -> DataFrame:
    """The file with the last path."""
    return files.orderBy(F.col("path").desc()).limit(1)


def plan_label(stem: Column, target_s: Column) -> Column:
    """How chunks were planned, by a file's name: the kind and the target's seconds, those in the name if ``target_s`` is null."""
    kind = F.when(F.contains(F.lower(stem), F.lit("semantic")), "semantic").when(F.contains(F.lower(stem), F.lit("vad")), "vad").otherwise("fixed")
    seconds = F.coalesce(target_s.cast("int"), F.regexp_extract(stem, "_([0-9]+)s?(?:_|$)", 1).try_cast("int"))
    return F.when(seconds.isNull(), kind).otherwise(F.concat(kind, F.lit("_"), seconds.cast("string")))


def seen_frames(frames: DataFrame) -> DataFrame:
    """``frame`` of those that have lines: what a run that goes on leaves out by an anti-join."""
    return frames.filter("lines IS NOT NULL AND frame IS NOT NULL").select("frame").distinct()
