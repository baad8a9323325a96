"""Rules on the quality of transcript chunks and cues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import previous

# Marks of a spoken and of a visual line, and what ends a sentence.
SPOKEN = "--"
VISUAL = "^\\[画面:.*\\]$"
TERMINAL = "。！？!?…」』）)"
# What a model says about its work instead of transcribing, and what parts a line's tokens.
THOUGHT = (
    "(?i)transcription|segmenting|processing the audio|plain text|speaker labels|following (?:all )?instructions|omitting silence|utterance per line|"
    "i(?:'m| am) now|i(?:'ve| have) (?:begun|completed|started)|methodically transcribing"
)
HEADING = "^\\*\\*.*\\*\\*$"
TOKEN = "[^\\s\u3000、。！？,.!?\\-]+"


def lines_of(text) -> Column:
    """The stripped, non-empty lines of a text; null gives none."""
    t = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.filter(F.transform(F.split(t, "\n"), lambda x: F.trim(x)), lambda x: F.length(x) > 0)


def inspect_chunks(df: DataFrame, keys: Sequence[str], text: str) -> DataFrame:
    """``keys`` (unique), line counts, marker coverage, the dominant short line, issues and a status for each chunk.

    Red: no lines; visual lines alone; unmarked speech alone; a line of 500 characters; a line that tells a model's thoughts;
    a spoken line in which one token stands 12 times and makes up three quarters; one short line (at most 12 characters) 12
    times and in 35 % of the speech. Yellow, where nothing is red: under 85 % of the speech marked; a short
    line 8 times and in 25 %; at least three visual lines that are as many as the speech. Of equally frequent short lines
    the first one dominates.
    """
    spoken = lambda x: x.startswith(SPOKEN)
    visual = lambda x: x.rlike(VISUAL)
    bare = lambda x: F.regexp_replace(F.regexp_replace(x, "^--\\s*", ""), "\\s+", " ")
    lines = df.withColumn("_lines", lines_of(text))
    lines = lines.withColumn("_speech", F.filter("_lines", lambda x: spoken(x) | ~visual(x))).withColumn("_said", F.filter(F.transform("_speech", bare), lambda x: F.length(x) > 0))
    count = lambda c, f: F.size(F.filter(c, f))
    lines = (
        lines.withColumn("total_lines", F.size("_lines"))
        .withColumn("spoken_lines", count("_lines", spoken))
        .withColumn("visual_lines", count("_lines", lambda x: visual(x) & ~spoken(x)))
        .withColumn("other_lines", F.col("total_lines") - F.col("spoken_lines") - F.col("visual_lines"))
        .withColumn("longest_line", F.coalesce(F.array_max(F.transform("_lines", F.length)), F.lit(0)))
        .withColumn("speech_lines", F.size("_speech"))
    )
    short = lines.select(*keys, F.posexplode("_said").alias("_at", "_line")).filter("length(_line) <= 12")
    counted = short.groupBy(*keys, "_line").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    top = counted.groupBy(*keys).agg(F.max_by(F.struct("_line", "_n"), F.struct("_n", -F.col("_first"))).alias("_top"))
    full = lines.join(top, list(keys), "left").withColumn("dominant_line", F.col("_top._line")).withColumn("dominant_count", F.coalesce(F.col("_top._n"), F.lit(0)))
    share = F.col("dominant_count") / F.greatest(F.size("_said"), F.lit(1))
    c = F.col
    thought = F.exists("_lines", lambda x: x.rlike(THOUGHT) | x.rlike(HEADING) | x.isin("code", "Text"))
    # twelve of one token that are three quarters: it is the middle one of the sorted tokens
    tokens = lambda x: F.array_sort(F.regexp_extract_all(x, F.lit(TOKEN), F.lit(0)))
    most = lambda t: F.size(F.filter(t, lambda y: y == F.get(t, F.floor(F.size(t) / 2).cast("int"))))
    looped = F.exists(F.filter(F.transform("_said", tokens), lambda t: F.size(t) >= 12), lambda t: (most(t) >= 12) & (most(t) * 4 >= F.size(t) * 3))
    red = {
        "thought_leak": thought,
        "repeated_token_loop": looped,
        "empty_chunk": c("total_lines") == 0,
        "visual_only_chunk": (c("visual_lines") > 0) & (c("speech_lines") == 0),
        "missing_turn_markers": (c("other_lines") > 0) & (c("spoken_lines") == 0) & (c("visual_lines") == 0),
        "overlong_line": c("longest_line") >= 500,
        "dominant_short_line_loop": (c("dominant_count") >= 12) & (share >= 0.35),
    }
    yellow = {
        "partial_turn_marker_loss": (c("other_lines") > 0) & (c("spoken_lines") > 0) & (c("spoken_lines") / F.greatest(c("speech_lines"), F.lit(1)) < 0.85),
        "dominant_short_line_heavy": (c("dominant_count") >= 8) & (share >= 0.25) & ~red["dominant_short_line_loop"],
        "visual_heavy_chunk": (c("visual_lines") >= 3) & (c("speech_lines") > 0) & (c("visual_lines") >= c("speech_lines")),
    }
    named = lambda rules: F.filter(F.array(*[F.when(v, F.lit(k)) for k, v in rules.items()]), lambda x: x.isNotNull())
    return full.withColumn("_red", named(red)).withColumn("_yellow", named(yellow)).select(
        *keys, "total_lines", "spoken_lines", "visual_lines", "other_lines", "longest_line", "dominant_line", "dominant_count",
        F.when(c("speech_lines") > 0, c("spoken_lines") / c("speech_lines")).alias("marker_coverage"),
        F.array_sort(F.concat("_red", "_yellow")).alias("issues"),
        F.when(F.size("_red") > 0, "red").when(F.size("_yellow") > 0, "yellow").otherwise("green").alias("status"),
    )


def cue_flags(start: str, end: str, text: str) -> dict[str, Column]:
    """Flags of one cue, by its time in milliseconds and its text without white space."""
    t = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[\\s　 ]+", "")
    ms = F.greatest(F.lit(0), F.col(end) - F.col(start))
    return {
        "short": ms < 800,
        "very_short": ms < 500,
        "tiny": F.length(t) <= 4,
        "small": F.length(t) <= 8,
        "non_terminal": (F.length(t) > 0) & ~F.substring(t, -1, 1).isin(*TERMINAL),
        "empty": F.length(t) == 0,
    }


def preflight(df: DataFrame, keys: Sequence[str], start: str, end: str, order: Sequence[str], block: str) -> DataFrame:
    """``df`` with ``negative``, ``micro`` (under 0.5 s) and ``overlaps_next``: whether the next cue starts before this one's end."""
    back = df.withColumn("_turn", -F.col(block)).withColumn("_desc", F.struct(*[-F.col(c) for c in order]))
    seen = previous(back, keys, "_turn", ["_desc"], start, "_next")
    return seen.withColumn("negative", F.col(end) < F.col(start)).withColumn("micro", F.col(end) - F.col(start) < 500).withColumn("overlaps_next", F.coalesce(F.col("_next") < F.col(end), F.lit(False))).drop("_turn", "_desc", "_next")
