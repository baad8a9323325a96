"""Queries on intervals, gaps, sessions and windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import islands, windows
from ..operators.intervals import best_overlap, nearest, overlap_join, point_in_interval
from ..operators.ordered import previous
from .base import CUES, INTERVALS, SEGMENTS, cues, intervals, segments

QUERIES, ORACLE = {}, {}


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return register


def _pair(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Speech segments and the Japanese or labelled cues of the same episode, as two transcripts."""
    seg = segments(spark, folder).select("episode_id", F.col("name").alias("seg"), "s", "e", "text")
    cue = cues(spark, folder).filter("track = 'sdh'").select("episode_id", "seq", F.col("s").alias("cs"), F.col("e").alias("ce"), F.col("text").alias("said"))
    return seg, cue


_PAIR = f"{CUES}, {SEGMENTS}, c AS (SELECT episode_id, seq, s AS cs, e AS ce, text AS said FROM timed WHERE track = 'sdh')"


@query(f"WITH {_PAIR} SELECT g.episode_id, name AS seg, seq, least(g.e, ce) - greatest(g.s, cs) AS overlap_ms FROM seg g JOIN c ON g.episode_id = c.episode_id AND g.s < ce AND g.e > cs")
def overlap_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Overlap join: all pairs of segments and labelled cues that overlap in time."""
    seg, cue = _pair(spark, folder)
    pairs = overlap_join(seg, cue, ["episode_id"], ("s", "e"), ("cs", "ce"))
    return pairs.select("episode_id", "seg", "seq", F.greatest(F.lit(-1), F.least("e", "ce") - F.greatest("s", "cs")).alias("overlap_ms"))


@query(
    f"""WITH {_PAIR}, p AS (
  SELECT g.episode_id, name AS seg, seq, least(g.e, ce) - greatest(g.s, cs) AS overlap_ms,
    row_number() OVER (PARTITION BY g.episode_id, name ORDER BY least(g.e, ce) - greatest(g.s, cs) DESC, seq) AS rn
  FROM seg g JOIN c ON g.episode_id = c.episode_id AND g.s < ce AND g.e > cs AND least(g.e, ce) > greatest(g.s, cs))
SELECT episode_id, seg, seq, overlap_ms FROM p WHERE rn = 1"""
)
def max_overlap_pick(spark: SparkSession, folder: str) -> DataFrame:
    """The cue that each segment overlaps longest; of equal ones the first."""
    seg, cue = _pair(spark, folder)
    return best_overlap(seg, cue, ["episode_id"], ["seg"], ("s", "e"), ("cs", "ce"), ["seq"]).select("episode_id", "seg", "seq", "overlap_ms")


@query(
    f"""WITH {_PAIR}, p AS (
  SELECT g.episode_id, name AS seg, seq, CASE WHEN ce <= g.s THEN g.s - ce ELSE cs - g.e END AS distance_ms FROM seg g JOIN c ON g.episode_id = c.episode_id
  WHERE g.s IS NOT NULL AND g.e IS NOT NULL AND NOT EXISTS (SELECT 1 FROM c d WHERE d.episode_id = g.episode_id AND g.s < d.ce AND g.e > d.cs)),
r AS (SELECT *, row_number() OVER (PARTITION BY episode_id, seg ORDER BY distance_ms, seq) AS rn FROM p)
SELECT episode_id, seg, seq, distance_ms FROM r WHERE rn = 1"""
)
def nearest_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest cue of each segment that overlaps none."""
    seg, cue = _pair(spark, folder)
    return nearest(seg.select("episode_id", "seg", "s", "e"), cue.select("episode_id", "seq", "cs", "ce"), ["episode_id"], ["seg"], ("s", "e"), ("cs", "ce"), ["seq"]).select("episode_id", "seg", "seq", "distance_ms")


@query(f"WITH {_PAIR} SELECT g.episode_id, name AS seg, seq FROM seg g JOIN c ON g.episode_id = c.episode_id AND cs >= ws AND cs < we")
def cues_in_clip(spark: SparkSession, folder: str) -> DataFrame:
    """Point-in-interval join: the cues that start within a segment's clip."""
    seg = segments(spark, folder).select("episode_id", F.col("name").alias("seg"), "ws", "we")
    return point_in_interval(_pair(spark, folder)[1], seg, ["episode_id"], "cs", ("ws", "we")).select("episode_id", "seg", "seq")


@query(
    f"""WITH {CUES}, f AS (SELECT DISTINCT episode_id, s AS pos, text AS line FROM timed WHERE track = 'en_sub' AND text <> ''), {SEGMENTS}
SELECT g.episode_id, name AS seg, list_sort(list(DISTINCT line)) AS lines FROM seg g JOIN f ON g.episode_id = f.episode_id AND pos >= ws AND pos <= we GROUP BY 1, 2"""
)
def lines_on_screen(spark: SparkSession, folder: str) -> DataFrame:
    """Closed-interval join: the distinct lines shown at a time within a clip, bounds included, sorted."""
    shown = cues(spark, folder).filter("track = 'en_sub' AND text <> ''").select("episode_id", F.col("s").alias("at"), F.col("s").alias("at2"), F.col("text").alias("line")).distinct()
    clips = segments(spark, folder).select("episode_id", F.col("name").alias("seg"), "ws", "we")
    met = overlap_join(clips, shown, ["episode_id"], ("ws", "we"), ("at", "at2"), closed=True)
    return met.groupBy("episode_id", "seg").agg(F.array_sort(F.collect_set("line")).alias("lines"))


@query(
    f"""WITH {CUES}, o AS (SELECT *, lag(e) OVER (PARTITION BY episode_id, track ORDER BY s, seq) AS p FROM timed)
SELECT episode_id, track, p AS gap_start, s AS gap_end, s - p AS gap_ms, s + p AS mid2 FROM o WHERE s - p >= 750"""
)
def silence_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Gaps of at least 0.75 s between consecutive cues of a track."""
    return islands.gaps(cues(spark, folder), ["episode_id", "track"], "s", "e", ["s", "seq"], 750)


@query(
    f"""WITH {CUES}, o AS (SELECT *, lag(e) OVER (PARTITION BY episode_id, track ORDER BY s, seq) AS p FROM timed WHERE s < e),
n AS (SELECT *, sum(CASE WHEN p IS NULL OR s - p >= 300 THEN 1 ELSE 0 END) OVER (PARTITION BY episode_id, track ORDER BY s, seq ROWS UNBOUNDED PRECEDING) AS session FROM o)
SELECT episode_id, track, CAST(session AS BIGINT) AS session, min(s) AS s, max(e) AS e, count(*) AS cues FROM n GROUP BY 1, 2, 3"""
)
def pause_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Pause groups: cues without a pause of 0.3 s between them."""
    own = islands.sessions(cues(spark, folder), ["episode_id", "track"], "s", "e", ["s", "seq"], 300)
    return own.groupBy("episode_id", "track", "session").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count(F.lit(1)).alias("cues"))


@query(
    f"""WITH {INTERVALS}, o AS (SELECT *, lag(e) OVER (PARTITION BY event_type ORDER BY s, event_id) AS p FROM iv)
SELECT event_type, event_id, CASE WHEN s < p - 50 THEN 'overlap' ELSE 'gap' END AS issue, abs(s - p) AS size_ms FROM o WHERE abs(s - p) > 50"""
)
def coverage_issues(spark: SparkSession, folder: str) -> DataFrame:
    """Neighbouring intervals that leave a gap or overlap by more than 50 ms."""
    rows = intervals(spark, folder).withColumn("block", F.floor(F.col("s") / 86_400_000))
    seen = previous(rows, ["event_type"], "block", ["s", "event_id"], "e", "p")
    return seen.filter(F.abs(F.col("s") - F.col("p")) > 50).select("event_type", "event_id", F.when(F.col("s") < F.col("p") - 50, "overlap").otherwise("gap").alias("issue"), F.abs(F.col("s") - F.col("p")).alias("size_ms"))


@query(f"WITH {CUES}, o AS (SELECT *, lag(e) OVER (PARTITION BY episode_id, track ORDER BY s, seq) AS p FROM timed) SELECT episode_id, track, seq, greatest(s, coalesce(p, s)) AS s, e FROM o")
def without_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """Cues that start where the cue before them ends, if they started before."""
    rows = cues(spark, folder).withColumn("block", F.floor(F.col("s") / 600_000))
    return previous(rows, ["episode_id", "track"], "block", ["s", "seq"], "e", "p").select("episode_id", "track", "seq", F.greatest("s", F.coalesce("p", "s")).alias("s"), "e")


@query(
    f"""WITH {CUES}, t AS (SELECT episode_id, track, seq, text FROM cue WHERE text IS NOT NULL),
o AS (SELECT *, lag(text) OVER (PARTITION BY episode_id, track ORDER BY seq) AS p FROM t),
r AS (SELECT *, sum(CASE WHEN p = text THEN 0 ELSE 1 END) OVER (PARTITION BY episode_id, track ORDER BY seq ROWS UNBOUNDED PRECEDING) AS run FROM o),
k AS (SELECT *, row_number() OVER (PARTITION BY episode_id, track, run ORDER BY seq) AS rn FROM r)
SELECT episode_id, track, seq, CAST(run AS BIGINT) AS run FROM k WHERE rn <= 2"""
)
def few_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """Of each run of cues with one text the first two."""
    from pyspark.sql import Window

    rows = cues(spark, folder, timed=False).filter("text IS NOT NULL").withColumn("block", F.floor(F.col("seq") / 500))
    own = islands.runs(rows, ["episode_id", "track"], "block", ["seq"], "text")
    w = Window.partitionBy("episode_id", "track", "run").orderBy("seq")
    return own.withColumn("rn", F.row_number().over(w)).filter("rn <= 2").select("episode_id", "track", "seq", "run")


_DROPS = "[\\s　、。！？?!…,.，「」『』（）()【】\\[\\]・:：\\-ー]+"
_WINDOWS = f"""{CUES}, {SEGMENTS},
sec AS (SELECT episode_id, track, s, e, lpad(CAST(seq AS VARCHAR), 12, '0') AS seq, trim(text, ' ') AS text FROM timed WHERE text IS NOT NULL),
pri AS (SELECT episode_id, track, s, e, lpad(CAST(s AS VARCHAR), 12, '0') || name AS seq, trim(text, ' ') AS text FROM seg JOIN (SELECT DISTINCT episode_id, track FROM sec) USING (episode_id) WHERE text IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL),
ends AS (SELECT episode_id, track, max(e) AS last FROM (SELECT episode_id, track, e FROM pri UNION ALL SELECT episode_id, track, e FROM sec) GROUP BY 1, 2),
k AS (SELECT episode_id, track, last, unnest(range(0, greatest(last, 0), 5000)) AS start_ms FROM ends),
w AS (SELECT episode_id, track, start_ms, least(last, start_ms + 10000) AS end_ms FROM k),
a AS (SELECT w.episode_id, w.track, start_ms, end_ms, string_agg(text, ' / ' ORDER BY seq) AS t FROM w JOIN pri p ON p.episode_id = w.episode_id AND p.track = w.track AND p.s < end_ms AND p.e > start_ms WHERE length(text) > 0 GROUP BY 1, 2, 3, 4),
b AS (SELECT w.episode_id, w.track, start_ms, end_ms, string_agg(text, ' / ' ORDER BY seq) AS t FROM w JOIN sec p ON p.episode_id = w.episode_id AND p.track = w.track AND p.s < end_ms AND p.e > start_ms WHERE length(text) > 0 GROUP BY 1, 2, 3, 4),
x AS (SELECT w.episode_id, w.track, w.start_ms, w.end_ms, coalesce(a.t, '') AS primary_text, coalesce(b.t, '') AS secondary_text,
  length(regexp_replace(coalesce(a.t, ''), '{_DROPS}', '', 'g')) AS primary_chars, length(regexp_replace(coalesce(b.t, ''), '{_DROPS}', '', 'g')) AS secondary_chars
  FROM w LEFT JOIN a USING (episode_id, track, start_ms, end_ms) LEFT JOIN b USING (episode_id, track, start_ms, end_ms)),
fl AS (SELECT * FROM x WHERE secondary_chars >= 12 AND (primary_chars <= 4 OR secondary_chars >= greatest(primary_chars * 2, primary_chars + 12)))"""


def two_transcripts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The segments of an episode, for each of its tracks, and the cues of those tracks: ``episode_id, track, s, e, seq, text``."""
    cue = cues(spark, folder).filter("text IS NOT NULL").select("episode_id", "track", "s", "e", F.lpad(F.col("seq").cast("string"), 12, "0").alias("seq"), "text")
    seg = segments(spark, folder).filter("text IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL").select("episode_id", "s", "e", F.concat(F.lpad(F.col("s").cast("string"), 12, "0"), "name").alias("seq"), "text")
    return seg.join(cue.select("episode_id", "track").distinct(), "episode_id"), cue


def _windows(spark: SparkSession, folder: str) -> DataFrame:
    return windows.flagged(windows.sliding_windows(*two_transcripts(spark, folder), ["episode_id", "track"], 10_000, 5_000))


@query(f"WITH {_WINDOWS} SELECT episode_id, track, start_ms, end_ms, primary_text, secondary_text, CAST(primary_chars AS INT) AS primary_chars, CAST(secondary_chars AS INT) AS secondary_chars FROM fl")
def flagged_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Windows of 10 s, every 5 s, in which one transcript has much more than the other."""
    return _windows(spark, folder)


@query(
    f"""WITH {_WINDOWS},
m AS (SELECT *, max(end_ms) OVER (PARTITION BY episode_id, track ORDER BY start_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM fl),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_ms > reach + 750 THEN 1 ELSE 0 END) OVER (PARTITION BY episode_id, track ORDER BY start_ms ROWS UNBOUNDED PRECEDING) AS region FROM m),
r AS (SELECT episode_id, track, CAST(region AS BIGINT) AS region, min(start_ms) AS start_ms, max(end_ms) AS end_ms, arg_min(secondary_text, start_ms) AS secondary_text,
  CAST(max(primary_chars) AS INT) AS primary_chars, CAST(max(secondary_chars) AS INT) AS secondary_chars, count(*) AS windows FROM g GROUP BY 1, 2, 3)
SELECT episode_id, track, region, start_ms, end_ms, secondary_text, primary_chars, secondary_chars, windows, rank FROM (
  SELECT *, row_number() OVER (ORDER BY secondary_chars - primary_chars DESC, start_ms, episode_id, track) AS rank FROM r) WHERE rank <= 20"""
)
def coverage_gap_regions(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 regions that one transcript most lacks against the other: windows, flags, merges and rank in one plan."""
    from pyspark.sql import Window

    regions = windows.merge_windows(_windows(spark, folder), ["episode_id", "track"], 750)
    order = [(F.col("secondary_chars") - F.col("primary_chars")).desc(), "start_ms", "episode_id", "track"]
    top = regions.orderBy(*order).limit(20)  # the report's length; the window below sees these rows only
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("long")).select("episode_id", "track", "region", "start_ms", "end_ms", "secondary_text", "primary_chars", "secondary_chars", "windows", "rank")
