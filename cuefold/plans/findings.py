"""Reports on what one transcript lacks or says otherwise than another."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import NARRATION, holds_any
from ..functions.text import bigram_jaccard, bigrams, squeeze
from ..operators import windows
from ..operators.intervals import overlap_join
from .base import CUES, SEGMENTS, cues, segments
from .timing import _WINDOWS, _windows, two_transcripts

QUERIES, ORACLE = {}, {}
_DROPS = "[\\s　、。！？?!…,.，「」『』（）()【】\\[\\]・:：\\-ー]+"
_SQL_HINT = " OR ".join(f"contains({{t}}, '{h}')" for h in NARRATION)


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return register


def omission_class(primary_chars: Column, spoken: Column, visual: Column, narration: Column) -> tuple[Column, Column]:
    """What a region most likely lacks, and how sure that is, from its likeness to spoken and visual context."""
    shown = (visual >= 0.3) & (visual > spoken + 0.08) & narration
    kind = F.when(shown, "shown_not_said").when((primary_chars <= 4) & narration, "missing_narration").when(spoken >= 0.18, "shortened_or_missing").when(narration, "missing_narration").otherwise("spoken_gap")
    sure = F.when(shown | ((primary_chars <= 4) & narration), "high").when((spoken >= 0.18) | narration | (primary_chars <= 6), "medium").otherwise("low")
    return kind, sure


def _grams(t: str) -> str:
    return f"list_distinct(list_transform(range(1, greatest(length({t}), 1)), lambda i: substr({t}, i, 2)))"


def _jaccard(a: str, b: str) -> str:
    return f"CASE WHEN len({a}) = 0 OR len({b}) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect({a}, {b})) / (len({a}) + len({b}) - len(list_intersect({a}, {b})))::DOUBLE END"


_SEEN = "^\\[画面: *(.*)\\]$"


@query(
    f"""WITH {_WINDOWS},
m AS (SELECT *, max(end_ms) OVER (PARTITION BY episode_id, track ORDER BY start_ms ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM fl),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR start_ms > reach + 750 THEN 1 ELSE 0 END) OVER (PARTITION BY episode_id, track ORDER BY start_ms ROWS UNBOUNDED PRECEDING) AS region FROM m),
r AS (SELECT episode_id, track, CAST(region AS BIGINT) AS region, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM g GROUP BY 1, 2, 3),
pt AS (SELECT r.episode_id, r.track, region, string_agg(text, ' / ' ORDER BY seq) AS t FROM r JOIN pri p ON p.episode_id = r.episode_id AND p.track = r.track AND p.s < end_ms AND p.e > start_ms WHERE length(text) > 0 GROUP BY 1, 2, 3),
st AS (SELECT r.episode_id, r.track, region, string_agg(text, ' / ' ORDER BY seq) AS t FROM r JOIN sec p ON p.episode_id = r.episode_id AND p.track = r.track AND p.s < end_ms AND p.e > start_ms WHERE length(text) > 0 GROUP BY 1, 2, 3),
li AS (SELECT episode_id, name, s, e, pos, trim(raw, ' ') AS line FROM (SELECT episode_id, name, s, e, unnest(string_split(text, chr(10))) AS raw, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM seg WHERE text IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL) WHERE trim(raw, ' ') <> ''),
nr AS (SELECT r.episode_id, r.track, region, regexp_matches(line, '{_SEEN}') AS visual, CASE WHEN regexp_matches(line, '{_SEEN}') THEN regexp_extract(line, '{_SEEN}', 1) ELSE line END AS said, row_number() OVER (PARTITION BY r.episode_id, r.track, region, regexp_matches(line, '{_SEEN}') ORDER BY s, name, pos) AS rn
  FROM r JOIN li ON li.episode_id = r.episode_id AND ((s < end_ms AND e > start_ms) OR abs(s - start_ms) <= 1000 OR abs(e - end_ms) <= 1000)),
ctx AS (SELECT episode_id, track, region, coalesce(string_agg(said, ' / ' ORDER BY rn) FILTER (NOT visual), '') AS spoken, coalesce(string_agg(said, ' / ' ORDER BY rn) FILTER (visual), '') AS shown FROM nr WHERE rn <= 6 GROUP BY 1, 2, 3),
q AS (SELECT r.*, coalesce(st.t, '') AS said, regexp_replace(coalesce(st.t, ''), '{_DROPS}', '', 'g') AS a, regexp_replace(coalesce(pt.t, ''), '{_DROPS}', '', 'g') AS pr, regexp_replace(coalesce(spoken, ''), '{_DROPS}', '', 'g') AS b, regexp_replace(coalesce(shown, ''), '{_DROPS}', '', 'g') AS c, coalesce(shown, '') AS visual
  FROM r LEFT JOIN st USING (episode_id, track, region) LEFT JOIN pt USING (episode_id, track, region) LEFT JOIN ctx USING (episode_id, track, region)),
gr AS (SELECT *, length(pr) AS n, length(a) - length(pr) AS gap, {_grams('a')} AS ga, {_grams('b')} AS gb, {_grams('c')} AS gc, {_SQL_HINT.format(t='said')} OR {_SQL_HINT.format(t='visual')} AS nar FROM q),
j AS (SELECT *, {_jaccard('ga', 'gb')} AS sp, {_jaccard('ga', 'gc')} AS vi FROM gr),
cl AS (SELECT episode_id, track, region, start_ms, end_ms, CAST(gap AS INT) AS gap_chars, sp AS spoken_likeness, vi AS visual_likeness,
  CASE WHEN vi >= 0.3 AND vi > sp + 0.08 AND nar THEN 'shown_not_said' WHEN n <= 4 AND nar THEN 'missing_narration' WHEN sp >= 0.18 THEN 'shortened_or_missing' WHEN nar THEN 'missing_narration' ELSE 'spoken_gap' END AS kind,
  CASE WHEN (vi >= 0.3 AND vi > sp + 0.08 AND nar) OR (n <= 4 AND nar) THEN 'high' WHEN sp >= 0.18 OR nar OR n <= 6 THEN 'medium' ELSE 'low' END AS sure FROM j)"""
    + """
SELECT * FROM cl"""
)
def omission_regions(spark: SparkSession, folder: str) -> DataFrame:
    """What the regions that one transcript lacks most likely are, by both texts over the whole region and the lines within a second."""
    keys = ["episode_id", "track", "region"]
    pri, sec = two_transcripts(spark, folder)
    r = windows.merge_windows(_windows(spark, folder), ["episode_id", "track"], 750).select(*keys, "start_ms", "end_ms")

    def said(side: DataFrame, to: str) -> DataFrame:
        met = overlap_join(r, side.withColumn("text", F.trim("text")).filter("length(text) > 0"), ["episode_id", "track"], ("start_ms", "end_ms"), ("s", "e"))
        return met.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "text"))), lambda x: x["text"]), " / ").alias(to))

    lines = segments(spark, folder).filter("text IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL").select("episode_id", "name", "s", "e", F.posexplode(F.split("text", "\n")).alias("pos", "raw")).withColumn("line", F.trim("raw")).filter("line <> ''")
    seen = F.col("line").rlike(_SEEN)
    lines = lines.select("episode_id", "name", "s", "e", "pos", seen.alias("visual"), F.when(seen, F.regexp_extract("line", _SEEN, 1)).otherwise(F.col("line")).alias("said"))
    wide = r.withColumn("a", F.col("start_ms") - 1000).withColumn("z", F.col("end_ms") + 1000)
    near = overlap_join(wide, lines, ["episode_id"], ("a", "z"), ("s", "e"), closed=True).filter("(s < end_ms AND e > start_ms) OR abs(s - start_ms) <= 1000 OR abs(e - end_ms) <= 1000")
    # the first six of each kind, by the least of structs: no window, as a region may meet many lines
    six = lambda v: F.array_join(F.transform(F.slice(F.array_sort(F.collect_list(F.when(F.col("visual") == v, F.struct("s", "name", "pos", "said")))), 1, 6), lambda x: x["said"]), " / ")
    context = near.groupBy(*keys).agg(six(False).alias("spoken"), six(True).alias("visual"))
    x = r.join(said(sec, "said"), keys, "left").join(said(pri, "own"), keys, "left").join(context, keys, "left").fillna("", ["said", "own", "spoken", "visual"])
    # forms and their pairs as columns of their own, so that no pair computes them again
    x = x.withColumns({f"f_{c}": squeeze(c) for c in ("said", "own", "spoken", "visual")})
    x = x.withColumns({f"g_{c}": bigrams(F.col(f"f_{c}")) for c in ("said", "spoken", "visual")})

    def alike(c: str) -> Column:
        both = F.size(F.array_intersect("g_said", c))
        return F.when((F.size("g_said") == 0) | (F.size(c) == 0), 0.0).otherwise(both / (F.size("g_said") + F.size(c) - both))

    x = x.withColumn("spoken_likeness", alike("g_spoken")).withColumn("visual_likeness", alike("g_visual")).withColumn("n", F.length("f_own")).withColumn("gap_chars", F.length("f_said") - F.col("n"))
    kind, sure = omission_class(F.col("n"), F.col("spoken_likeness"), F.col("visual_likeness"), holds_any(F.col("said"), NARRATION) | holds_any(F.col("visual"), NARRATION))
    return x.select(*keys, "start_ms", "end_ms", "gap_chars", "spoken_likeness", "visual_likeness", kind.alias("kind"), sure.alias("sure"))


_RANK = "ORDER BY CASE kind WHEN 'shown_not_said' THEN 0 WHEN 'missing_narration' THEN 1 WHEN 'shortened_or_missing' THEN 2 ELSE 3 END, CASE sure WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, gap_chars DESC, start_ms, episode_id, track, region"


@query(ORACLE["omission_regions"].replace("SELECT * FROM cl", f"SELECT *, CAST(row_number() OVER ({_RANK}) AS INT) AS rank FROM cl {_RANK} LIMIT 30"))
def top_omissions(spark: SparkSession, folder: str) -> DataFrame:
    """The thirty omissions to look at first: by kind, certainty and the characters that are missing."""
    from pyspark.sql import Window

    place = lambda c, *words: F.coalesce(*[F.when(F.col(c) == w, i) for i, w in enumerate(words)], F.lit(len(words)))
    order = [place("kind", "shown_not_said", "missing_narration", "shortened_or_missing"), place("sure", "high", "medium"), F.col("gap_chars").desc(), "start_ms", "episode_id", "track", "region"]
    top = omission_regions(spark, folder).orderBy(*order).limit(30)  # the report's length; the window below sees these rows only
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


@query(
    f"""WITH {CUES}, {SEGMENTS}, p AS (SELECT episode_id, name, s, e, text, regexp_replace(text, '{_DROPS}', '', 'g') AS n FROM seg),
h AS (SELECT * FROM p WHERE length(n) BETWEEN 1 AND 30 AND (regexp_matches(text, '[?？]') OR regexp_matches(n, '[0-9]'))),
c AS (SELECT episode_id, track, seq, s AS cs, e AS ce, coalesce(text, '') AS t1, lead(e) OVER w AS e2, lead(coalesce(text, '')) OVER w AS t2 FROM timed WINDOW w AS (PARTITION BY episode_id, track ORDER BY s, seq)),
u AS (SELECT episode_id, track, seq, 1 AS parts, cs, ce, regexp_replace(t1, '{_DROPS}', '', 'g') AS t FROM c UNION ALL SELECT episode_id, track, seq, 2, cs, e2, regexp_replace(t1 || t2, '{_DROPS}', '', 'g') FROM c WHERE t2 IS NOT NULL),
j AS (SELECT h.episode_id, track, name, n, seq, parts, t, abs(cs - s) AS d FROM h JOIN u ON u.episode_id = h.episode_id AND h.s - 1000 < ce AND h.e + 1000 > cs),
g AS (SELECT *, {_grams('n')} AS ga, {_grams('t')} AS gb FROM j), k AS (SELECT *, {_jaccard('ga', 'gb')} AS alike FROM g),
r AS (SELECT *, row_number() OVER (PARTITION BY episode_id, track, name ORDER BY alike DESC, d, parts, seq) AS rn FROM k)
SELECT episode_id, track, name, seq, parts, alike, CASE WHEN alike < 0.18 THEN 'high' WHEN alike < 0.34 THEN 'medium' ELSE 'low' END AS disagreement FROM r WHERE rn = 1"""
)
def short_disagreements(spark: SparkSession, folder: str) -> DataFrame:
    """Short segments that ask or count, with the run of one or two cues near them that is most alike."""
    from pyspark.sql import Window

    n = squeeze("text")
    p = segments(spark, folder).select("episode_id", "name", "s", (F.col("s") - 1000).alias("a"), (F.col("e") + 1000).alias("z"), "text", n.alias("n"))
    p = p.filter(F.length("n").between(1, 30) & (F.col("text").rlike("[?？]") | F.col("n").rlike("[0-9]"))).drop("text")
    w = Window.partitionBy("episode_id", "track").orderBy("s", "seq")
    c = cues(spark, folder).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("e2", F.lead("e").over(w)).withColumn("t2", F.lead("text").over(w))
    one = c.select("episode_id", "track", "seq", F.lit(1).alias("parts"), F.col("s").alias("cs"), F.col("e").alias("ce"), squeeze("text").alias("t"))
    two = c.filter("t2 IS NOT NULL").select("episode_id", "track", "seq", F.lit(2).alias("parts"), F.col("s").alias("cs"), F.col("e2").alias("ce"), squeeze(F.concat("text", "t2")).alias("t"))
    met = overlap_join(p, one.unionByName(two), ["episode_id"], ("a", "z"), ("cs", "ce")).withColumn("alike", bigram_jaccard(F.col("n"), F.col("t")))
    best = met.groupBy("episode_id", "track", "name").agg(F.min_by(F.struct("seq", "parts", "alike"), F.struct(-F.col("alike"), F.abs(F.col("cs") - F.col("s")), "parts", "seq")).alias("r")).select("episode_id", "track", "name", "r.*")
    return best.withColumn("disagreement", F.when(F.col("alike") < 0.18, "high").when(F.col("alike") < 0.34, "medium").otherwise("low"))
