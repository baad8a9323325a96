"""Queries that join transcripts with their context and sum them up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import squeeze
from ..operators import islands
from ..operators.intervals import overlap_join
from ..operators.ordered import carry_forward
from ..session import table
from .base import CUES, SEGMENTS, cues, segments

QUERIES, ORACLE = {}, {}
_DROPS = "[\\s　、。！？?!…,.，「」『』（）()【】\\[\\]・:：\\-ー]+"
_LABEL = "^(?:[->]+ *)?([^ :：]{1,20}) ?[:：]"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


@query(
    f"""WITH {CUES}, {SEGMENTS}, t AS (SELECT episode_id, s AS ts, e AS te, regexp_extract(text, '{_LABEL}', 1) AS who FROM seg WHERE regexp_matches(text, '{_LABEL}')),
c AS (SELECT episode_id, seq, s, e FROM timed WHERE track = 'sdh' OR track = 'en_sub'),
o AS (SELECT c.episode_id, c.seq, who, CAST(sum(greatest(0, least(e, te) - greatest(s, ts))) AS BIGINT) AS ms, min(ts) AS first FROM c JOIN t ON c.episode_id = t.episode_id AND s < te AND e > ts GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY episode_id, seq ORDER BY ms DESC, first, who) AS rn FROM o)
SELECT episode_id, seq, who, ms FROM r WHERE rn = 1"""
)
def majority_speaker(spark: SparkSession, folder: str) -> DataFrame:
    """The speaker whose labelled segments overlap a cue longest in sum; of equals the one who speaks first."""
    t = segments(spark, folder).filter(F.col("text").rlike(_LABEL)).select("episode_id", F.col("s").alias("ts"), F.col("e").alias("te"), F.regexp_extract("text", _LABEL, 1).alias("who"))
    c = cues(spark, folder).filter("track IN ('sdh', 'en_sub')").select("episode_id", "seq", "s", "e")
    met = overlap_join(c, t, ["episode_id"], ("s", "e"), ("ts", "te")).groupBy("episode_id", "seq", "who").agg(F.sum("overlap_ms").alias("ms"), F.min("ts").alias("first"))
    best = met.groupBy("episode_id", "seq").agg(F.min_by(F.struct("who", "ms"), F.struct(-F.col("ms"), "first", "who")).alias("r"))
    return best.select("episode_id", "seq", "r.who", "r.ms")


@query(
    f"""WITH {CUES}, {SEGMENTS}, a AS (SELECT episode_id, name, row_number() OVER (PARTITION BY episode_id ORDER BY s, name) AS i FROM seg), b AS (SELECT episode_id, seq, row_number() OVER (PARTITION BY episode_id ORDER BY s, seq) AS i FROM timed WHERE track = 'sdh')
SELECT a.episode_id, name, CAST(a.i AS INT) AS i, seq FROM a LEFT JOIN b ON a.episode_id = b.episode_id AND a.i = b.i"""
)
def positional_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The n-th segment of an episode with its n-th labelled cue, whatever their texts."""
    n = lambda df, key: df.withColumn("i", F.row_number().over(Window.partitionBy("episode_id").orderBy("s", key)))
    a = n(segments(spark, folder).select("episode_id", "name", "s"), "name").select("episode_id", "name", "i")
    b = n(cues(spark, folder).filter("track = 'sdh'").select("episode_id", "seq", "s"), "seq").select("episode_id", "seq", "i")
    return a.join(b, ["episode_id", "i"], "left").select("episode_id", "name", "i", "seq")


@query(
    f"""WITH {CUES}, {SEGMENTS}, p AS (SELECT episode_id, name, s AS t FROM seg), c AS (SELECT episode_id, seq, s, e FROM timed WHERE track = 'sdh'),
a AS (SELECT p.episode_id, p.name, t, arg_max(seq, (s, seq)) AS seq, arg_max(e, (s, seq)) AS e, max(s) AS s FROM p JOIN c ON c.episode_id = p.episode_id AND c.s <= t GROUP BY 1, 2, 3),
b AS (SELECT p.episode_id, p.name, arg_min(seq, (s, seq)) AS nseq, arg_min(e, (s, seq)) AS ne, min(s) AS ns FROM p JOIN c ON c.episode_id = p.episode_id AND c.s > t GROUP BY 1, 2)
SELECT p.episode_id, p.name, CASE WHEN a.seq IS NULL THEN nseq WHEN nseq IS NULL OR p.t < a.e THEN a.seq WHEN abs(2 * p.t - a.s - a.e) <= abs(2 * p.t - ns - ne) THEN a.seq ELSE nseq END AS seq
FROM p LEFT JOIN a USING (episode_id, name) LEFT JOIN b USING (episode_id, name) WHERE a.seq IS NOT NULL OR nseq IS NOT NULL"""
)
def cue_at_time(spark: SparkSession, folder: str) -> DataFrame:
    """As-of join: the cue that holds a segment's start, else the one before or after whose middle is nearer."""
    p = segments(spark, folder).select("episode_id", F.col("s").alias("at"), F.lit(1).alias("kind"), F.col("name").alias("k"), F.lit(None).cast("struct<seq:int,s:bigint,e:bigint>").alias("cue")).filter("at IS NOT NULL")
    c = cues(spark, folder).filter("track = 'sdh'").select("episode_id", F.col("s").alias("at"), F.lit(0).alias("kind"), F.lpad(F.col("seq").cast("string"), 12, "0").alias("k"), F.struct(F.col("seq").cast("int").alias("seq"), "s", "e").alias("cue"))
    both = p.unionByName(c).withColumn("block", F.floor(F.col("at") / 600_000))
    before = carry_forward(both, ["episode_id"], "block", ["at", "kind", "k"], "cue", "a").filter("kind = 1").select("episode_id", F.col("k").alias("name"), "at", "a")
    # turned around in time, points first at equal times, so that only later starts follow
    back = both.withColumn("at", -F.col("at")).withColumn("kind", 1 - F.col("kind")).withColumn("block", F.floor(F.col("at") / 600_000)).withColumn("k2", F.when(F.col("kind") == 1, -F.col("cue.seq")).otherwise(0))
    after = carry_forward(back, ["episode_id"], "block", ["at", "kind", "k2", "k"], "cue", "b").filter("kind = 0").select("episode_id", F.col("k").alias("name"), "b")
    x = before.join(after, ["episode_id", "name"])
    far = lambda c: F.abs(2 * F.col("at") - F.col(f"{c}.s") - F.col(f"{c}.e"))
    seq = F.when(F.col("a").isNull(), F.col("b.seq")).when(F.col("b").isNull() | (F.col("at") < F.col("a.e")) | (far("a") <= far("b")), F.col("a.seq")).otherwise(F.col("b.seq"))
    return x.select("episode_id", "name", seq.alias("seq")).filter("seq IS NOT NULL")


@query(
    f"""WITH {CUES}, c AS (SELECT episode_id, track, seq, s, e, text FROM timed WHERE length(text) > 0), r AS (
  SELECT a.episode_id, a.track, a.seq, b.seq AS twin, row_number() OVER (PARTITION BY a.episode_id, a.track, a.seq ORDER BY abs(b.s - a.s), abs(b.e - a.e), b.seq) AS rn FROM c a JOIN c b ON a.episode_id = b.episode_id AND a.track = b.track AND a.text = b.text AND a.seq <> b.seq)
SELECT episode_id, track, seq, twin FROM r WHERE rn = 1"""
)
def nearest_twin(spark: SparkSession, folder: str) -> DataFrame:
    """The other cue of equal text that is nearest in time. Neighbours in order of time are the only candidates."""
    c = cues(spark, folder).filter("length(text) > 0")
    # cues that start together are candidates alike, so a group's both neighbours by start are looked at whole
    g = c.groupBy("episode_id", "track", "text", "s").agg(F.array_sort(F.collect_list(F.struct("e", "seq"))).alias("own"))
    ws = Window.partitionBy("episode_id", "track", "text").orderBy("s")
    g = g.withColumn("near", F.concat(*[F.transform(F.coalesce(F.lag("own", d).over(ws) if d else F.col("own"), F.array().cast("array<struct<e:bigint,seq:int>>")), lambda x, d=d: F.struct(x["e"].alias("e"), x["seq"].alias("seq"), F.lit(d).alias("d"))) for d in (1, 0, -1)]))
    g = g.withColumn("ps", F.lag("s").over(ws)).withColumn("ns", F.lag("s", -1).over(ws))
    one = g.select("episode_id", "track", "s", "ps", "ns", "near", F.explode("own").alias("o"))
    start = lambda x: F.when(x["d"] == 1, F.col("ps")).when(x["d"] == -1, F.col("ns")).otherwise(F.col("s"))
    ranked = F.array_min(F.transform(F.filter("near", lambda x: x["seq"] != F.col("o.seq")), lambda x: F.struct(F.abs(start(x) - F.col("s")).alias("a"), F.abs(x["e"] - F.col("o.e")).alias("b"), x["seq"].alias("seq"))))
    return one.select("episode_id", "track", F.col("o.seq").alias("seq"), ranked.alias("r")).filter("r IS NOT NULL").select("episode_id", "track", "seq", F.col("r.seq").alias("twin"))


@query(
    f"""WITH {SEGMENTS}, t AS (SELECT episode_id, name, s, e, text, CASE WHEN regexp_matches(text, '{_LABEL}') THEN regexp_extract(text, '{_LABEL}', 1) ELSE '' END AS who FROM seg),
o AS (SELECT *, lag(who) OVER (PARTITION BY episode_id ORDER BY s, name) AS p FROM t), g AS (SELECT *, sum(CASE WHEN p = who THEN 0 ELSE 1 END) OVER (PARTITION BY episode_id ORDER BY s, name ROWS UNBOUNDED PRECEDING) AS run FROM o)
SELECT episode_id, CAST(run AS BIGINT) AS turn, min(who) AS who, min(s) AS s, max(e) AS e, count(*) AS segments, string_agg(text, ' ' ORDER BY s, name) AS text FROM g GROUP BY 1, 2"""
)
def label_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of segments under one label: span, count and joined text."""
    t = segments(spark, folder).withColumn("who", F.when(F.col("text").rlike(_LABEL), F.regexp_extract("text", _LABEL, 1)).otherwise("")).withColumn("block", F.floor(F.col("s") / 600_000))
    own = islands.runs(t, ["episode_id"], "block", ["s", "name"], "who")
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s", "name", "text"))), lambda x: x["text"]), " ")
    return own.groupBy("episode_id", F.col("run").alias("turn")).agg(F.min("who").alias("who"), F.min("s").alias("s"), F.max("e").alias("e"), F.count(F.lit(1)).alias("segments"), said.alias("text"))


@query(
    f"""WITH {CUES}, k AS (SELECT episode_id, track, (s + e) // 2 // 60000 AS minute, length(regexp_replace(coalesce(text, ''), '{_DROPS}', '', 'g')) AS n FROM timed WHERE s >= 0)
SELECT episode_id, track, minute, count(*) AS cues, CAST(sum(n) AS BIGINT) AS chars FROM k GROUP BY 1, 2, 3"""
)
def chars_per_minute(spark: SparkSession, folder: str) -> DataFrame:
    """Characters in each minute, by the middle of the cues."""
    k = cues(spark, folder).filter("s >= 0").select("episode_id", "track", F.floor(F.floor((F.col("s") + F.col("e")) / 2) / 60_000).alias("minute"), F.length(squeeze("text")).alias("n"))
    return k.groupBy("episode_id", "track", "minute").agg(F.count(F.lit(1)).alias("cues"), F.sum("n").alias("chars"))


@query(f"WITH {CUES}, i AS (SELECT episode_id, track, seq, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY episode_id, track) AS n FROM timed WINDOW w AS (PARTITION BY episode_id, track ORDER BY s, seq)) SELECT episode_id, track, seq, CAST(i AS INT) AS i FROM i WHERE i = 0 OR i = n // 2 OR i = n - 1")
def three_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The first, middle and last cue of each track."""
    w = Window.partitionBy("episode_id", "track")
    i = cues(spark, folder).select("episode_id", "track", "seq", (F.row_number().over(w.orderBy("s", "seq")) - 1).alias("i"), F.count(F.lit(1)).over(w).alias("n"))
    return i.filter("i = 0 OR i = floor(n / 2) OR i = n - 1").select("episode_id", "track", "seq", "i")


@query(
    """WITH l AS (SELECT doc_id, CAST(unnest(range(1, len(p) + 1)) AS INT) AS line_no, unnest(p) AS line, len(p) AS n FROM (SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: length(trim(x, ' ')) > 0) AS p FROM documents)),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY line_no) AS times FROM l) SELECT doc_id, CAST(max(n) AS INT) AS lines, count(*) AS kept FROM r WHERE n < 10 OR times < 5 GROUP BY 1"""
)
def fewer_repeated_lines(spark: SparkSession, folder: str) -> DataFrame:
    """How many lines of a document stay if the fifth and later repeats go, in documents of ten lines or more."""
    l = table(spark, folder, "documents").select("doc_id", F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.length(F.trim(x)) > 0).alias("p")).select("doc_id", F.size("p").alias("n"), F.posexplode("p").alias("at", "line"))  # noqa: E741
    times = l.groupBy("doc_id", "n", F.xxhash64("line").alias("h"), "line").agg(F.count(F.lit(1)).alias("c"))
    kept = F.when(F.col("n") < 10, F.col("c")).otherwise(F.least(F.col("c"), F.lit(4)))
    return times.groupBy("doc_id").agg(F.max("n").alias("lines"), F.sum(kept).alias("kept"))


@query(
    f"""WITH {CUES}, t AS (SELECT track, CASE WHEN e < s THEN 'negative' WHEN e - s < 500 THEN 'micro' WHEN e - s < 800 THEN 'short' ELSE 'fine' END AS class FROM timed),
d AS (SELECT track, class FROM (SELECT DISTINCT track FROM timed), (VALUES ('negative'), ('micro'), ('short'), ('fine')) v(class))
SELECT d.track, d.class, count(t.class) AS cues FROM d LEFT JOIN t ON t.track = d.track AND t.class = d.class GROUP BY 1, 2"""
)
def class_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Cues by track and class of duration, with zeros for classes that don't occur."""
    ms = F.col("e") - F.col("s")
    own = cues(spark, folder).select("track", F.when(ms < 0, "negative").when(ms < 500, "micro").when(ms < 800, "short").otherwise("fine").alias("class")).groupBy("track", "class").agg(F.count(F.lit(1)).alias("cues"))
    every = own.select("track").distinct().withColumn("class", F.explode(F.array(*map(F.lit, ("negative", "micro", "short", "fine")))))
    return every.join(own, ["track", "class"], "left").fillna(0, ["cues"])


@query(
    f"""WITH {SEGMENTS}, k AS (SELECT episode_id, name, text, (SELECT any_value(kata) FROM segments x WHERE x.episode_id = seg.episode_id AND x.name = seg.name AND x.kata IS NOT NULL) AS kata FROM seg),
h AS (SELECT episode_id, len(list_filter(coalesce(kata, []), lambda x: contains(text, x))) AS hits, len(coalesce(kata, [])) AS terms FROM k)
SELECT episode_id, CAST(sum(hits) AS BIGINT) AS hits, CAST(sum(terms) AS BIGINT) AS terms, CAST(CASE WHEN sum(terms) > 0 THEN sum(hits) * 1000 // sum(terms) END AS BIGINT) AS per_mille FROM h GROUP BY 1"""
)
def term_recall(spark: SparkSession, folder: str) -> DataFrame:
    """How many of the listed terms the segments of an episode hold."""
    kata = table(spark, folder, "segments").filter("kata IS NOT NULL").groupBy("episode_id", "name").agg(F.first("kata").alias("kata"))
    k = segments(spark, folder).select("episode_id", "name", "text").join(kata, ["episode_id", "name"], "left").withColumn("kata", F.coalesce("kata", F.array().cast("array<string>")))
    h = k.select("episode_id", F.size(F.filter("kata", lambda x: F.contains(F.col("text"), x))).alias("hits"), F.size("kata").alias("terms"))
    return h.groupBy("episode_id").agg(F.sum("hits").alias("hits"), F.sum("terms").alias("terms")).withColumn("per_mille", F.when(F.col("terms") > 0, F.floor(F.col("hits") * 1000 / F.col("terms"))))


@query(
    f"""WITH {CUES}, {SEGMENTS}, k AS (SELECT DISTINCT episode_id, name, CAST(unnest(range(0, len(kata))) AS INT) AS idx, unnest(kata) AS term FROM segments WHERE kata IS NOT NULL),
sp AS (SELECT k.episode_id, term, greatest(1, 16 - 2 * idx) AS weight2, s - 2000 AS a, e + 2000 AS z FROM k JOIN seg USING (episode_id, name)),
c AS (SELECT episode_id, seq, s, e FROM timed WHERE track = 'sdh'), j AS (SELECT c.episode_id, c.seq, term, CAST(sum(weight2) AS BIGINT) AS score2 FROM c JOIN sp ON sp.episode_id = c.episode_id AND s < z AND e > a GROUP BY 1, 2, 3),
r AS (SELECT *, row_number() OVER (PARTITION BY episode_id, seq ORDER BY score2 DESC, term) AS rank FROM j) SELECT episode_id, seq, term, score2, CAST(rank AS INT) AS rank FROM r WHERE rank <= 5"""
)
def context_terms(spark: SparkSession, folder: str) -> DataFrame:
    """The five terms that weigh most around each cue: terms of segments within 2 s, weighted by their place."""
    k = table(spark, folder, "segments").filter("kata IS NOT NULL").select("episode_id", "name", F.posexplode("kata").alias("idx", "term")).distinct()
    spans = k.join(segments(spark, folder).select("episode_id", "name", "s", "e"), ["episode_id", "name"]).select("episode_id", "term", F.greatest(F.lit(1), 16 - 2 * F.col("idx")).alias("weight2"), (F.col("s") - 2000).alias("a"), (F.col("e") + 2000).alias("z"))
    c = cues(spark, folder).filter("track = 'sdh'").select("episode_id", "seq", "s", "e")
    j = overlap_join(c, spans, ["episode_id"], ("s", "e"), ("a", "z")).groupBy("episode_id", "seq", "term").agg(F.sum("weight2").alias("score2"))
    return j.withColumn("rank", F.row_number().over(Window.partitionBy("episode_id", "seq").orderBy(F.col("score2").desc(), "term"))).filter("rank <= 5")


@query(
    f"""WITH {CUES}, b AS (SELECT *, (row_number() OVER (PARTITION BY episode_id, track ORDER BY s, seq) - 1) // 50 AS batch FROM timed)
SELECT episode_id, track, CAST(batch AS BIGINT) AS batch, count(*) AS cues, CAST(sum(CASE WHEN text IS NULL OR text = '' THEN 1 ELSE 0 END) AS BIGINT) AS blank, bool_or(e <= s) AS any_fault, CAST(sum(length(coalesce(text, ''))) AS BIGINT) AS chars FROM b GROUP BY 1, 2, 3"""
)
def batch_diagnostics(spark: SparkSession, folder: str) -> DataFrame:
    """Sums over batches of 50 cues."""
    b = cues(spark, folder).withColumn("batch", F.floor((F.row_number().over(Window.partitionBy("episode_id", "track").orderBy("s", "seq")) - 1) / 50))
    return b.groupBy("episode_id", "track", "batch").agg(
        F.count(F.lit(1)).alias("cues"), F.sum(F.when(F.col("text").isNull() | (F.col("text") == ""), 1).otherwise(0)).alias("blank"), F.bool_or(F.col("e") <= F.col("s")).alias("any_fault"), F.sum(F.length(F.coalesce("text", F.lit("")))).alias("chars")
    )


@query("SELECT DISTINCT episode_id, first_value(entry_id) OVER (PARTITION BY episode_id, trim(source, ' ') ORDER BY entry_id) AS entry_id, trim(source, ' ') AS term FROM glossary_entries WHERE is_hotword AND trim(source, ' ') <> ''")
def hotwords(spark: SparkSession, folder: str) -> DataFrame:
    """The flagged terms of an episode, each once, by where it comes first."""
    h = table(spark, folder, "glossary_entries").filter("is_hotword").withColumn("term", F.trim("source")).filter("term <> ''")
    return h.groupBy("episode_id", "term").agg(F.min("entry_id").alias("entry_id"))


@query(f"WITH {CUES} SELECT episode_id, track, seq, unnest(['start', 'mid', 'end']) AS kind, unnest([s, (s + e) // 2, e]) AS at_ms FROM timed WHERE s <= e AND s >= 0")
def keyframe_times(spark: SparkSession, folder: str) -> DataFrame:
    """Three times of each cue at which to take a frame."""
    c = cues(spark, folder).filter("s <= e AND s >= 0")
    return c.select("episode_id", "track", "seq", F.expr("stack(3, 'start', s, 'mid', CAST(floor((s + e) / 2) AS BIGINT), 'end', e) AS (kind, at_ms)"))


@query(
    f"""WITH {CUES}, o AS (SELECT episode_id, track, s, e, text, lag(e) OVER (PARTITION BY episode_id, track ORDER BY s, seq) AS p FROM timed), g AS (SELECT episode_id, track, p AS a, s AS z FROM o WHERE s - p >= 4000),
c AS (SELECT episode_id, track, seq, s, e, text FROM timed WHERE length(text) > 0 AND s <= e)
SELECT g.episode_id, g.track, a AS gap_start, z AS gap_end, CAST(count(*) FILTER (c.e <= a) AS BIGINT) AS before, CAST(count(*) FILTER (c.s >= z) AS BIGINT) AS after, arg_max(text, (c.e, c.seq)) FILTER (c.e <= a) AS last_before
FROM g JOIN c ON c.episode_id = g.episode_id AND c.track = g.track AND ((c.s >= a - 30000 AND c.e <= a) OR (c.s >= z AND c.e <= z + 30000)) GROUP BY 1, 2, 3, 4"""
)
def around_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """What lies wholly within 30 s before and after each silence of 4 s."""
    own = cues(spark, folder)
    gaps = islands.gaps(own, ["episode_id", "track"], "s", "e", ["s", "seq"], 4_000).select("episode_id", "track", "gap_start", "gap_end", (F.col("gap_start") - 30_000).alias("a"), (F.col("gap_end") + 30_000).alias("z"))
    c = own.filter("length(text) > 0 AND s <= e").select("episode_id", "track", "seq", "s", "e", "text")
    met = overlap_join(gaps, c, ["episode_id", "track"], ("a", "z"), ("s", "e"), 30_000, closed=True)
    before, after = (F.col("s") >= F.col("a")) & (F.col("e") <= F.col("gap_start")), (F.col("s") >= F.col("gap_end")) & (F.col("e") <= F.col("z"))
    met = met.withColumn("x", before).filter(before | after)
    both = met.filter("x OR s >= gap_end")
    return both.groupBy("episode_id", "track", "gap_start", "gap_end").agg(
        F.count(F.when(F.col("e") <= F.col("gap_start"), 1)).alias("before"), F.count(F.when(F.col("s") >= F.col("gap_end"), 1)).alias("after"),
        F.max_by("text", F.when(F.col("e") <= F.col("gap_start"), F.struct("e", "seq"))).alias("last_before"),
    )


@query(
    f"""WITH {CUES}, {SEGMENTS}, p AS (SELECT episode_id, seq, s, e FROM timed WHERE track = 'sdh'), a AS (SELECT episode_id, s AS x, min(ws) AS y FROM seg WHERE s IS NOT NULL AND ws IS NOT NULL GROUP BY 1, 2),
b AS (SELECT p.episode_id, p.seq, p.s, max(x) FILTER (x <= p.s) AS x0, arg_max(y, x) FILTER (x <= p.s) AS y0, min(x) FILTER (x > p.s) AS x1, arg_min(y, x) FILTER (x > p.s) AS y1 FROM p JOIN a ON a.episode_id = p.episode_id GROUP BY 1, 2, 3)
SELECT episode_id, seq, CAST(CASE WHEN x0 IS NULL THEN y1 WHEN x1 IS NULL THEN y0 ELSE y0 + ((y1 - y0) * (s - x0)) // (x1 - x0) END AS BIGINT) AS mapped FROM b"""
)
def piecewise_times(spark: SparkSession, folder: str) -> DataFrame:
    """Times mapped along straight lines between anchors, and held beyond the first and last."""
    p = cues(spark, folder).filter("track = 'sdh'").select("episode_id", "seq", "s")
    anchor = segments(spark, folder).filter("s IS NOT NULL AND ws IS NOT NULL").groupBy("episode_id", "s").agg(F.min("ws").alias("y"))
    ev = anchor.select("episode_id", F.col("s").alias("at"), F.lit(0).alias("kind"), F.lit(-1).alias("seq"), F.struct(F.col("s").alias("x"), "y").alias("v"))
    pts = p.select("episode_id", F.col("s").alias("at"), F.lit(1).alias("kind"), F.col("seq").cast("int").alias("seq"), F.lit(None).cast("struct<x:bigint,y:bigint>").alias("v"))
    both = ev.unionByName(pts)
    fore = carry_forward(both.withColumn("block", F.floor(F.col("at") / 600_000)), ["episode_id"], "block", ["at", "kind", "seq"], "v", "a").filter("kind = 1")
    back = both.withColumn("at", -F.col("at")).withColumn("kind", 1 - F.col("kind"))
    aft = carry_forward(back.withColumn("block", F.floor(F.col("at") / 600_000)), ["episode_id"], "block", ["at", "kind", "seq"], "v", "b").filter("kind = 0")
    x = fore.select("episode_id", "seq", "at", "a").join(aft.select("episode_id", "seq", "b"), ["episode_id", "seq"])
    line = F.expr("a.y + (b.y - a.y) * (at - a.x) DIV (b.x - a.x)")
    return x.select("episode_id", "seq", F.when(F.col("a").isNull(), F.col("b.y")).when(F.col("b").isNull(), F.col("a.y")).otherwise(line).cast("long").alias("mapped")).filter("mapped IS NOT NULL")
