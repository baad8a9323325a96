"""Queries on reviews of cues: diagnostics, borders, regions, comparisons, batches and what is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import predicates as p
from ..functions.rules import vocab_share
from ..functions.text import char_counts
from ..operators import islands, segment
from ..operators.intervals import best_overlap, overlap_join
from ..operators.ordered import running_sum
from ..operators.quality import cue_flags
from ..operators.review import boundary_marks, neighbours, positions, take_done, time_at_offset, timing_faults
from ..session import table
from .base import CUES, SEGMENTS, cues, segments
from .sequence import ORACLE as SEQUENCE
from .text import _FLAGS, _WS, repair_regions

QUERIES, ORACLE = {}, {}
_LABEL = "^(?:[->]+ *)?([^ :：]{1,20}) ?[:：]"


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return register


def _spaced(t: str) -> str:
    return f"length(regexp_replace(replace(coalesce({t}, ''), chr(10), ' '), '^{_WS}|{_WS}$', '', 'g'))"


def _compact(t: str) -> str:
    return f"length(regexp_replace(coalesce({t}, ''), '{_WS}', '', 'g'))"


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    return cues(spark, folder).withColumn("block", F.floor(F.col("s") / 600_000))


@query(
    f"""WITH {CUES}, a AS (SELECT * FROM timed WHERE track = 'ja_asr'), b AS (SELECT episode_id, seq, text FROM cue WHERE track = 'en_sub')
SELECT a.episode_id, a.seq, greatest(1, e - s) AS duration_ms, CAST({_spaced('a.text')} AS INT) AS source_chars, CAST({_spaced('coalesce(nullif(b.text, $$$$), a.text)')} AS INT) AS translated_chars,
  {_spaced('a.text')} * 1000.0::DOUBLE / greatest(1, e - s) AS source_cps, {_spaced('coalesce(nullif(b.text, $$$$), a.text)')} * 1000.0::DOUBLE / greatest(1, e - s) AS translated_cps, coalesce(b.text, '') = '' AS fallback FROM a LEFT JOIN b USING (episode_id, seq)"""
)
def cue_diagnostics(spark: SparkSession, folder: str) -> DataFrame:
    """Japanese cues beside the English ones of their number: characters, reading speeds, and where the source stands in."""
    every = cues(spark, folder, timed=False)
    a = every.filter("track = 'ja_asr' AND s IS NOT NULL AND e IS NOT NULL")
    b = every.filter("track = 'en_sub'").select("episode_id", "seq", F.nullif("text", F.lit("")).alias("other"))
    x = a.join(b, ["episode_id", "seq"], "left").withColumn("final", F.coalesce("other", "text"))
    ms = F.greatest(F.lit(1), F.col("e") - F.col("s"))
    n, m = char_counts("text")["chars_spaced"], char_counts("final")["chars_spaced"]
    return x.select("episode_id", "seq", ms.alias("duration_ms"), n.alias("source_chars"), m.alias("translated_chars"), (n * F.lit(1000.0) / ms).alias("source_cps"), (m * F.lit(1000.0) / ms).alias("translated_cps"), F.col("other").isNull().alias("fallback"))


@query(f"WITH {CUES}, c AS (SELECT *, greatest(1, e - s) AS ms, {_spaced('text')} AS n FROM timed) SELECT episode_id, track, seq, ms AS duration_ms, CAST(n AS INT) AS chars, ms * 20 // 1000 AS max_chars FROM c WHERE n * 1000 > 20 * ms")
def cps_overruns(spark: SparkSession, folder: str) -> DataFrame:
    """Cues read faster than 20 characters a second, and how many characters their time allows."""
    c = cues(spark, folder).withColumn("duration_ms", F.greatest(F.lit(1), F.col("e") - F.col("s"))).withColumn("chars", char_counts("text")["chars_spaced"])
    return c.filter("chars * 1000 > 20 * duration_ms").select("episode_id", "track", "seq", "duration_ms", "chars", F.floor(F.col("duration_ms") * 20 / 1000).alias("max_chars"))


_FLAT = "replace(coalesce({t}, ''), chr(10), '')"
_MARKS = f"""{CUES}, n AS (SELECT episode_id, track, seq, s, e, {_FLAT.format(t='text')} AS t, lag({_FLAT.format(t='text')}) OVER w AS pt, lead({_FLAT.format(t='text')}) OVER w AS nt, {_compact('text')} AS c, lead({_compact('text')}) OVER w AS nc FROM timed WINDOW w AS (PARTITION BY episode_id, track ORDER BY s, seq)),
sp AS (SELECT *, coalesce(t <> '' AND nt <> '' AND NOT regexp_matches(t, '{p.ENDED}') AND regexp_matches(t, '{p.LETTER}$') AND regexp_matches(nt, '^{p.LETTER}'), false) AS sn,
  coalesce(pt <> '' AND t <> '' AND NOT regexp_matches(pt, '{p.ENDED}') AND regexp_matches(pt, '{p.LETTER}$') AND regexp_matches(t, '^{p.LETTER}'), false) AS sv FROM n),
fr AS (SELECT *, t <> '' AND (length(t) <= 2 OR (length(t) <= 4 AND NOT regexp_matches(t, '{p.ENDED}')) OR (sn AND (length(t) <= 10 OR coalesce(nc, 0) <= 10)) OR (sv AND length(t) <= 10)) AS fragment FROM sp),
mk AS (SELECT episode_id, track, seq, s, fragment, e - s < 800 OR c <= 4 OR fragment AS is_short, e - s > 6500 OR c > 42 AS is_long FROM fr)"""


def _marks(spark: SparkSession, folder: str) -> DataFrame:
    return boundary_marks(neighbours(_blocks(spark, folder), ["episode_id", "track"], "block", ["s", "seq"], ["text"]), "s", "e", "text")


@query(f"WITH {_MARKS} SELECT episode_id, track, seq, fragment, is_short, is_long FROM mk")
def fragment_marks(spark: SparkSession, folder: str) -> DataFrame:
    """Which cues are fragments of a sentence, short or long."""
    return _marks(spark, folder).select("episode_id", "track", "seq", "fragment", "is_short", "is_long")


@query(
    f"""WITH {_MARKS}, o AS (SELECT *, lag(is_short) OVER (PARTITION BY episode_id, track ORDER BY s, seq) AS before FROM mk), g AS (SELECT *, sum(CASE WHEN before = is_short THEN 0 ELSE 1 END) OVER (PARTITION BY episode_id, track ORDER BY s, seq ROWS UNBOUNDED PRECEDING) AS run FROM o)
SELECT episode_id, track, CAST(run AS BIGINT) AS run, count(*) AS cues, min(seq) AS first_seq, least(count(*), 4) AS joined FROM g WHERE is_short GROUP BY 1, 2, 3"""
)
def short_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of short cues, and how many of each a repair joins at once."""
    own = islands.runs(_marks(spark, folder), ["episode_id", "track"], "block", ["s", "seq"], "is_short").filter("is_short")
    return own.groupBy("episode_id", "track", "run").agg(F.count(F.lit(1)).alias("cues"), F.min("seq").alias("first_seq"), F.least(F.count(F.lit(1)), F.lit(4)).alias("joined"))


@query(
    f"""WITH {_FLAGS}, i AS (SELECT *, row_number() OVER w AS i FROM fl WINDOW w AS (PARTITION BY episode_id, track ORDER BY s, seq)), rg AS ({{regions}})
SELECT r.episode_id, r.track, r.region_id, count(*) AS cues, count(*) FILTER (short) AS short, count(*) FILTER (tiny) AS tiny, count(*) FILTER (e - s < 1000) AS under_1_s, count(*) FILTER (empty) AS empty, count(*) FILTER (non_terminal) AS non_terminal
FROM rg r JOIN i ON i.episode_id = r.episode_id AND i.track = r.track AND i.i BETWEEN start_cue_id AND end_cue_id GROUP BY 1, 2, 3"""
)
def region_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """What the cues of each repair region are: how many short, tiny, empty, without a final mark."""
    keys = ["episode_id", "track"]
    flags = cue_flags("s", "e", "text")
    rows = positions(_blocks(spark, folder), keys, "block", ["s", "seq"]).select(*keys, "i", (F.col("e") - F.col("s") < 1000).alias("fast"), *[flags[k].alias(k) for k in ("short", "tiny", "empty", "non_terminal")])
    regions = repair_regions(spark, folder)
    own = overlap_join(regions, rows.withColumn("i2", F.col("i")), keys, ("start_cue_id", "end_cue_id"), ("i", "i2"), 50, closed=True)
    n = lambda c, to: F.count(F.when(F.col(c), 1)).alias(to)
    return own.groupBy(*keys, "region_id").agg(F.count(F.lit(1)).alias("cues"), n("short", "short"), n("tiny", "tiny"), n("fast", "under_1_s"), n("empty", "empty"), n("non_terminal", "non_terminal"))


def _regions_sql() -> str:
    from .text import ORACLE as TEXT

    sql = TEXT["repair_regions"].split("FROM fl WINDOW", 1)
    head = sql[0][sql[0].rindex("i AS (SELECT") :]
    rest = (head + "FROM fl WINDOW" + sql[1]).replace("i AS (SELECT", "i2 AS (SELECT", 1).replace("FROM i ", "FROM i2 ").replace("FROM i\n", "FROM i2\n").replace("FROM i WHERE", "FROM i2 WHERE").replace(" i.", " i2.").replace("(i.", "(i2.").replace("SELECT i2.episode_id, i2.track, i2.i,", "SELECT i2.episode_id, i2.track, i2.i,")
    return "WITH " + rest


ORACLE["region_metrics"] = ORACLE["region_metrics"].replace("{regions}", _regions_sql())


@query(
    f"""WITH {CUES}, {SEGMENTS}, j AS (SELECT g.episode_id, name AS seg, g.text AS a, c.text AS b, seq, row_number() OVER (PARTITION BY g.episode_id, name ORDER BY least(g.e, c.e) - greatest(g.s, c.s) DESC, seq) AS rn FROM seg g JOIN timed c ON c.track = 'sdh' AND g.episode_id = c.episode_id AND g.s < c.e AND g.e > c.s AND least(g.e, c.e) > greatest(g.s, c.s)),
q AS (SELECT episode_id, seg, seq, a AS ta, b AS tb, regexp_replace(coalesce(a, ''), '[\\s　、。！？?!…,.，「」『』（）()【】\\[\\]・:：\\-ー～〜]+', '', 'g') AS an, regexp_replace(coalesce(b, ''), '[\\s　、。！？?!…,.，「」『』（）()【】\\[\\]・:：\\-ー～〜]+', '', 'g') AS bn FROM j WHERE rn = 1),
ca AS (SELECT episode_id, seg, ch, count(*) AS n FROM (SELECT episode_id, seg, unnest(string_split(an, '')) AS ch FROM q WHERE an <> '') GROUP BY 1, 2, 3), cb AS (SELECT episode_id, seg, ch, count(*) AS n FROM (SELECT episode_id, seg, unnest(string_split(bn, '')) AS ch FROM q WHERE bn <> '') GROUP BY 1, 2, 3),
sh AS (SELECT episode_id, seg, CAST(sum(least(ca.n, cb.n)) AS BIGINT) AS shared FROM ca JOIN cb USING (episode_id, seg, ch) GROUP BY 1, 2)
SELECT q.episode_id, q.seg, q.seq, CAST(length(an) AS INT) AS a_chars, CAST(length(bn) AS INT) AS b_chars, CAST(length(bn) - length(an) AS INT) AS char_delta, coalesce(shared, 0) AS shared_chars, substr(coalesce(ta, ''), 1, 300) AS a_sample, substr(coalesce(tb, ''), 1, 300) AS b_sample FROM q LEFT JOIN sh USING (episode_id, seg)"""
)
def pair_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Each segment beside the labelled cue it overlaps longest: sizes, and the characters they share as bags."""
    seg = segments(spark, folder).select("episode_id", F.col("name").alias("seg"), "s", "e", F.col("text").alias("a"))
    cue = cues(spark, folder).filter("track = 'sdh'").select("episode_id", "seq", F.col("s").alias("cs"), F.col("e").alias("ce"), F.col("text").alias("b"))
    drop = "[\\s　、。！？?!…,.，「」『』（）()【】\\[\\]・:：\\-ー～〜]+"
    q = best_overlap(seg, cue, ["episode_id"], ["seg"], ("s", "e"), ("cs", "ce"), ["seq"])
    q = q.withColumn("an", F.regexp_replace(F.coalesce("a", F.lit("")), drop, "")).withColumn("bn", F.regexp_replace(F.coalesce("b", F.lit("")), drop, ""))
    # both texts stand in one row, so the bags are compared there: the sum of the lesser counts
    letters = lambda c: F.filter(F.split(c, ""), lambda x: F.length(x) > 0)
    count = lambda c, x: F.length(F.col(c)) - F.length(F.replace(F.col(c), x, F.lit("")))
    shared = F.aggregate(F.array_intersect(letters("an"), letters("bn")), F.lit(0).cast("long"), lambda t, x: t + F.least(count("an", x) / F.length(x), count("bn", x) / F.length(x)).cast("long"))
    return q.select("episode_id", "seg", "seq", F.length("an").alias("a_chars"), F.length("bn").alias("b_chars"), (F.length("bn") - F.length("an")).alias("char_delta"), shared.alias("shared_chars"), F.substring(F.coalesce("a", F.lit("")), 1, 300).alias("a_sample"), F.substring(F.coalesce("b", F.lit("")), 1, 300).alias("b_sample"))


@query(
    "WITH pc AS (" + ORACLE["pair_comparison"] + ") SELECT episode_id, count(*) AS pairs, CAST(sum(a_chars) AS BIGINT) AS a_chars, CAST(sum(b_chars) AS BIGINT) AS b_chars, CAST(CASE WHEN sum(a_chars) > 0 THEN sum(b_chars) * 1000 // sum(a_chars) END AS BIGINT) AS b_per_mille, CAST(CASE WHEN sum(a_chars) > 0 THEN sum(shared_chars) * 1000 // sum(a_chars) END AS BIGINT) AS shared_per_mille FROM pc GROUP BY 1"
)
def comparison_summary(spark: SparkSession, folder: str) -> DataFrame:
    """An episode's comparison in sums; a share of nothing is null."""
    s = pair_comparison(spark, folder).groupBy("episode_id").agg(F.count(F.lit(1)).alias("pairs"), F.sum("a_chars").alias("a_chars"), F.sum("b_chars").alias("b_chars"), F.sum("shared_chars").alias("n"))
    share = lambda c: F.when(F.col("a_chars") > 0, F.floor(F.col(c) * 1000 / F.col("a_chars")))
    return s.select("episode_id", "pairs", "a_chars", "b_chars", share("b_chars").alias("b_per_mille"), share("n").alias("shared_per_mille"))


@query(
    f"""WITH {SEGMENTS}, t AS (SELECT episode_id, name, s, e, CASE WHEN regexp_matches(text, '{_LABEL}') THEN regexp_extract(text, '{_LABEL}', 1) ELSE '' END AS who FROM seg), o AS (SELECT *, lag(who) OVER (PARTITION BY episode_id ORDER BY s, name) AS b FROM t),
g AS (SELECT *, sum(CASE WHEN b = who THEN 0 ELSE 1 END) OVER (PARTITION BY episode_id ORDER BY s, name ROWS UNBOUNDED PRECEDING) AS run FROM o), r AS (SELECT episode_id, run, min(who) AS who, max(e) - min(s) AS ms, count(*) AS n FROM g GROUP BY 1, 2)
SELECT episode_id, who, count(*) AS turns, CAST(sum(ms) AS BIGINT) AS total_ms, CAST(sum(n) AS BIGINT) AS segments FROM r GROUP BY 1, 2"""
)
def speaker_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Turns, time and segments of each label of an episode."""
    t = segments(spark, folder).withColumn("who", F.when(F.col("text").rlike(_LABEL), F.regexp_extract("text", _LABEL, 1)).otherwise("")).withColumn("block", F.floor(F.col("s") / 600_000))
    r = islands.runs(t, ["episode_id"], "block", ["s", "name"], "who").groupBy("episode_id", "run").agg(F.min("who").alias("who"), (F.max("e") - F.min("s")).alias("ms"), F.count(F.lit(1)).alias("n"))
    return r.groupBy("episode_id", "who").agg(F.count(F.lit(1)).alias("turns"), F.sum("ms").alias("total_ms"), F.sum("n").alias("segments"))


@query(
    f"""WITH bt AS ({SEQUENCE['cue_batches']}), {CUES}, o AS (SELECT episode_id, track, seq, row_number() OVER (PARTITION BY episode_id, track ORDER BY s, seq) AS i FROM timed)
SELECT bt.episode_id, bt.track, bt.batch, list(seq ORDER BY i) FILTER (i < first_cue) AS before, list(seq ORDER BY i) FILTER (i > last_cue) AS after FROM bt JOIN o ON o.episode_id = bt.episode_id AND o.track = bt.track AND ((i >= first_cue - 2 AND i < first_cue) OR (i > last_cue AND i <= last_cue + 2)) GROUP BY 1, 2, 3"""
)
def batch_context(spark: SparkSession, folder: str) -> DataFrame:
    """The two cues before and after each batch; a batch that is a whole track has none and no row."""
    batches = segment.by_group(cues(spark, folder), ["episode_id", "track"], ["s", "seq"], segment.batches(), segment.BATCH_COLUMNS)
    rows = positions(_blocks(spark, folder), ["episode_id", "track"], "block", ["s", "seq"]).select("episode_id", "track", "seq", F.col("i").cast("int").alias("i"))
    near = batches.select("episode_id", "track", "batch", F.explode(F.expr("array(named_struct('i', first_cue - 2, 'x', true), named_struct('i', first_cue - 1, 'x', true), named_struct('i', last_cue + 1, 'x', false), named_struct('i', last_cue + 2, 'x', false))")).alias("r")).select("episode_id", "track", "batch", "r.*")
    got = near.join(rows, ["episode_id", "track", "i"])
    side = lambda x: F.transform(F.array_sort(F.collect_list(F.when(F.col("x") == x, F.struct("i", "seq")))), lambda r: r["seq"])
    own = got.groupBy("episode_id", "track", "batch").agg(side(True).alias("before"), side(False).alias("after"))
    return own.withColumn("before", F.when(F.size("before") > 0, F.col("before"))).withColumn("after", F.when(F.size("after") > 0, F.col("after")))


@query(
    f"""WITH {CUES}, a AS (SELECT episode_id, seq, s, e, row_number() OVER (PARTITION BY episode_id ORDER BY s, seq) AS i FROM timed WHERE track = 'ja_asr'), b AS (SELECT episode_id, seq, text FROM cue WHERE track = 'en_sub' AND trim(coalesce(text, ''), ' ') <> ''),
f AS (SELECT a.episode_id, min(i) AS i0 FROM a LEFT JOIN b USING (episode_id, seq) WHERE b.seq IS NULL GROUP BY 1), x AS (SELECT a.*, i0, min(CASE WHEN i = i0 THEN s END) OVER (PARTITION BY a.episode_id) AS s0 FROM a JOIN f ON f.episode_id = a.episode_id AND i >= i0),
v AS (SELECT episode_id, min(CASE WHEN i > i0 AND (i - i0 >= 84 OR e - s0 > 300000) THEN i END) AS stop, max(i) AS top FROM x GROUP BY 1)
SELECT x.episode_id, min(i) AS first_cue, max(i) AS last_cue, min(x.s) AS start_ms, arg_max(e, i) AS end_ms FROM x JOIN v USING (episode_id) WHERE i < coalesce(stop, top + 1) GROUP BY 1"""
)
def next_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Of each episode the next batch to translate: from the first cue without an English text, 84 cues or five minutes."""
    every = cues(spark, folder, timed=False)
    own = positions(_blocks(spark, folder).filter("track = 'ja_asr'"), ["episode_id"], "block", ["s", "seq"]).select("episode_id", "seq", "s", "e", F.col("i").cast("long").alias("i"))
    done = every.filter("track = 'en_sub' AND trim(coalesce(text, '')) <> ''").select("episode_id", "seq")
    first = own.join(done, ["episode_id", "seq"], "left_anti").groupBy("episode_id").agg(F.min(F.struct("i", "s")).alias("f"))
    x = own.join(first, "episode_id").filter("i >= f.i AND i - f.i <= 84")
    stop = x.groupBy("episode_id").agg(F.min(F.expr("CASE WHEN i > f.i AND (i - f.i >= 84 OR e - f.s > 300000) THEN i END")).alias("stop"))
    got = x.join(stop, "episode_id").filter("stop IS NULL OR i < stop")
    return got.groupBy("episode_id").agg(F.min("i").alias("first_cue"), F.max("i").alias("last_cue"), F.min("s").alias("start_ms"), F.max_by("e", "i").alias("end_ms"))


@query(
    f"""WITH {CUES}, x AS (SELECT episode_id, track, (row_number() OVER (PARTITION BY episode_id, track ORDER BY s, seq) - 1) // 48 AS batch, {_spaced('text')} * 1000 > 20 * greatest(1, e - s) AS fast, length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1 > 2 AS tall, e < s AS broken FROM timed),
b AS (SELECT episode_id, track, CAST(batch AS BIGINT) AS batch, CAST(sum(CAST(fast AS INT)) AS BIGINT) AS cps_faults, CAST(sum(CAST(tall AS INT)) AS BIGINT) AS line_faults, bool_or(broken) AS broken FROM x GROUP BY 1, 2, 3)
SELECT episode_id, track, batch, cps_faults, line_faults, CASE WHEN broken THEN 'red' WHEN cps_faults > 0 OR line_faults > 0 THEN 'yellow' ELSE 'green' END AS review,
  CASE WHEN NOT broken AND line_faults > 0 THEN 'structural' WHEN NOT broken AND cps_faults > 0 THEN 'cps_only' END AS yellow_class FROM b"""
)
def batch_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of 48 cues with what their counts make of a green mark."""
    rows = positions(_blocks(spark, folder), ["episode_id", "track"], "block", ["s", "seq"]).withColumn("batch", F.floor((F.col("i") - 1) / 48))
    fast = char_counts("text")["chars_spaced"] * 1000 > 20 * F.greatest(F.lit(1), F.col("e") - F.col("s"))
    tall = F.length(F.coalesce("text", F.lit(""))) - F.length(F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(""))) + 1 > 2
    b = rows.groupBy("episode_id", "track", "batch").agg(F.sum(fast.cast("int")).alias("cps_faults"), F.sum(tall.cast("int")).alias("line_faults"), F.bool_or(F.col("e") < F.col("s")).alias("broken"))
    m = p.merged_review(F.lit("green"), F.col("cps_faults"), F.col("line_faults"), F.col("broken"))
    return b.select("episode_id", "track", "batch", "cps_faults", "line_faults", m["review"].alias("review"), m["yellow_class"].alias("yellow_class"))


@query(f"WITH {CUES}, {SEGMENTS}, t AS (SELECT episode_id, seq, count(DISTINCT name) AS turns, bool_or(g.s >= c.s) AS starts FROM timed c JOIN seg g USING (episode_id) WHERE c.track = 'sdh' AND c.s < g.e AND c.e > g.s GROUP BY 1, 2), b AS (SELECT t.*, c.s // 60000 AS batch FROM t JOIN timed c ON c.track = 'sdh' AND c.episode_id = t.episode_id AND c.seq = t.seq) SELECT episode_id, batch, count(*) AS affected, count(*) FILTER (turns > 1) AS multi_turn, count(*) >= 3 AND bool_or(starts) AS rapid_exchange FROM b GROUP BY 1, 2")
def turn_policy(spark: SparkSession, folder: str) -> DataFrame:
    """Minutes of labelled cues: how many meet a turn, how many several, and whether turns change fast."""
    seg = segments(spark, folder).select("episode_id", "name", F.col("s").alias("gs"), F.col("e").alias("ge"))
    met = overlap_join(cues(spark, folder).filter("track = 'sdh'").select("episode_id", "seq", "s", "e"), seg, ["episode_id"], ("s", "e"), ("gs", "ge"))
    t = met.groupBy("episode_id", "seq", F.floor(F.col("s") / 60_000).alias("batch")).agg(F.countDistinct("name").alias("turns"), F.bool_or(F.col("gs") >= F.col("s")).alias("starts"))
    return t.groupBy("episode_id", "batch").agg(F.count(F.lit(1)).alias("affected"), F.count(F.when(F.col("turns") > 1, 1)).alias("multi_turn"), ((F.count(F.lit(1)) >= 3) & F.bool_or("starts")).alias("rapid_exchange"))


@query(f"WITH {CUES} SELECT episode_id, track, seq, s || '-' || e AS timing, substr(sha1(coalesce(text, '')), 1, 12) AS text_hash FROM timed")
def cue_signatures(spark: SparkSession, folder: str) -> DataFrame:
    """What tells whether a cue's time or text changed."""
    return cues(spark, folder).select("episode_id", "track", "seq", F.concat(F.col("s").cast("string"), F.lit("-"), F.col("e").cast("string")).alias("timing"), F.substring(F.sha1(F.coalesce("text", F.lit(""))), 1, 12).alias("text_hash"))


_VOCAB = "".join(chr(c) for c in [*range(0x3041, 0x3097), *range(0x30A1, 0x30FB)]) + "ー"


@query(
    f"""WITH {SEGMENTS}, v AS (SELECT episode_id, name, s, e, coalesce(text, '') AS t, length(coalesce(text, '')) - length(translate(coalesce(text, ''), '{_VOCAB}', '')) AS n FROM seg)
SELECT episode_id, name, CAST(n AS INT) AS in_vocab, n * 10 < 4 * length(t) OR length(t) = 0 OR (e <= s AND length(t) <= 10) AS weak FROM v"""
)
def weak_anchors(spark: SparkSession, folder: str) -> DataFrame:
    """Segments whose alignment can't be trusted: few characters in the vocabulary of kana, or no duration."""
    t = F.coalesce("text", F.lit(""))
    return segments(spark, folder).select("episode_id", "name", (F.length(t) - F.length(F.translate(t, _VOCAB, ""))).alias("in_vocab"), p.is_weak_anchor(vocab_share(F.col("text"), _VOCAB), F.col("s"), F.col("e"), F.col("text")).alias("weak"))


@query("SELECT episode_id, name, kind, team, min(entity_id) AS entity_id, count(*) AS times FROM entities GROUP BY 1, 2, 3, 4")
def items_once(spark: SparkSession, folder: str) -> DataFrame:
    """Items read off the screen, each name, kind and team of an episode once, by where it comes first."""
    return table(spark, folder, "entities").groupBy("episode_id", "name", "kind", "team").agg(F.min("entity_id").alias("entity_id"), F.count(F.lit(1)).alias("times"))


_GAPS = f"{CUES}, o AS (SELECT *, lag(e) OVER (PARTITION BY episode_id, track ORDER BY s, seq) AS b FROM timed), gp AS (SELECT episode_id, track, b AS gap_start, s AS gap_end, row_number() OVER (PARTITION BY episode_id, track ORDER BY s, b) - 1 AS gap_id FROM o WHERE s - b >= 1500)"


def _gaps(spark: SparkSession, folder: str) -> DataFrame:
    g = islands.gaps(cues(spark, folder), ["episode_id", "track"], "s", "e", ["s", "seq"], 1_500).withColumn("block", F.floor(F.col("gap_end") / 600_000))
    return positions(g, ["episode_id", "track"], "block", ["gap_end", "gap_start"]).select("episode_id", "track", (F.col("i") - 1).alias("gap_id"), "gap_start", "gap_end")


@query(f"WITH {_GAPS} SELECT episode_id, track, gap_id, gap_start, gap_end FROM gp")
def numbered_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """Gaps of 1.5 s or more as numbered candidates for cuts."""
    return _gaps(spark, folder)


@query(
    f"""WITH {_GAPS}, {SEGMENTS}, j AS (SELECT gp.episode_id, track, gap_id, name, g.s, row_number() OVER (PARTITION BY gp.episode_id, track, gap_id ORDER BY g.s, name) AS rank FROM gp JOIN seg g ON g.episode_id = gp.episode_id AND ((g.s < gap_end AND g.e > gap_start) OR abs(g.s - gap_start) <= 1000 OR abs(g.e - gap_end) <= 1000))
SELECT episode_id, track, gap_id, CAST(rank AS INT) AS rank, name FROM j WHERE rank <= 6"""
)
def items_near_gaps(spark: SparkSession, folder: str) -> DataFrame:
    """The first six segments that overlap a gap or start or end within a second of it."""
    seg = segments(spark, folder).select("episode_id", "name", F.col("s").alias("gs"), F.col("e").alias("ge"))
    gaps = _gaps(spark, folder).withColumn("a", F.col("gap_start") - 1000).withColumn("z", F.col("gap_end") + 1000)
    met = overlap_join(gaps, seg, ["episode_id"], ("a", "z"), ("gs", "ge"), 30_000, closed=True)
    near = met.filter("(gs < gap_end AND ge > gap_start) OR abs(gs - gap_start) <= 1000 OR abs(ge - gap_end) <= 1000")
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("episode_id", "track", "gap_id").orderBy("gs", "name"))).filter("rank <= 6").select("episode_id", "track", "gap_id", "rank", "name")


@query(
    f"""WITH {CUES}, c AS (SELECT episode_id, track, s // 60000 AS region, s, e, seq, {_compact('text')} AS n FROM timed), w AS (SELECT *, sum(n) OVER (PARTITION BY episode_id, track, region ORDER BY s, seq ROWS UNBOUNDED PRECEDING) AS t, sum(n) OVER (PARTITION BY episode_id, track, region) AS total FROM c WHERE n > 0)
SELECT episode_id, track, region, CAST(s + greatest(0, e - s) * greatest(0, total // 2 - t + n) // n AS BIGINT) AS at_ms FROM w WHERE total // 2 <= t AND (total // 2 > t - n OR (total // 2 <= 0 AND t = n))"""
)
def half_said_times(spark: SparkSession, folder: str) -> DataFrame:
    """When half of a minute's characters are said."""
    c = cues(spark, folder).withColumn("region", F.floor(F.col("s") / 60_000)).withColumn("n", char_counts("text")["chars_compact"])
    return time_at_offset(c, ["episode_id", "track", "region"], ["s", "seq"], "s", "e", "n", F.floor(F.col("total") / 2))


@query(
    f"""WITH {CUES}, {SEGMENTS}, a AS (SELECT episode_id, seq, sum({_compact('text')}) OVER (PARTITION BY episode_id ORDER BY s, seq ROWS UNBOUNDED PRECEDING) - {_compact('text')} AS at FROM timed WHERE track = 'sdh'),
b AS (SELECT DISTINCT episode_id, sum({_compact('text')}) OVER (PARTITION BY episode_id ORDER BY s, name ROWS UNBOUNDED PRECEDING) - {_compact('text')} AS at FROM seg WHERE s IS NOT NULL)
SELECT a.episode_id, a.seq, CAST(a.at AS BIGINT) AS char_offset, b.at IS NOT NULL AS starts_turn FROM a LEFT JOIN b ON b.episode_id = a.episode_id AND b.at = a.at"""
)
def restored_turns(spark: SparkSession, folder: str) -> DataFrame:
    """Cues that start at a segment's place in the text, by counts of characters: turns restored after the labels are lost."""
    def offsets(df: DataFrame, key: str) -> DataFrame:
        n = df.withColumn("n", char_counts("text")["chars_compact"].cast("long")).withColumn("block", F.floor(F.col("s") / 600_000))
        return running_sum(n, ["episode_id"], "block", ["s", key], "n", "to").withColumn("char_offset", F.col("to") - F.col("n"))

    starts = offsets(segments(spark, folder).filter("s IS NOT NULL"), "name").select("episode_id", "char_offset", F.lit(True).alias("x")).distinct()
    own = offsets(cues(spark, folder).filter("track = 'sdh'"), "seq").select("episode_id", "seq", "char_offset")
    return own.join(starts, ["episode_id", "char_offset"], "left").select("episode_id", "seq", "char_offset", F.col("x").isNotNull().alias("starts_turn"))


@query(f"WITH {SEGMENTS}, nm AS (SELECT DISTINCT episode_id, name AS canonical, list_append(coalesce(variants, []), name) AS sp FROM entities), n AS (SELECT g.episode_id, g.name AS seg, text, unnest(x.names) AS said FROM seg g JOIN (SELECT episode_id, name, max(names) AS names FROM segments WHERE names IS NOT NULL GROUP BY 1, 2) x USING (episode_id, name)) SELECT n.episode_id, seg, said, bool_or(contains(text, said)) AS exact, bool_or(contains(text, said) OR coalesce(list_bool_or(list_transform(sp, lambda y: length(y) > 0 AND contains(text, y))), false)) AS rescued FROM n LEFT JOIN nm ON nm.episode_id = n.episode_id AND list_contains(sp, said) WHERE said IS NOT NULL AND text IS NOT NULL GROUP BY 1, 2, 3")
def alias_recall(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a segment's text says a name listed for it, as listed or under another spelling of the same entity."""
    names = table(spark, folder, "segments").filter("names IS NOT NULL").groupBy("episode_id", "name").agg(F.max("names").alias("n"))
    n = segments(spark, folder).join(names, ["episode_id", "name"]).select("episode_id", F.col("name").alias("seg"), "text", F.explode("n").alias("said")).filter("said IS NOT NULL AND text IS NOT NULL")
    e = table(spark, folder, "entities").select("episode_id", F.concat(F.coalesce("variants", F.array().cast("array<string>")), F.array("name")).alias("sp")).distinct()
    e = e.select("episode_id", "sp", F.explode(F.array_distinct("sp")).alias("said"))
    other = F.coalesce(F.exists("sp", lambda y: (F.length(y) > 0) & F.contains("text", y)), F.lit(False))
    return n.join(e, ["episode_id", "said"], "left").groupBy("episode_id", "seg", "said").agg(F.bool_or(F.contains("text", "said")).alias("exact"), F.bool_or(F.contains("text", "said") | other).alias("rescued"))


@query(f"WITH {CUES} SELECT episode_id, track, seq, seq || ' [' || (greatest(1, e - s) // 100) // 10 || '.' || (greatest(1, e - s) // 100) % 10 || 's, ' || {_spaced('text')} * 1000 // greatest(1, e - s) || ' cps] ' || replace(coalesce(text, ''), chr(10), ' / ') AS line FROM timed")
def cue_prompts(spark: SparkSession, folder: str) -> DataFrame:
    """Each cue as a line for a prompt: number, seconds, reading speed, text."""
    ms = F.greatest(F.lit(1), F.col("e") - F.col("s"))
    tenths = F.floor(ms / 100)
    line = F.concat(F.col("seq").cast("string"), F.lit(" ["), F.floor(tenths / 10).cast("string"), F.lit("."), (tenths % 10).cast("string"), F.lit("s, "), F.floor(char_counts("text")["chars_spaced"] * 1000 / ms).cast("string"), F.lit(" cps] "), F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" / ")))
    return cues(spark, folder).select("episode_id", "track", "seq", line.alias("line"))


@query("WITH e AS (SELECT episode_id, CAST(round(duration_s * 1000) AS BIGINT) AS d FROM episodes WHERE duration_s > 0), c AS (SELECT episode_id, d, unnest(range(0, d, 240000)) AS start_ms FROM e) SELECT episode_id, CAST(start_ms // 240000 AS BIGINT) AS chunk, start_ms, least(d, start_ms + 240000) AS end_ms FROM c")
def fixed_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks of four minutes that cover each episode."""
    d = table(spark, folder, "episodes").filter("duration_s > 0").select("episode_id", F.round(F.col("duration_s") * 1000).cast("long").alias("d"))
    c = d.filter("d > 0").select("episode_id", "d", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("d") - 1) / 240_000))).alias("chunk"))
    return c.select("episode_id", "chunk", (F.col("chunk") * 240_000).alias("start_ms"), F.least("d", F.col("chunk") * 240_000 + 240_000).alias("end_ms"))


@query(f"WITH {CUES}, a AS (SELECT episode_id, seq, s, e FROM timed WHERE track = 'ja_asr'), b AS (SELECT episode_id, seq, s, e FROM timed WHERE track = 'en_sub') SELECT coalesce(a.episode_id, b.episode_id) AS episode_id, coalesce(a.seq, b.seq) AS seq, CASE WHEN b.seq IS NULL THEN 'missing' WHEN a.seq IS NULL THEN 'extra' ELSE 'moved' END AS fault FROM a FULL JOIN b ON a.episode_id = b.episode_id AND a.seq = b.seq WHERE a.seq IS NULL OR b.seq IS NULL OR a.s <> b.s OR a.e <> b.e")
def seed_faults(spark: SparkSession, folder: str) -> DataFrame:
    """Why a draft's cues can't seed the translation of a track: times that differ, cues that one lacks."""
    c = cues(spark, folder)
    return timing_faults(c.filter("track = 'ja_asr'"), c.filter("track = 'en_sub'"), ["episode_id"], "seq", ("s", "e"))


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY episode_id, source ORDER BY entry_id) AS a, row_number() OVER (PARTITION BY episode_id, source ORDER BY loaded_at DESC, entry_id DESC) AS z FROM glossary_entries WHERE source IS NOT NULL) SELECT x.episode_id, x.source, coalesce(y.target, x.target) AS target FROM r x JOIN r y ON y.episode_id = x.episode_id AND y.source = x.source AND y.z = 1 WHERE x.a = 1")
def resumed_entries(spark: SparkSession, folder: str) -> DataFrame:
    """First entries with the target of the last delivery where that has one."""
    g = table(spark, folder, "glossary_entries").filter("source IS NOT NULL")
    first = g.groupBy("episode_id", "source").agg(F.min_by(F.struct("target"), "entry_id").alias("r")).select("episode_id", "source", "r.target")
    last = g.groupBy("episode_id", "source").agg(F.max_by(F.struct("target"), F.struct("loaded_at", "entry_id")).alias("r")).select("episode_id", "source", "r.target")
    return take_done(first, last, ["episode_id", "source"], "target")
