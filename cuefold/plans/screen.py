"""Queries on text seen on screen: shapes of terms, spans and their classes, context for chunks, lines without times."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import predicates as p
from ..functions.text import squeeze
from ..operators.intervals import overlap_join
from ..operators.quality import VISUAL
from ..operators.screen import fill_visual, place_unaligned, visual_runs
from ..operators.terms import STRUCTURAL, contained_terms, span_terms, term_noise
from ..session import table
from .base import CUES, SEGMENTS, cues, segments

QUERIES, ORACLE = {}, {}
_DROPS = "[\\s　、。！？?!…,.，「」『』（）()【】\\[\\]・:：\\-ー]+"


def query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        ORACLE[f.__name__] = sql
        return f

    return register


def _quoted(words) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"


def _any(t: str, words) -> str:
    return "(" + " OR ".join(f"contains({t}, '{w}')" for w in words) + ")"


def _rx(t: str, pattern: str) -> str:
    return f"regexp_matches({t}, '{pattern}')"


def _noise(t: str) -> str:
    return f"({t} IN {_quoted(p.SCREEN_NOISE)} OR length({t}) <= 1 OR {_rx(t, p.SIGNS_ONLY)} OR {_rx(t, p.SHORT_LATIN)} OR (length({t}) >= 8 AND {t} = repeat(substr({t}, 1, 1), length({t}))) OR {_rx(t, p.CREDITS)})"


def _sentence(t: str) -> str:
    return f"(length({t}) >= 24 OR {_rx(t, '[。！？!?]$')} OR (contains({t}, '、') AND length({t}) >= 12))"


def _order(t: str) -> str:
    return f"({_any(t, p.ORDERS)} OR {_rx(t, p.ORDER_SIGNS)} OR {_rx(t, p.ORDER_ENDS)})"


def _entity(t: str) -> str:
    return f"(NOT {_noise(t)} AND NOT {_sentence(t)} AND NOT {_order(t)} AND length({t}) BETWEEN 2 AND 20)"


def _safe(t: str) -> str:
    return f"(NOT {_noise(t)} AND NOT {_sentence(t)} AND NOT {_order(t)} AND length({t}) <= 24 AND NOT {_rx(t, p.UNSAFE)})"


@query(
    f"""WITH t AS (SELECT entry_id, coalesce(source, '') AS x FROM glossary_entries)
SELECT entry_id, lower(x) IN {_quoted(p.BROADCAST)} AS broadcast, {_noise('x')} AS noise, {_sentence('x')} AS sentence_like, {_order('x')} AS instruction_like, {_entity('x')} AS entity_like,
  {_safe('x')} AS prompt_safe, length(x) <= 2 OR x IN {_quoted(p.FILL)} OR {_rx('x', p.FILL_SIGNS)} AS short_fill, {_rx('x', p.JAPANESE)} AS japanese FROM t"""
)
def term_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """What each glossary source looks like."""
    x = F.col("source")
    return table(spark, folder, "glossary_entries").select(
        "entry_id", p.is_broadcast(x).alias("broadcast"), p.is_screen_noise(x).alias("noise"), p.is_sentence_like(x).alias("sentence_like"), p.is_instruction_like(x).alias("instruction_like"),
        p.is_entity_like(x).alias("entity_like"), p.is_prompt_safe(x).alias("prompt_safe"), p.is_short_fill(x).alias("short_fill"), p.is_japanese(x).alias("japanese"),
    )


_STRIP = "regexp_replace({t}, '^" + p.SPACE + "+|" + p.SPACE + "+$', '', 'g')"


@query(
    f"""WITH {CUES}, t AS (SELECT episode_id, track, seq, coalesce(text, '') AS x, regexp_replace(coalesce(text, ''), '{_DROPS}', '', 'g') AS n, {_STRIP.format(t="coalesce(text, '')")} AS st FROM cue)
SELECT episode_id, track, seq, NOT {_any('x', p.NOT_ADDRESSED)} AND {_rx('x', p.ADDRESSED)} AS addressed, {_rx('x', '[?？]')} AS asks, n IN {_quoted(p.TRIVIAL)} AS trivial, {_any('x', p.NARRATION)} AS narration,
  {_rx('st', '[?？]$')} OR {_any('st', p.ASKING)} AS question_or_setup, length(translate(x, ' ' || chr(10), '')) <= 8 AS interjection FROM t"""
)
def line_marks(spark: SparkSession, folder: str) -> DataFrame:
    """What each cue's line does: addresses, asks, says little, narrates."""
    x = F.col("text")
    return cues(spark, folder, timed=False).select(
        "episode_id", "track", "seq", p.is_addressed(x).alias("addressed"), p.asks(x).alias("asks"), p.is_trivial(x).alias("trivial"), p.holds_any(x, p.NARRATION).alias("narration"),
        p.is_question_or_setup(x).alias("question_or_setup"), p.is_interjection(x).alias("interjection"),
    )


_SHAPE = " OR ".join(f"regexp_full_match(x, '{s}')" for k, s in STRUCTURAL.items() if k != "one_sign")


@query(
    f"""WITH i AS (SELECT show_id, entry_id, CAST(unnest(range(0, len(a))) AS INT) AS pos, unnest(a) AS item FROM (SELECT show_id, entry_id, string_split(replace(coalesce(source, ''), '、', ','), ',') AS a FROM glossary_entries)),
t AS (SELECT show_id, entry_id, pos, regexp_replace(item, '^{p.EDGES.replace("'", "''")}|{p.EDGES.replace("'", "''")}$', '', 'g') AS x FROM i),
k AS (SELECT * FROM t WHERE NOT (length(x) <= 1 OR {_SHAPE} OR (length(x) >= 3 AND x = repeat(substr(x, 1, 1), length(x))) OR {_rx('x', '(?i)https?://|www[.]|[.]com|[.]jp')} OR {_rx('x', p.COPYRIGHT)} OR lower(x) IN {_quoted(p.BROADCAST)} OR length(x) > 48)),
r AS (SELECT *, row_number() OVER (PARTITION BY show_id, lower(x) ORDER BY entry_id, pos) AS rn FROM k) SELECT show_id, entry_id, pos, x AS term FROM r WHERE rn = 1"""
)
def candidate_terms(spark: SparkSession, folder: str) -> DataFrame:
    """A show's glossary candidates: lists divided, edges bared, noise left out, the first of each spelling whatever its case."""
    items = table(spark, folder, "glossary_entries").select("show_id", "entry_id", F.posexplode(F.split(F.replace(F.coalesce("source", F.lit("")), F.lit("、"), F.lit(",")), ",")).alias("pos", "item"))
    x = F.col("term")
    kept = items.select("show_id", "entry_id", "pos", p.bare_term(F.col("item")).alias("term")).filter(term_noise(x).isNull() & ~x.rlike(p.COPYRIGHT) & ~p.is_broadcast(x) & (F.length(x) <= 48))
    first = kept.groupBy("show_id", F.lower("term").alias("low")).agg(F.min(F.struct("entry_id", "pos", "term")).alias("r"))
    return first.select("show_id", "r.*")


# minutes of an episode as spans: the terms of the segments that start in them
_SPANS = f"""{SEGMENTS}, kt AS (SELECT episode_id, name, unnest(k) AS term FROM (SELECT episode_id, name, max(kata) AS k FROM segments WHERE kata IS NOT NULL GROUP BY 1, 2)),
sp AS (SELECT episode_id, s // 60000 AS span, term, count(*) AS n FROM kt JOIN seg USING (episode_id, name) WHERE term IS NOT NULL AND s IS NOT NULL GROUP BY 1, 2, 3),
cl AS (SELECT episode_id, span, CAST(sum(n) AS BIGINT) AS lines, CASE WHEN sum(n) >= 40 THEN 'dense_board_or_list' WHEN sum(CASE WHEN {_sentence('term')} THEN n ELSE 0 END) * 10 >= 6 * sum(n) AND sum(n * length(term)) >= 12 * sum(n) THEN 'caption_or_quote'
  WHEN bool_or({_safe('term')}) AND sum(n * length(term)) <= 14 * sum(n) THEN 'name_or_title_card' ELSE 'mixed' END AS class FROM sp GROUP BY 1, 2),
sc AS (SELECT *, 200 * n - 3 * greatest(0, length(term) - 12) + CASE WHEN {_entity('term')} THEN 200 ELSE 0 END + CASE WHEN {_rx('term', '[ァ-ヶ・]')} THEN 50 ELSE 0 END + CASE WHEN contains(term, ' ') THEN 50 ELSE 0 END
  + CASE WHEN {_rx('term', '[A-Za-z]')} AND NOT {_rx('term', '^[A-Za-z0-9 ]+$')} THEN 25 ELSE 0 END AS score FROM sp WHERE {_safe('term')}),
rk AS (SELECT *, CAST(row_number() OVER (PARTITION BY episode_id, span ORDER BY score DESC, n DESC, length(term), term DESC) AS INT) AS rank FROM sc)"""


def _spans(spark: SparkSession, folder: str) -> DataFrame:
    kata = table(spark, folder, "segments").filter("kata IS NOT NULL").groupBy("episode_id", "name").agg(F.max("kata").alias("k")).select("episode_id", "name", F.explode("k").alias("term"))
    own = kata.join(segments(spark, folder).select("episode_id", "name", "s"), ["episode_id", "name"]).filter("term IS NOT NULL AND s IS NOT NULL")
    return own.groupBy("episode_id", F.floor(F.col("s") / 60_000).alias("span"), "term").agg(F.count(F.lit(1)).alias("n"))


def _classes(spans: DataFrame) -> DataFrame:
    x, n = F.col("term"), F.col("n")
    size = F.sum(n * F.length(x))
    kind = F.when(F.sum(n) >= 40, "dense_board_or_list").when((F.sum(F.when(p.is_sentence_like(x), n).otherwise(0)) * 10 >= 6 * F.sum(n)) & (size >= 12 * F.sum(n)), "caption_or_quote")
    kind = kind.when(F.bool_or(p.is_prompt_safe(x)) & (size <= 14 * F.sum(n)), "name_or_title_card").otherwise("mixed")
    return spans.groupBy("episode_id", "span").agg(F.sum("n").alias("lines"), kind.alias("class"))


@query(f"WITH {_SPANS} SELECT episode_id, span, lines, class FROM cl")
def span_classes(spark: SparkSession, folder: str) -> DataFrame:
    """What each span on screen is: a dense board, a caption, a name card or something mixed."""
    return _classes(_spans(spark, folder))


@query(f"WITH {_SPANS} SELECT episode_id, span, rank, term, n FROM rk WHERE rank <= 8")
def safe_span_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Each span's eight best terms for a prompt."""
    return span_terms(_spans(spark, folder), ["episode_id", "span"], "term", "n", 8, True)


@query(
    f"""WITH {_SPANS}, m AS (SELECT episode_id, term, count(*) AS spans, CAST(sum(n) AS BIGINT) AS total FROM rk JOIN cl USING (episode_id, span) WHERE rank <= 8 AND class <> 'dense_board_or_list' GROUP BY 1, 2),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY episode_id ORDER BY 3 * spans + total + CASE WHEN {_entity('term')} THEN 2 ELSE 0 END DESC, spans DESC, total DESC, length(term), term DESC) AS INT) AS rank FROM m) SELECT episode_id, rank, term, spans, total FROM o WHERE rank <= 20"""
)
def episode_memory(spark: SparkSession, folder: str) -> DataFrame:
    """The twenty terms an episode's spans say most of, dense boards left out."""
    s = _spans(spark, folder)
    best = span_terms(s, ["episode_id", "span"], "term", "n", 8, True).join(_classes(s).filter("class <> 'dense_board_or_list'"), ["episode_id", "span"])
    m = best.groupBy("episode_id", "term").agg(F.count(F.lit(1)).alias("spans"), F.sum("n").alias("total"))
    score = 3 * F.col("spans") + F.col("total") + F.when(p.is_entity_like(F.col("term")), 2).otherwise(0)
    w = Window.partitionBy("episode_id").orderBy(score.desc(), F.col("spans").desc(), F.col("total").desc(), F.length("term"), F.col("term").desc())
    return m.withColumn("rank", F.row_number().over(w)).filter("rank <= 20").select("episode_id", "rank", "term", "spans", "total")


@query(
    f"""WITH {_SPANS}, mx AS (SELECT episode_id, max(span * 60000 + 60000) // 300000 AS top FROM sp GROUP BY 1), ch AS (SELECT episode_id, unnest(range(0, top + 1)) AS chunk FROM mx),
j AS (SELECT ch.episode_id, chunk, term, CAST(sum(CASE class WHEN 'name_or_title_card' THEN 15 WHEN 'dense_board_or_list' THEN 8 ELSE 10 END * greatest(1, 2 * (8 - (rank - 1)))) AS BIGINT) AS score20
  FROM ch JOIN rk ON rk.episode_id = ch.episode_id AND rank <= 8 AND NOT (span * 60000 + 60000 < chunk * 300000 - 20000 OR span * 60000 > chunk * 300000 + 320000) JOIN cl ON cl.episode_id = rk.episode_id AND cl.span = rk.span GROUP BY 1, 2, 3),
o AS (SELECT *, CAST(row_number() OVER (PARTITION BY episode_id, chunk ORDER BY score20 DESC, term DESC) AS INT) AS rank FROM j) SELECT episode_id, chunk, rank, term, score20 FROM o WHERE rank <= 8"""
)
def chunk_context(spark: SparkSession, folder: str) -> DataFrame:
    """The eight terms of most weight around each chunk of five minutes: spans within 20 s, by class and the term's rank."""
    s = _spans(spark, folder)
    best = span_terms(s, ["episode_id", "span"], "term", "n", 8, True).join(_classes(s), ["episode_id", "span"])
    best = best.withColumn("a", F.col("span") * 60_000 - 20_000).withColumn("z", F.col("span") * 60_000 + 80_000)
    top = s.groupBy("episode_id").agg(F.floor(F.max(F.col("span") * 60_000 + 60_000) / 300_000).alias("top"))
    chunks = top.select("episode_id", F.explode(F.sequence(F.lit(0).cast("long"), "top")).alias("chunk")).withColumn("s", F.col("chunk") * 300_000).withColumn("e", F.col("chunk") * 300_000 + 300_000)
    met = overlap_join(chunks, best, ["episode_id"], ("s", "e"), ("a", "z"), 300_000, closed=True)
    weight = F.when(F.col("class") == "name_or_title_card", 15).when(F.col("class") == "dense_board_or_list", 8).otherwise(10) * F.greatest(F.lit(1), 2 * (9 - F.col("rank")))
    j = met.groupBy("episode_id", "chunk", "term").agg(F.sum(weight).alias("score20"))
    w = Window.partitionBy("episode_id", "chunk").orderBy(F.col("score20").desc(), F.col("term").desc())
    return j.withColumn("rank", F.row_number().over(w)).filter("rank <= 8").select("episode_id", "chunk", "rank", "term", "score20")


_FRAMES = f"{SEGMENTS}, fl AS (SELECT episode_id, s // 10000 AS frame, s, name, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM seg WHERE text IS NOT NULL AND s IS NOT NULL)"


@query(
    f"""WITH {_FRAMES}, c AS (SELECT episode_id, frame, line, count(*) AS n, min((s, name, pos)) AS first FROM fl WHERE line <> '' GROUP BY 1, 2, 3),
d AS (SELECT *, row_number() OVER (PARTITION BY episode_id, frame ORDER BY n DESC, first) AS rn FROM c)
SELECT episode_id, frame, CAST(sum(n) AS BIGINT) AS raw_count, count(*) AS unique_count, max(CASE WHEN rn = 1 THEN line END) AS dominant_line, max(n) AS dominant_count, sum(n) >= 40 AS dense_flag,
  max(n) >= 5 AND bool_or(rn = 1 AND (length(line) <= 2 OR line IN {_quoted(p.FILL)} OR {_rx('line', p.FILL_SIGNS)})) AS repetition_flag,
  CAST(sum(CASE WHEN n >= 5 AND (length(line) <= 2 OR line IN {_quoted(p.FILL)} OR {_rx('line', p.FILL_SIGNS)}) THEN 1 ELSE n END) AS BIGINT) AS kept_count FROM d GROUP BY 1, 2"""
)
def frame_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Frames of ten seconds: how many lines, the dominant one (of equals the first), and what stays if short fill is said once."""
    lines = segments(spark, folder).filter("text IS NOT NULL AND s IS NOT NULL").select("episode_id", F.floor(F.col("s") / 10_000).alias("frame"), "s", "name", F.posexplode(F.split("text", "\n")).alias("pos", "line")).filter("line <> ''")
    c = lines.groupBy("episode_id", "frame", "line").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("s", "name", "pos")).alias("first"))
    fill = p.is_short_fill(F.col("line"))
    per = c.groupBy("episode_id", "frame").agg(
        F.sum("n").alias("raw_count"), F.count(F.lit(1)).alias("unique_count"), F.min_by(F.struct("line", "n"), F.struct(-F.col("n"), "first")).alias("top"), F.sum(F.when((F.col("n") >= 5) & fill, 1).otherwise(F.col("n"))).alias("kept_count")
    )
    return per.select("episode_id", "frame", "raw_count", "unique_count", F.col("top.line").alias("dominant_line"), F.col("top.n").alias("dominant_count"), (F.col("raw_count") >= 40).alias("dense_flag"), ((F.col("top.n") >= 5) & p.is_short_fill(F.col("top.line"))).alias("repetition_flag"), "kept_count")


_NAMES = "SELECT DISTINCT episode_id, name AS canonical, unnest(list_append(coalesce(variants, []), name)) AS spelling FROM entities"


def _spellings(spark: SparkSession, folder: str) -> DataFrame:
    """Canonical names with all their spellings."""
    e = table(spark, folder, "entities")
    return e.select("episode_id", F.col("name").alias("canonical"), F.explode(F.concat(F.coalesce("variants", F.array().cast("array<string>")), F.array("name"))).alias("spelling")).distinct()


@query(
    f"""WITH {CUES}, {SEGMENTS}, sp AS ({_NAMES}), l AS (SELECT episode_id, s AS cs, e AS ce, text FROM timed WHERE text <> ''),
h AS (SELECT DISTINCT l.episode_id, cs, ce, canonical FROM l JOIN sp ON sp.episode_id = l.episode_id AND length(spelling) > 1 AND contains(text, spelling)),
w AS (SELECT g.episode_id, name AS seg, canonical, min(cs) AS first_ms FROM seg g JOIN h ON g.episode_id = h.episode_id AND ws < ce AND we > cs GROUP BY 1, 2, 3)
SELECT episode_id, seg, canonical, first_ms, CAST(row_number() OVER (PARTITION BY episode_id, seg ORDER BY first_ms, canonical) AS INT) AS rank FROM w"""
)
def names_in_clip(spark: SparkSession, folder: str) -> DataFrame:
    """The entities whose name or variant a cue says within a segment's clip, in the order of their first mention."""
    lines = cues(spark, folder).filter("text <> ''").select("episode_id", F.col("s").alias("cs"), F.col("e").alias("ce"), "text")
    said = contained_terms(lines, _spellings(spark, folder), ["episode_id"], "text", "spelling").select("episode_id", "cs", "ce", "spelling")
    # spellings and slots of time are many more than the rows they come from, by which Spark would think them small enough to broadcast
    said = said.join(_spellings(spark, folder).hint("merge"), ["episode_id", "spelling"]).select("episode_id", "cs", "ce", "canonical").distinct().hint("merge")
    clips = segments(spark, folder).select("episode_id", F.col("name").alias("seg"), "ws", "we")
    w = overlap_join(clips, said, ["episode_id"], ("ws", "we"), ("cs", "ce")).groupBy("episode_id", "seg", "canonical").agg(F.min("cs").alias("first_ms"))
    return w.withColumn("rank", F.row_number().over(Window.partitionBy("episode_id", "seg").orderBy("first_ms", "canonical")))


@query(
    f"""WITH {SEGMENTS}, t AS (SELECT DISTINCT episode_id, source AS term FROM glossary_entries WHERE length(source) > 1)
SELECT episode_id, term FROM t WHERE episode_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM seg g WHERE g.episode_id = t.episode_id AND contains(g.text, t.term))"""
)
def unsaid_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Glossary terms that no segment of their episode says."""
    terms = table(spark, folder, "glossary_entries").filter("episode_id IS NOT NULL AND length(source) > 1").select("episode_id", F.col("source").alias("term")).distinct()
    said = contained_terms(segments(spark, folder).select("episode_id", "text"), terms, ["episode_id"], "text", "term").select("episode_id", "term").distinct()
    return terms.join(said, ["episode_id", "term"], "left_anti")


_SEEN = "^\\[画面: *(.*)\\]$"
_ITEMS = f"""{SEGMENTS}, rl AS (SELECT episode_id, name, s, e, unnest(string_split(text, chr(10))) AS raw, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM seg WHERE text IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL),
ln AS (SELECT episode_id, s // 60000 AS chunk, s, e, name, pos, trim(raw, ' ') AS line FROM rl WHERE trim(raw, ' ') <> ''),
it AS (SELECT episode_id, chunk, CAST(row_number() OVER (PARTITION BY episode_id, chunk ORDER BY s, name, pos) AS INT) AS i, regexp_matches(line, '{_SEEN}') AS visual, CASE WHEN regexp_matches(line, '{_SEEN}') THEN regexp_extract(line, '{_SEEN}', 1) ELSE line END AS said, s, e FROM ln)"""


def _items(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of segments in chunks of a minute: ``episode_id, chunk, i, visual, said, s, e``."""
    lines = segments(spark, folder).filter("text IS NOT NULL AND s IS NOT NULL AND e IS NOT NULL").select("episode_id", F.floor(F.col("s") / 60_000).alias("chunk"), "s", "e", "name", F.posexplode(F.split("text", "\n")).alias("pos", "raw"))
    lines = lines.withColumn("line", F.trim("raw")).filter("line <> ''")
    i = F.row_number().over(Window.partitionBy("episode_id", "chunk").orderBy("s", "name", "pos"))
    seen = F.col("line").rlike(_SEEN)
    return lines.select("episode_id", "chunk", i.alias("i"), seen.alias("visual"), F.when(seen, F.regexp_extract("line", _SEEN, 1)).otherwise(F.col("line")).alias("said"), "s", "e")


@query(
    f"""WITH {_ITEMS}, g AS (SELECT *, i - row_number() OVER (PARTITION BY episode_id, chunk, visual ORDER BY i) AS grp, min(CASE WHEN NOT visual THEN i END) OVER (PARTITION BY episode_id, chunk) AS a, max(CASE WHEN NOT visual THEN i END) OVER (PARTITION BY episode_id, chunk) AS z FROM it),
r AS (SELECT episode_id, chunk, min(i) AS first_item, count(*) AS lines, count(*) FILTER (length(said) >= 14) AS long_lines, bool_or({_any('said', p.SCREEN_NARRATION)}) AS hinted, min(a) AS a, max(z) AS z FROM g WHERE visual GROUP BY episode_id, chunk, grp)
SELECT episode_id, chunk, first_item, lines, long_lines, hinted, lines >= 2 AND a < first_item AND z > first_item AND (hinted OR long_lines >= 2) AS suspicious FROM r"""
)
def visual_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Runs of lines on screen, and which of them may stand for narration that nobody wrote down."""
    return visual_runs(_items(spark, folder), ["episode_id", "chunk"], "i", "visual", "said")


@query(
    f"""WITH {_ITEMS}, x AS (SELECT episode_id, chunk, i, visual, CASE WHEN NOT visual THEN s END AS s, CASE WHEN NOT visual THEN e END AS e FROM it),
n AS (SELECT *, i - row_number() OVER (PARTITION BY episode_id, chunk, visual ORDER BY i) AS grp, last_value(e IGNORE NULLS) OVER (PARTITION BY episode_id, chunk ORDER BY i ROWS UNBOUNDED PRECEDING) AS pe, first_value(s IGNORE NULLS) OVER (PARTITION BY episode_id, chunk ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ns FROM x),
v AS (SELECT *, row_number() OVER (PARTITION BY episode_id, chunk, grp ORDER BY i) - 1 AS k, count(*) OVER (PARTITION BY episode_id, chunk, grp) AS c FROM n WHERE visual),
b AS (SELECT *, CASE WHEN pe IS NOT NULL THEN pe WHEN ns IS NOT NULL THEN greatest(chunk * 60000, ns - greatest(600, 300 * c)) ELSE chunk * 60000 END AS g0, CASE WHEN ns IS NOT NULL THEN ns WHEN pe IS NOT NULL THEN least(chunk * 60000 + 60000, pe + greatest(600, 300 * c)) ELSE chunk * 60000 + 60000 END AS g1 FROM v),
q AS (SELECT *, CASE WHEN k = 0 THEN g0 ELSE least(g1, g0 + k * greatest(50, g1 - g0) // c) END AS s2 FROM b)
SELECT episode_id, chunk, i, s2 AS start_ms, greatest(s2 + 50, least(g1, g0 + (k + 1) * greatest(50, g1 - g0) // c)) AS end_ms FROM q"""
)
def visual_line_times(spark: SparkSession, folder: str) -> DataFrame:
    """Times for lines on screen, in equal slots between the spoken lines around them."""
    spoken = lambda c: F.when(~F.col("visual"), F.col(c)).alias(c)
    x = _items(spark, folder).select("episode_id", "chunk", "i", "visual", spoken("s"), spoken("e"), (F.col("chunk") * 60_000).alias("from"), (F.col("chunk") * 60_000 + 60_000).alias("to"))
    return fill_visual(x, ["episode_id", "chunk"], "i", "visual", ("s", "e"), ("from", "to"))


_LOST = f"""{CUES}, o AS (SELECT episode_id, track, seq, s // 60000 AS chunk, CAST(row_number() OVER (PARTITION BY episode_id, track, s // 60000 ORDER BY seq) AS INT) AS i, s, e, e <= s AS lost FROM timed),
n AS (SELECT *, i - row_number() OVER (PARTITION BY episode_id, track, chunk, lost ORDER BY i) AS grp, last_value(CASE WHEN NOT lost THEN e END IGNORE NULLS) OVER (PARTITION BY episode_id, track, chunk ORDER BY i ROWS UNBOUNDED PRECEDING) AS pe,
  first_value(CASE WHEN NOT lost THEN s END IGNORE NULLS) OVER (PARTITION BY episode_id, track, chunk ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ns FROM o),
v AS (SELECT *, row_number() OVER (PARTITION BY episode_id, track, chunk, grp ORDER BY i) - 1 AS k, count(*) OVER (PARTITION BY episode_id, track, chunk, grp) AS c FROM n WHERE lost),
q AS (SELECT *, pe IS NOT NULL AND ns IS NOT NULL AND ns > pe AS between_, CASE WHEN pe IS NOT NULL THEN pe WHEN ns IS NOT NULL THEN greatest(0, ns - 80 * c) ELSE 0 END AS base, least(80 * c, ns - pe) AS room FROM v),
rp AS (SELECT episode_id, track, seq, CASE WHEN between_ THEN 'between_neighbors' WHEN pe IS NOT NULL THEN 'after_previous' WHEN ns IS NOT NULL THEN 'before_next' ELSE 'fallback_from_zero' END AS mode,
  CASE WHEN between_ THEN pe + k * room // c ELSE base + 80 * k END AS start_ms, CASE WHEN between_ THEN greatest(pe + k * room // c + 1, pe + (k + 1) * room // c) ELSE base + 80 * k + 80 END AS end_ms FROM q)"""


def _lost(spark: SparkSession, folder: str) -> DataFrame:
    """Cues in chunks of a minute; those that don't end after they start have lost their times."""
    own = cues(spark, folder).withColumn("chunk", F.floor(F.col("s") / 60_000))
    own = own.withColumn("i", F.row_number().over(Window.partitionBy("episode_id", "track", "chunk").orderBy("seq"))).withColumn("lost", F.col("e") <= F.col("s"))
    return place_unaligned(own, ["episode_id", "track", "chunk"], "i", "lost", ("s", "e")).select("episode_id", "track", "seq", "mode", "start_ms", "end_ms")


@query(f"WITH {_LOST} SELECT * FROM rp")
def placed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lines without duration in short slots between, after or before the timed lines around them."""
    return _lost(spark, folder)


@query(
    f"""WITH {_LOST}, h AS (SELECT rp.episode_id, rp.track, rp.seq, c.seq AS cue, mode FROM rp JOIN timed c ON c.episode_id = rp.episode_id AND c.track = rp.track AND c.s < c.e AND c.s < rp.end_ms AND c.e > rp.start_ms)
SELECT rp.episode_id, rp.track, count(DISTINCT rp.seq) AS repaired_lines, count(DISTINCT CASE WHEN rp.mode = 'between_neighbors' THEN rp.seq END) AS between_neighbors, count(DISTINCT h.seq) AS overlapping_lines, count(DISTINCT h.cue) AS warned_cues FROM rp LEFT JOIN h USING (episode_id, track, seq) GROUP BY 1, 2"""
)
def alignment_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Of each track: lines placed anew, and the cues they overlap."""
    placed = _lost(spark, folder)
    timed = cues(spark, folder).filter("s < e").select("episode_id", "track", F.col("seq").alias("cue"), "s", "e")
    met = overlap_join(placed, timed, ["episode_id", "track"], ("start_ms", "end_ms"), ("s", "e"))
    a = placed.groupBy("episode_id", "track").agg(F.countDistinct("seq").alias("repaired_lines"), F.countDistinct(F.when(F.col("mode") == "between_neighbors", F.col("seq"))).alias("between_neighbors"))
    b = met.groupBy("episode_id", "track").agg(F.countDistinct("seq").alias("overlapping_lines"), F.countDistinct("cue").alias("warned_cues"))
    return a.join(b, ["episode_id", "track"], "left").fillna(0, ["overlapping_lines", "warned_cues"])
