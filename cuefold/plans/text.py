"""Queries on cue metrics, quality rules, terms and speakers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import bigram_jaccard, char_counts, contains_either, squeeze
from ..operators import islands
from ..operators.ordered import previous, running_sum
from ..operators.quality import HEADING, THOUGHT, TOKEN, cue_flags, inspect_chunks, preflight
from ..operators.terms import contained_terms, first_entries, keep_longest, term_noise, within_budget
from ..session import table
from ..sources.files import cue_blocks, parse_cues
from .base import CUES, SEGMENTS, cues, segments

QUERIES, ORACLE = {}, {}
_WS = "[\\s　  -   ]+"
_DROPS = "[\\s　、。！？?!…,.，「」『』（）()【】\\[\\]・:：\\-ー]+"


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


@query(
    f"""WITH {CUES} SELECT episode_id, track, seq, greatest(1, e - s) AS duration_ms, greatest(0, e - s) AS duration_ms_0,
  CAST(length(translate(coalesce(text, ''), chr(10) || chr(9) || ' ', '')) AS INT) AS chars_plain,
  CAST(length(translate(coalesce(text, ''), chr(10) || ' ', '')) AS INT) AS chars_lines,
  CAST(length(regexp_replace(coalesce(text, ''), '{_WS}', '', 'g')) AS INT) AS chars_compact,
  CAST(length(regexp_replace(replace(coalesce(text, ''), chr(10), ' '), '^{_WS}|{_WS}$', '', 'g')) AS INT) AS chars_spaced,
  length(regexp_replace(replace(coalesce(text, ''), chr(10), ' '), '^{_WS}|{_WS}$', '', 'g')) * 1000.0::DOUBLE / greatest(1, e - s) AS cps,
  CAST(length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1 AS INT) AS line_count FROM timed"""
)
def cue_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Durations, the four character counts, characters per second and lines of each cue."""
    n = char_counts("text")
    ms = F.greatest(F.lit(1), F.col("e") - F.col("s"))
    breaks = F.length(F.coalesce("text", F.lit(""))) - F.length(F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit("")))
    return cues(spark, folder).select(
        "episode_id", "track", "seq", ms.alias("duration_ms"), F.greatest(F.lit(0), F.col("e") - F.col("s")).alias("duration_ms_0"), *[v.alias(k) for k, v in n.items()],
        (n["chars_spaced"] * F.lit(1000.0) / ms).alias("cps"), (breaks + 1).alias("line_count"),
    )


@query(
    f"""WITH {CUES}, d AS (SELECT *, length(regexp_replace(coalesce(text, ''), '{_WS}', '', 'g')) AS n, greatest(1, e - s) AS ms FROM timed)
SELECT episode_id, track, count(*) AS cues, min(ms) AS min_ms, max(ms) AS max_ms, CAST(sum(ms) AS BIGINT) AS sum_ms, CAST(sum(n) AS BIGINT) AS sum_chars, CAST(max(n) AS INT) AS max_chars,
  CAST(sum(CASE WHEN n * 1000 > 20 * ms THEN 1 ELSE 0 END) AS BIGINT) AS over_20_cps, CAST(sum(CASE WHEN ms < 1000 THEN 1 ELSE 0 END) AS BIGINT) AS under_1_s FROM d GROUP BY 1, 2"""
)
def track_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Durations, sizes and reading speeds of each track."""
    n, ms = char_counts("text")["chars_compact"], F.greatest(F.lit(1), F.col("e") - F.col("s"))
    d = cues(spark, folder).select("episode_id", "track", n.alias("n"), ms.alias("ms"))
    return d.groupBy("episode_id", "track").agg(
        F.count(F.lit(1)).alias("cues"), F.min("ms").alias("min_ms"), F.max("ms").alias("max_ms"), F.sum("ms").alias("sum_ms"), F.sum("n").alias("sum_chars"), F.max("n").alias("max_chars"),
        F.sum(F.when(F.col("n") * 1000 > 20 * F.col("ms"), 1).otherwise(0)).alias("over_20_cps"), F.sum(F.when(F.col("ms") < 1000, 1).otherwise(0)).alias("under_1_s"),
    )


_FLAGS = f"""{CUES}, p AS (SELECT *, regexp_replace(coalesce(text, ''), '[\\s　 ]+', '', 'g') AS t, greatest(0, e - s) AS ms FROM timed),
fl AS (SELECT episode_id, track, seq, s, e, ms < 800 AS short, ms < 500 AS very_short, length(t) <= 4 AS tiny, length(t) <= 8 AS small,
  length(t) > 0 AND position(right(t, 1) IN '。！？!?…」』）)') = 0 AS non_terminal, length(t) = 0 AS empty FROM p)"""


@query(
    f"""WITH {_FLAGS}, n AS (SELECT *, lead(s) OVER (PARTITION BY episode_id, track ORDER BY s, seq) AS nx FROM fl)
SELECT episode_id, track, seq, short, very_short, tiny, small, non_terminal, empty, e < s AS negative, e - s < 500 AS micro, coalesce(nx < e, false) AS overlaps_next FROM n"""
)
def cue_preflight(spark: SparkSession, folder: str) -> DataFrame:
    """Flags of each cue, and structural faults: negative time, too short, overlap with the next."""
    rows = cues(spark, folder).withColumn("block", F.floor(F.col("s") / 600_000))
    own = preflight(rows, ["episode_id", "track"], "s", "e", ["s", "seq"], "block")
    return own.select("episode_id", "track", "seq", *[v.alias(k) for k, v in cue_flags("s", "e", "text").items()], "negative", "micro", "overlaps_next")


@query(
    f"""WITH {_FLAGS}, i AS (SELECT *, row_number() OVER w AS i, lag(short) OVER w AS ps, lead(short) OVER w AS ns, lag(non_terminal) OVER w AS pn, lead(non_terminal) OVER w AS nn
  FROM fl WINDOW w AS (PARTITION BY episode_id, track ORDER BY s, seq)),
b AS (SELECT episode_id, track, i, max(i) OVER (PARTITION BY episode_id, track) AS n FROM i WHERE true),
r AS (SELECT i.episode_id, i.track, i.i, n, empty OR (short AND non_terminal) OR (short AND ((coalesce(ps, false) AND (non_terminal OR pn)) OR (coalesce(ns, false) AND (non_terminal OR nn)))) AS bad
  FROM i JOIN b USING (episode_id, track, i)),
k AS (SELECT episode_id, track, greatest(1, i - 1) AS a, least(n, i + 1) AS z FROM r WHERE bad),
m AS (SELECT *, max(z) OVER (PARTITION BY episode_id, track ORDER BY a ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM k),
g AS (SELECT *, sum(CASE WHEN reach IS NULL OR a > reach + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY episode_id, track ORDER BY a ROWS UNBOUNDED PRECEDING) AS region FROM m)
SELECT episode_id, track, CAST(region - 1 AS BIGINT) AS region_id, min(a) AS start_cue_id, max(z) AS end_cue_id FROM g GROUP BY 1, 2, 3"""
)
def repair_regions(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges of cues that need repair, one cue of context around, adjacent ranges as one."""
    keys = ["episode_id", "track"]
    flags = cue_flags("s", "e", "text")
    rows = cues(spark, folder).withColumn("block", F.floor(F.col("s") / 600_000)).withColumn("one", F.lit(1))
    rows = running_sum(rows.select(*keys, "block", "s", "seq", "one", *[flags[k].alias(k) for k in ("short", "non_terminal", "empty")]), keys, "block", ["s", "seq"], "one", "i")
    w = Window.partitionBy(*keys).orderBy("i")
    near = lambda d: F.coalesce(F.lag("short", d).over(w), F.lit(False)) & (F.col("non_terminal") | F.coalesce(F.lag("non_terminal", d).over(w), F.lit(False)))
    bad = F.col("empty") | (F.col("short") & F.col("non_terminal")) | (F.col("short") & (near(1) | near(-1)))
    size = rows.groupBy(*keys).agg(F.max("i").alias("n"))
    ranges = rows.withColumn("bad", bad).filter("bad").join(size, keys).select(*keys, F.greatest(F.lit(1), F.col("i") - 1).alias("a"), F.least(F.col("n"), F.col("i") + 1).alias("z"))
    wr = Window.partitionBy(*keys).orderBy("a")
    reach = F.max("z").over(wr.rowsBetween(Window.unboundedPreceding, -1))
    grouped = ranges.withColumn("new", F.when(reach.isNull() | (F.col("a") > reach + 1), 1).otherwise(0)).withColumn("region_id", F.sum("new").over(wr.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    return grouped.groupBy(*keys, "region_id").agg(F.min("a").alias("start_cue_id"), F.max("z").alias("end_cue_id"))


_LINES = f"""{SEGMENTS}, l AS (
  SELECT episode_id, name, pos, line, line LIKE '--%' AS spoken, regexp_matches(line, '^\\[画面:.*\\]$') AND NOT line LIKE '--%' AS visual FROM (
    SELECT episode_id, name, unnest(p) AS line, unnest(range(0, len(p))) AS pos FROM (SELECT episode_id, name, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: trim(x, ' ')), lambda x: length(x) > 0) AS p FROM seg))),
c AS (SELECT g.episode_id, g.name, count(line) AS total, coalesce(sum(CAST(spoken AS INT)), 0) AS spoken, coalesce(sum(CAST(visual AS INT)), 0) AS visual, coalesce(max(length(line)), 0) AS longest
  FROM seg g LEFT JOIN l USING (episode_id, name) GROUP BY 1, 2),
sd AS (SELECT episode_id, name, pos, said, count(*) OVER (PARTITION BY episode_id, name) AS speech FROM (SELECT episode_id, name, pos, regexp_replace(regexp_replace(line, '^--\\s*', ''), '\\s+', ' ', 'g') AS said FROM l WHERE spoken OR NOT visual) WHERE said <> ''),
dl AS (SELECT *, row_number() OVER (PARTITION BY episode_id, name ORDER BY n DESC, first) AS rn FROM (SELECT episode_id, name, said, max(speech) AS speech, count(*) AS n, min(pos) AS first FROM sd WHERE length(said) <= 12 GROUP BY 1, 2, 3)),
tk AS (SELECT episode_id, name, bool_or(len(t) >= 12 AND m >= 12 AND m * 4 >= 3 * len(t)) AS looped FROM (SELECT episode_id, name, t, len(list_filter(t, lambda y: y = list_sort(t)[len(t) // 2 + 1])) AS m FROM (SELECT episode_id, name, regexp_extract_all(said, '{TOKEN}') AS t FROM sd)) GROUP BY 1, 2),
th AS (SELECT episode_id, name, bool_or(regexp_matches(line, '{THOUGHT.replace("'", "''")}') OR regexp_matches(line, '{HEADING}') OR line IN ('code', 'Text')) AS thought FROM l GROUP BY 1, 2),
i0 AS (SELECT c.*, coalesce(said, NULL) AS dominant_line, coalesce(n, 0) AS dominant_count, coalesce(thought, false) AS thought, coalesce(looped, false) AS looped, coalesce(n >= 12 AND n * 100 >= 35 * speech, false) AS dom_loop, coalesce(n >= 8 AND n * 4 >= speech, false) AS dom_heavy
  FROM c LEFT JOIN (SELECT * FROM dl WHERE rn = 1) USING (episode_id, name) LEFT JOIN th USING (episode_id, name) LEFT JOIN tk USING (episode_id, name)),
i1 AS (SELECT *, list_sort(list_filter([CASE WHEN thought THEN 'thought_leak' END, CASE WHEN looped THEN 'repeated_token_loop' END, CASE WHEN total = 0 THEN 'empty_chunk' END, CASE WHEN visual > 0 AND total = visual THEN 'visual_only_chunk' END, CASE WHEN spoken = 0 AND visual = 0 AND total > 0 THEN 'missing_turn_markers' END,
    CASE WHEN longest >= 500 THEN 'overlong_line' END, CASE WHEN dom_loop THEN 'dominant_short_line_loop' END], lambda x: x IS NOT NULL)) AS red,
  list_filter([CASE WHEN spoken > 0 AND total - spoken - visual > 0 AND spoken * 100 < 85 * (total - visual) THEN 'partial_turn_marker_loss' END, CASE WHEN dom_heavy AND NOT dom_loop THEN 'dominant_short_line_heavy' END, CASE WHEN visual >= 3 AND total > visual AND visual >= total - visual THEN 'visual_heavy_chunk' END], lambda x: x IS NOT NULL) AS yellow FROM i0),
cs AS (SELECT *, CASE WHEN len(red) > 0 THEN 'red' WHEN len(yellow) > 0 THEN 'yellow' ELSE 'green' END AS status FROM i1)"""


@query(
    f"""WITH {_LINES} SELECT episode_id, name, CAST(total AS INT) AS total_lines, CAST(spoken AS INT) AS spoken_lines, CAST(visual AS INT) AS visual_lines, CAST(longest AS INT) AS longest_line,
  dominant_line, dominant_count, CASE WHEN total > visual THEN spoken / (total - visual)::DOUBLE END AS marker_coverage, list_sort(list_concat(red, yellow)) AS issues, status FROM cs"""
)
def chunk_sanity(spark: SparkSession, folder: str) -> DataFrame:
    """Line counts, the dominant short line, issues and status of each transcript chunk."""
    own = inspect_chunks(segments(spark, folder), ["episode_id", "name"], "text")
    return own.select("episode_id", "name", "total_lines", "spoken_lines", "visual_lines", "longest_line", "dominant_line", "dominant_count", "marker_coverage", "issues", "status")


@query(
    f"""WITH {_LINES} SELECT episode_id, count(*) AS chunks, count(*) FILTER (status = 'green') AS green, count(*) FILTER (status = 'yellow') AS yellow, count(*) FILTER (status = 'red') AS red,
  CASE WHEN count(*) FILTER (status = 'red') > 0 THEN 'repair' WHEN count(*) FILTER (status = 'yellow') > 0 THEN 'review' ELSE 'align' END AS action FROM cs GROUP BY 1"""
)
def sanity_summary(spark: SparkSession, folder: str) -> DataFrame:
    """How many chunks of an episode have each status, and what follows."""
    st = inspect_chunks(segments(spark, folder), ["episode_id", "name"], "text")
    n = lambda s: F.count(F.when(F.col("status") == s, 1)).alias(s)
    per = st.groupBy("episode_id").agg(F.count(F.lit(1)).alias("chunks"), n("green"), n("yellow"), n("red"))
    return per.withColumn("action", F.when(F.col("red") > 0, "repair").when(F.col("yellow") > 0, "review").otherwise("align"))


@query(
    f"""WITH {SEGMENTS}, l AS (SELECT episode_id, name, unnest(range(0, len(p))) AS line_index, unnest(p) AS raw FROM (SELECT episode_id, name, string_split(text, chr(10)) AS p FROM seg)),
t AS (SELECT episode_id, name, CAST(line_index AS INT) AS line_index, trim(raw, ' ') AS line FROM l)
SELECT episode_id, name, line_index, CASE WHEN regexp_matches(line, '^\\[画面: *(.*)\\]$') THEN 'visual' ELSE 'spoken' END AS kind, line LIKE '--%' AS starts_turn,
  CASE WHEN regexp_matches(line, '^\\[画面: *(.*)\\]$') THEN trim(regexp_extract(line, '^\\[画面: *(.*)\\]$', 1), ' ') ELSE trim(regexp_replace(line, '^-- *', ''), ' ') END AS said
FROM t WHERE line <> '' AND (regexp_matches(line, '^\\[画面: *(.*)\\]$') OR trim(regexp_replace(line, '^-- *', ''), ' ') <> '')"""
)
def line_items(spark: SparkSession, folder: str) -> DataFrame:
    """The spoken and visual items of transcript chunks, with their line's place."""
    rows = segments(spark, folder).select("episode_id", "name", F.posexplode(F.split("text", "\n")).alias("line_index", "raw")).withColumn("line", F.trim("raw")).filter("length(line) > 0")
    seen = "^\\[画面: *(.*)\\]$"
    visual = F.col("line").rlike(seen)
    said = F.when(visual, F.trim(F.regexp_extract("line", seen, 1))).otherwise(F.trim(F.regexp_replace("line", "^-- *", "")))
    return rows.select("episode_id", "name", "line_index", F.when(visual, "visual").otherwise("spoken").alias("kind"), F.col("line").startswith("--").alias("starts_turn"), said.alias("said")).filter((F.col("kind") == "visual") | (F.length("said") > 0))


@query(
    f"""WITH v AS (SELECT entity_id, name, unnest(range(1, len(variants) + 1)) AS item_no, unnest(variants) AS variant FROM entities),
n AS (SELECT entity_id, CAST(item_no AS INT) AS item_no, regexp_replace(name, '{_DROPS}', '', 'g') AS a, regexp_replace(variant, '{_DROPS}', '', 'g') AS b FROM v WHERE variant IS NOT NULL AND name IS NOT NULL),
g AS (SELECT *, list_distinct(list_transform(range(1, greatest(length(a), 1)), lambda i: substr(a, i, 2))) AS x, list_distinct(list_transform(range(1, greatest(length(b), 1)), lambda i: substr(b, i, 2))) AS y FROM n)
SELECT entity_id, item_no, CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0::DOUBLE ELSE len(list_intersect(x, y)) / (len(x) + len(y) - len(list_intersect(x, y)))::DOUBLE END AS jaccard,
  length(a) > 0 AND length(b) > 0 AND (contains(a, b) OR contains(b, a)) AS contains_either FROM g"""
)
def name_similarity(spark: SparkSession, folder: str) -> DataFrame:
    """Bigram similarity and containment of a name and its variants."""
    v = table(spark, folder, "entities").select("entity_id", "name", F.posexplode("variants").alias("pos", "variant")).filter("variant IS NOT NULL AND name IS NOT NULL")
    a, b = squeeze("name"), squeeze("variant")
    return v.select("entity_id", (F.col("pos") + 1).alias("item_no"), bigram_jaccard(a, b).alias("jaccard"), contains_either(a, b).alias("contains_either"))


@query(
    """WITH v AS (SELECT entity_id, name, CAST(unnest(range(1, len(variants) + 1)) AS INT) AS item_no, unnest(variants) AS variant FROM entities),
a AS (SELECT entity_id, item_no, ch, count(*) AS n FROM (SELECT entity_id, item_no, unnest(string_split(name, '')) AS ch FROM v WHERE length(name) > 0) GROUP BY 1, 2, 3),
b AS (SELECT entity_id, item_no, ch, count(*) AS n FROM (SELECT entity_id, item_no, unnest(string_split(variant, '')) AS ch FROM v WHERE length(variant) > 0) GROUP BY 1, 2, 3)
SELECT a.entity_id, a.item_no, CAST(sum(least(a.n, coalesce(b.n, 0))) AS BIGINT) AS shared, CAST(sum(a.n) AS BIGINT) AS chars FROM a LEFT JOIN b USING (entity_id, item_no, ch) GROUP BY 1, 2"""
)
def bag_overlap(spark: SparkSession, folder: str) -> DataFrame:
    """How many characters of a name its variant holds too, as bags."""
    v = table(spark, folder, "entities").select("entity_id", "name", F.posexplode("variants").alias("pos", "variant")).withColumn("item_no", F.col("pos") + 1)
    bag = lambda c, n: v.filter(F.length(c) > 0).select("entity_id", "item_no", F.explode(F.filter(F.split(c, ""), lambda x: F.length(x) > 0)).alias("ch")).groupBy("entity_id", "item_no", "ch").agg(F.count(F.lit(1)).alias(n))
    both = bag("name", "n").join(bag("variant", "m"), ["entity_id", "item_no", "ch"], "left")
    return both.groupBy("entity_id", "item_no").agg(F.sum(F.least("n", F.coalesce("m", F.lit(0)))).alias("shared"), F.sum("n").alias("chars"))


@query(
    """WITH t AS (SELECT entry_id, source AS term FROM glossary_entries)
SELECT entry_id, CASE WHEN term IS NULL OR length(term) <= 1 THEN 'too_short' WHEN regexp_full_match(term, '[^\\p{L}\\p{N}_]+') THEN 'signs' WHEN regexp_full_match(term, '\\p{Nd}+') THEN 'digits'
  WHEN length(term) >= 3 AND term = repeat(substr(term, 1, 1), length(term)) THEN 'one_sign'
  WHEN regexp_full_match(term, '\\d{2,4}年(?:\\d{1,2}月(?:\\d{1,2}日)?)?|\\d{1,2}月\\d{1,2}日|\\d{2,4}[/-]\\d{1,2}(?:[/-]\\d{1,2})?') THEN 'date'
  WHEN regexp_full_match(term, '\\d{1,2}:\\d{2}(?::\\d{2})?|\\d{1,2}時(?:\\d{1,2}分)?') THEN 'time' WHEN regexp_full_match(term, '[¥￥]\\s?[\\d,]+|[\\d,]+円') THEN 'money'
  WHEN regexp_full_match(term, '第\\d+[回話]') THEN 'counter' WHEN regexp_full_match(term, '[A-Za-z0-9]{1,2}') THEN 'short_ascii' WHEN regexp_matches(term, '(?i)https?://|www\\.|\\.com|\\.jp') THEN 'address' END AS noise FROM t"""
)
def noise_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Which glossary sources are structural noise, and by which rule."""
    return table(spark, folder, "glossary_entries").select("entry_id", term_noise(F.col("source")).alias("noise"))


_FIRST = """f AS (SELECT * FROM (SELECT episode_id, entry_id, trim(coalesce(source, ''), ' ') AS source, trim(coalesce(target, ''), ' ') AS target, trim(coalesce(context, ''), ' ') AS context,
    row_number() OVER (PARTITION BY episode_id, lower(trim(coalesce(source, ''), ' ')) ORDER BY entry_id) AS rn FROM glossary_entries WHERE length(trim(coalesce(source, ''), ' ')) > 1) WHERE rn = 1),
k AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY entry_id) AS rank FROM f)"""


@query(f"WITH {_FIRST} SELECT episode_id, CAST(rank AS INT) AS rank, source, CASE WHEN target <> '' THEN target ELSE source END AS target, CASE WHEN context <> '' THEN context ELSE 'show-specific term' END AS context FROM k WHERE rank <= 40")
def glossary_entries_once(spark: SparkSession, folder: str) -> DataFrame:
    """Each episode's first 40 glossary entries, one for each source whatever its case."""
    return first_entries(table(spark, folder, "glossary_entries"), ["episode_id"], "source", ["entry_id"], "target", "context", 40)


@query(f"WITH {_FIRST}, u AS (SELECT episode_id, rank, source, sum(length(source) + 2) OVER (PARTITION BY episode_id ORDER BY rank ROWS UNBOUNDED PRECEDING) - 2 AS used FROM k) SELECT episode_id, CAST(rank AS INT) AS rank, source, CAST(used AS BIGINT) AS used_chars FROM u WHERE used <= 120")
def terms_in_budget(spark: SparkSession, folder: str) -> DataFrame:
    """The glossary terms that fit a prompt of 120 characters."""
    own = first_entries(table(spark, folder, "glossary_entries"), ["episode_id"], "source", ["entry_id"], "target", "context", 2**31 - 1)
    return within_budget(own, ["episode_id"], "source", ["rank"], 120).select("episode_id", "rank", "source", "used_chars")


@query(
    """WITH t AS (SELECT DISTINCT episode_id, source FROM glossary_entries WHERE length(source) >= 1)
SELECT episode_id, source FROM t WHERE NOT EXISTS (SELECT 1 FROM t l WHERE l.episode_id = t.episode_id AND l.source <> t.source AND contains(l.source, t.source)) AND episode_id IS NOT NULL"""
)
def collapsed_terms(spark: SparkSession, folder: str) -> DataFrame:
    """Glossary terms that no longer term of the episode contains."""
    return keep_longest(table(spark, folder, "glossary_entries").filter("episode_id IS NOT NULL"), ["episode_id"], "source")


@query(
    f"""WITH {SEGMENTS}, k AS (SELECT episode_id, name, unnest(kata) AS term FROM segments),
fr AS (SELECT DISTINCT k.episode_id, term, CAST(floor(s / 10000) AS BIGINT) AS frame FROM k JOIN seg g USING (episode_id, name) WHERE term IS NOT NULL),
g AS (SELECT *, frame - row_number() OVER (PARTITION BY episode_id, term ORDER BY frame) AS grp FROM fr),
r AS (SELECT episode_id, term, grp, count(*) AS n FROM g GROUP BY 1, 2, 3), a AS (SELECT episode_id, term, CAST(sum(n) AS BIGINT) AS frames, max(n) AS longest_run FROM r GROUP BY 1, 2),
s AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY 10 * frames + 15 * longest_run + 2 * length(term) DESC, term DESC) AS rank FROM a)
SELECT episode_id, term, frames, longest_run, CAST(rank AS INT) AS rank FROM s WHERE rank <= 10"""
)
def top_screen_terms(spark: SparkSession, folder: str) -> DataFrame:
    """An episode's ten best terms by the frames that show them, the longest run and the length."""
    kata = table(spark, folder, "segments").select("episode_id", "name", F.explode("kata").alias("term")).filter("term IS NOT NULL")
    frames = kata.join(segments(spark, folder).select("episode_id", "name", "s"), ["episode_id", "name"]).select("episode_id", "term", F.floor(F.col("s") / 10_000).alias("frame")).filter("frame IS NOT NULL").distinct()
    per = frames.groupBy("episode_id", "term").agg(F.count(F.lit(1)).alias("frames")).join(islands.longest_run(frames, ["episode_id", "term"], "frame"), ["episode_id", "term"])
    score = 10 * F.col("frames") + 15 * F.col("longest_run") + 2 * F.length("term")
    return per.withColumn("rank", F.row_number().over(Window.partitionBy("episode_id").orderBy(score.desc(), F.col("term").desc()))).filter("rank <= 10")


def effective_ids(speakers: DataFrame) -> DataFrame:
    """``episode_id, spk_id, effective_id`` for chains of merges of any length."""
    from ..session import cut

    one = cut(speakers.select("episode_id", "spk_id", "merged_into").dropDuplicates(["episode_id", "spk_id"]))
    known = one.select("episode_id", "spk_id", F.coalesce("merged_into", "spk_id").alias("to"))
    for _ in range(one.count().bit_length() + 1):  # no chain is longer; only circles get this far
        step = known.select("episode_id", F.col("spk_id").alias("to"), F.col("to").alias("far"))
        known = cut(known.join(step, ["episode_id", "to"], "left").select("episode_id", "spk_id", F.coalesce("far", "to").alias("to"), (F.coalesce("far", "to") != F.col("to")).alias("moved")))
        if known.filter("moved").isEmpty():
            break
    merged = one.filter("merged_into IS NOT NULL").select("episode_id", F.col("spk_id").alias("to"))
    return known.join(merged, ["episode_id", "to"], "left_anti").select("episode_id", "spk_id", F.col("to").alias("effective_id"))


@query(
    """WITH RECURSIVE u AS (SELECT DISTINCT episode_id, spk_id, name, merged_into FROM speakers),
r AS (SELECT episode_id, spk_id, spk_id AS got, merged_into AS nxt, 0 AS hops FROM u UNION ALL
  SELECT r.episode_id, r.spk_id, u.spk_id, u.merged_into, hops + 1 FROM r JOIN u ON u.episode_id = r.episode_id AND u.spk_id = r.nxt WHERE hops < 16)
SELECT r.episode_id, r.spk_id, got AS effective_id FROM r WHERE nxt IS NULL"""
)
def effective_speakers(spark: SparkSession, folder: str) -> DataFrame:
    """Each speaker id with the id it ends in after all merges, by doubling the steps until none is left; ids that merge in a circle are left out."""
    return effective_ids(table(spark, folder, "speakers"))


@query("SELECT spk_role, confidence, count(DISTINCT episode_id || '/' || spk_id) AS speakers, count(DISTINCT episode_id) AS episodes FROM speakers GROUP BY 1, 2")
def speaker_roles(spark: SparkSession, folder: str) -> DataFrame:
    """Speakers and episodes by role and confidence."""
    return table(spark, folder, "speakers").groupBy("spk_role", "confidence").agg(F.countDistinct(F.concat("episode_id", F.lit("/"), "spk_id")).alias("speakers"), F.countDistinct("episode_id").alias("episodes"))


@query(
    f"""WITH {CUES}, x AS (SELECT *, CASE WHEN regexp_matches(coalesce(text, ''), '^[^ :：]+: ') THEN 1 ELSE 0 END AS labelled FROM cue)
SELECT episode_id, track, count(*) AS cues, CAST(sum(labelled) AS BIGINT) AS labelled, sum(labelled) * 5 > count(*) AS has_labels FROM x GROUP BY 1, 2"""
)
def speaker_label_share(spark: SparkSession, folder: str) -> DataFrame:
    """Whether over a fifth of a track's cues carry speaker labels."""
    x = cues(spark, folder, timed=False).withColumn("l", F.when(F.coalesce("text", F.lit("")).rlike("^[^ :：]+: "), 1).otherwise(0))
    return x.groupBy("episode_id", "track").agg(F.count(F.lit(1)).alias("cues"), F.sum("l").alias("labelled"), (F.sum("l") * 5 > F.count(F.lit(1))).alias("has_labels"))


_CODE = "lpad(CAST({t} // 3600000 AS VARCHAR), 2, '0') || ':' || lpad(CAST({t} // 60000 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST({t} // 1000 % 60 AS VARCHAR), 2, '0') || '.' || lpad(CAST({t} % 1000 AS VARCHAR), 3, '0')"


@query(f"WITH {CUES} SELECT episode_id, track, seq, {_CODE.format(t='s')} || ' --> ' || {_CODE.format(t='e')} || chr(10) || coalesce(text, '') AS block FROM timed WHERE s >= 0 AND e >= 0")
def vtt_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Each cue as a block of a subtitle file."""
    own = cue_blocks(cues(spark, folder).filter("s >= 0 AND e >= 0"), "s", "e", "text")
    return own.select("episode_id", "track", "seq", F.regexp_replace("block", "\n\\z", "").alias("block"))


@query(f"WITH {CUES} SELECT episode_id, track, seq, s, e, regexp_replace(replace(coalesce(text, ''), chr(65279), ''), '\\s+$', '') AS text FROM timed WHERE s >= 0 AND e >= 0 AND NOT regexp_matches(coalesce(text, ''), '\\n[ \\t]*\\n')")
def vtt_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Cues written as blocks and read back: times and text as they were. A text with an empty line inside can't be written so and is left out."""
    own = cues(spark, folder).filter("s >= 0 AND e >= 0").filter(~F.coalesce("text", F.lit("")).rlike("\\n[ \\t]*\\n"))
    blocks = cue_blocks(own.withColumn("key", F.struct("episode_id", "track", "seq")), "s", "e", "text")
    return parse_cues(blocks.select("key", "block"), "key", "block").select("key.*", F.col("start_ms").alias("s"), F.col("end_ms").alias("e"), "text")


@query(
    f"""WITH {CUES}, t AS (SELECT episode_id, track, seq, s, text FROM timed)
SELECT episode_id, track, seq, lag(text, 1) OVER w AS one_before, lag(text, 2) OVER w AS two_before FROM t WINDOW w AS (PARTITION BY episode_id, track ORDER BY s, seq)"""
)
def rolling_context(spark: SparkSession, folder: str) -> DataFrame:
    """Each cue with the texts of the two before it."""
    keys = ["episode_id", "track"]
    rows = cues(spark, folder).withColumn("block", F.floor(F.col("s") / 600_000)).withColumn("own", F.struct("text"))
    rows = previous(rows, keys, "block", ["s", "seq"], "own", "one").withColumn("both", F.struct(F.col("one.text").alias("text")))
    rows = previous(rows, keys, "block", ["s", "seq"], "both", "two")
    return rows.select(*keys, "seq", F.col("one.text").alias("one_before"), F.col("two.text").alias("two_before"))


@query(f"WITH {SEGMENTS}, x AS (SELECT g.episode_id, g.name, t.name AS term FROM seg g JOIN (SELECT DISTINCT episode_id, source AS name FROM glossary_entries WHERE length(source) > 1) t ON t.episode_id = g.episode_id AND contains(g.text, t.name)) SELECT episode_id, name, list_sort(list(term)) AS terms FROM x GROUP BY 1, 2")
def terms_said(spark: SparkSession, folder: str) -> DataFrame:
    """Substring recall: the glossary terms of the episode that a segment's text holds."""
    terms = table(spark, folder, "glossary_entries").filter("length(source) > 1").select("episode_id", F.col("source").alias("term")).distinct()
    said = contained_terms(segments(spark, folder).select("episode_id", "name", "text"), terms, ["episode_id"], "text", "term")
    return said.groupBy("episode_id", "name").agg(F.array_sort(F.collect_set("term")).alias("terms"))


@query(
    """WITH d AS (SELECT CAST(label AS INT) AS label, i, avg(v) AS m FROM (SELECT label, unnest(range(1, len(embedding) + 1)) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings) GROUP BY 1, 2) SELECT label, count(*) AS dims, round(sum(m * m), 6) AS norm2 FROM d GROUP BY 1"""
)
def label_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """The squared length of each label's mean vector: pass two of clustering starts from these."""
    v = table(spark, folder, "embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    m = v.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    return m.groupBy("label").agg(F.count(F.lit(1)).alias("dims"), F.round(F.sum(F.col("m") * F.col("m")), 6).alias("norm2"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, event_type FROM events WHERE props IS NOT NULL")
def event_pages(spark: SparkSession, folder: str) -> DataFrame:
    """A field read from JSON text."""
    return table(spark, folder, "events").filter("props IS NOT NULL").select("event_id", F.get_json_object("props", "$.k").alias("k"), "event_type")
