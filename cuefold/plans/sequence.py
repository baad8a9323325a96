"""Queries on segmentation. Where SQL can walk the same steps it states them by recursion; the rest has unit tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import islands, matching, repair, retime, segment
from ..session import table
from .base import CUES, INTERVALS, cues, intervals, segments

QUERIES, ORACLE = {}, {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


@query(
    f"""WITH RECURSIVE {CUES}, o AS (SELECT episode_id, track, s, e, row_number() OVER (PARTITION BY episode_id, track ORDER BY s, seq) AS i FROM timed),
w AS (SELECT episode_id, track, i, s, e, 0 AS batch, i AS a, s AS s0 FROM o WHERE i = 1
  UNION ALL SELECT o.episode_id, o.track, o.i, o.s, o.e,
    CASE WHEN o.i - w.a >= 12 OR o.e - w.s0 > 45000 THEN w.batch + 1 ELSE w.batch END, CASE WHEN o.i - w.a >= 12 OR o.e - w.s0 > 45000 THEN o.i ELSE w.a END, CASE WHEN o.i - w.a >= 12 OR o.e - w.s0 > 45000 THEN o.s ELSE w.s0 END
  FROM w JOIN o ON o.episode_id = w.episode_id AND o.track = w.track AND o.i = w.i + 1)
SELECT episode_id, track, CAST(batch AS INT) AS batch, CAST(min(i) AS INT) AS first_cue, CAST(max(i) AS INT) AS last_cue, min(s) AS start_ms, arg_max(e, i) AS end_ms FROM w GROUP BY 1, 2, 3"""
)
def cue_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Batches of 12 cues or 45 s."""
    return segment.by_group(cues(spark, folder), ["episode_id", "track"], ["s", "seq"], segment.batches(), segment.BATCH_COLUMNS)


@query(
    f"""WITH RECURSIVE {CUES}, v AS (SELECT episode_id, track, s, row_number() OVER (PARTITION BY episode_id, track ORDER BY s, seq) AS i FROM timed),
w AS (SELECT episode_id, track, i, s, 0 AS cluster, s AS f FROM v WHERE i = 1 UNION ALL
  SELECT v.episode_id, v.track, v.i, v.s, CASE WHEN v.s - w.f > 5000 THEN w.cluster + 1 ELSE w.cluster END, CASE WHEN v.s - w.f > 5000 THEN v.s ELSE w.f END FROM w JOIN v ON v.episode_id = w.episode_id AND v.track = w.track AND v.i = w.i + 1),
n AS (SELECT episode_id, track, cluster, min(s) AS first_ms, max(s) AS last_ms, CAST(count(*) AS INT) AS size FROM w GROUP BY 1, 2, 3)
SELECT episode_id, track, first_ms, last_ms, size FROM n"""
)
def start_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Starts within 5 s of a cluster's first."""
    # a pause of over 5 s ends a cluster whatever lies before it
    own = cues(spark, folder).select("episode_id", "track", "s", (F.col("s") + 1).alias("e"), "seq")
    own = islands.whole_sessions(own, ["episode_id", "track"], "s", "e", ["s", "seq"], 5_000, strict=True)
    return segment.by_group(own, ["episode_id", "track", "block"], ["s", "seq"], segment.near_first(5_000), segment.CLUSTER_COLUMNS).select("episode_id", "track", "first_ms", "last_ms", "size")


@query(
    f"""WITH RECURSIVE {CUES}, v AS (SELECT episode_id, track, s, e, row_number() OVER (PARTITION BY episode_id, track ORDER BY s, seq) AS i FROM timed WHERE s < e),
w AS (SELECT episode_id, track, i, e - s > 25000 AS big, 0 AS c, s AS a, e AS z FROM v WHERE i = 1 UNION ALL
  SELECT v.episode_id, v.track, v.i, e - s > 25000, CASE WHEN big OR e - s > 25000 OR (z - a >= 10000 AND (s - z > 1500 OR e - a > 25000 OR (z - a >= 18000 AND s - z > 300))) THEN c + 1 ELSE c END,
    CASE WHEN big OR e - s > 25000 OR (z - a >= 10000 AND (s - z > 1500 OR e - a > 25000 OR (z - a >= 18000 AND s - z > 300))) THEN s ELSE a END, e FROM w JOIN v ON v.episode_id = w.episode_id AND v.track = w.track AND v.i = w.i + 1),
g AS (SELECT episode_id, track, c, min(a) AS a, arg_max(z, i) AS z, CASE WHEN bool_or(big) THEN (arg_max(z, i) - min(a)) // 18000 + 1 ELSE 1 END AS n FROM w GROUP BY 1, 2, 3), p AS (SELECT *, unnest(range(0, n)) AS k FROM g)
SELECT episode_id, track, CAST(row_number() OVER (PARTITION BY episode_id, track ORDER BY c, k) - 1 AS INT) AS chunk, a + (z - a) * k // n AS start_ms, a + (z - a) * (k + 1) // n AS end_ms FROM p"""
)
def speech_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Speech packed for recognition."""
    return segment.by_group(cues(spark, folder).filter("s < e"), ["episode_id", "track"], ["s", "seq"], segment.pack_speech(), segment.SPAN_COLUMNS)


@query()
def covering_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks that cover each episode, cut in silences of a track."""
    return segment.by_group(cues(spark, folder).filter("s < e"), ["episode_id", "track"], ["s", "seq"], segment.cover(0), segment.SPAN_COLUMNS)


def spoken_words(spark: SparkSession, folder: str) -> DataFrame:
    """``episode_id, track, seq, i, s, e, word``: the words of cues, or the characters where no spaces part them, timed evenly."""
    own = cues(spark, folder).filter("s < e AND length(text) > 0")
    parts = F.split(F.regexp_replace("text", "\\s+", " "), " ")
    dense = F.filter(F.split(F.regexp_replace("text", "\\s+", ""), ""), lambda x: F.length(x) > 0)
    words = own.withColumn("dense", F.size(parts) * 12 < F.length("text")).withColumn("w", F.when(F.col("dense"), dense).otherwise(F.transform(F.filter(parts, lambda x: F.length(x) > 0), lambda x: F.concat(x, F.lit(" ")))))
    words = words.withColumn("n", F.size("w")).select("episode_id", "track", "seq", "n", F.posexplode("w").alias("i", "word"), "s", "e")
    at = lambda i: F.col("s") + F.floor((F.col("e") - F.col("s")) * i / F.col("n"))
    words = words.select("episode_id", "track", "seq", "i", at(F.col("i")).alias("ws"), at(F.col("i") + 1).alias("we"), "word")
    return words.withColumnsRenamed({"ws": "s", "we": "e"})


@query()
def reflowed_words(spark: SparkSession, folder: str) -> DataFrame:
    """Words as new cues. Cues are shuffled once and a track's words made as they pass by: the words are many times the cues."""
    own = cues(spark, folder, together=True).filter("s < e").filter(F.col("text").rlike("\\S")).sortWithinPartitions("episode_id", "track", "s", "seq")
    return own.mapInArrow(_reflowed, "episode_id string, track string, block long, cue int, start_ms long, end_ms long, text string")


def _reflowed(batches):
    import pyarrow as pa

    types = {"episode_id": pa.string(), "track": pa.string(), "block": pa.int64(), "cue": pa.int32(), "start_ms": pa.int64(), "end_ms": pa.int64(), "text": pa.string()}
    rows = (r for b in batches for r in zip(zip(*(b.column(c).to_pylist() for c in ("episode_id", "track"))), *(b.column(c).to_pylist() for c in ("seq", "s", "e", "text"))))
    flush = lambda out: pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), types.values())], list(types))
    out = []
    for key, block, own in retime.reflow_tracks(rows):
        out += [(*key, block, i, *c) for i, c in enumerate(own, 1)]
        if len(out) >= 10_000:
            yield flush(out)
            out = []
    if out:
        yield flush(out)


@query()
def packed_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Transcript lines as cues of two lines."""
    own = segments(spark, folder).withColumn("turn", F.col("text").startswith("-"))
    # a gap of over 3.5 s ends a cue whatever lies before it
    own = islands.whole_sessions(own.select("episode_id", "name", "s", "e", "text", "turn"), ["episode_id"], "s", "e", ["s", "name"], 3_500, strict=True)
    return segment.by_group(own, ["episode_id", "block"], ["s", "name"], segment.pack_lines(), segment.CUE_COLUMNS)


@query(
    f"""WITH RECURSIVE {INTERVALS}, o AS (SELECT *, row_number() OVER (ORDER BY s, event_id) AS i, lag(event_type) OVER (ORDER BY s, event_id) AS p FROM iv),
r AS (SELECT *, sum(CASE WHEN p = event_type THEN 0 ELSE 1 END) OVER (ORDER BY i ROWS UNBOUNDED PRECEDING) AS run FROM o), x AS (SELECT *, row_number() OVER (PARTITION BY run ORDER BY i) AS k FROM r),
w AS (SELECT run, k, event_type, s AS a, e AS z, 0 AS part FROM x WHERE k = 1 UNION ALL
  SELECT x.run, x.k, x.event_type, CASE WHEN s - z <= 1000 AND e - a <= 30000 THEN a ELSE s END, CASE WHEN s - z <= 1000 AND e - a <= 30000 THEN greatest(e, z) ELSE e END, CASE WHEN s - z <= 1000 AND e - a <= 30000 THEN part ELSE part + 1 END FROM w JOIN x ON x.run = w.run AND x.k = w.k + 1)
SELECT min(a) AS start_ms, max(z) AS end_ms, min(event_type) AS who, CAST(count(*) AS INT) AS parts FROM w GROUP BY run, part"""
)
def merged_speech(spark: SparkSession, folder: str) -> DataFrame:
    """Neighbouring intervals of one kind as one, up to 30 s. Runs of one kind never meet, so a few hundred are a task's work."""
    own = intervals(spark, folder).withColumn("who", F.col("event_type")).withColumn("day", F.floor(F.col("s") / 86_400_000))
    own = islands.runs(own, [], "day", ["s", "event_id"], "who").withColumn("part", F.floor(F.col("run") / 500))
    return segment.by_group(own, ["part"], ["s", "event_id"], segment.merge_same(), segment.MERGED_COLUMNS).drop("part")


@query()
def cluster_labels(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of each label clustered by average linkage of cosine distances."""
    import numpy as np
    import pandas as pd

    def run(p: pd.DataFrame) -> pd.DataFrame:
        lab = segment.average_linkage(np.array(p["embedding"].tolist(), float), 0.7)
        sizes = pd.Series(lab).value_counts().sort_index().sort_values(ascending=False, kind="stable")
        rank = {k: i for i, k in enumerate(sizes.index)}
        return pd.DataFrame({"vec_id": p["vec_id"], "cluster": [rank[k] for k in lab]})

    return segment.by_group(table(spark, folder, "embeddings"), ["label"], ["vec_id"], run, "vec_id long, cluster int")


@query()
def greedy_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Segments and labelled cues of an episode matched once each by overlap, with what is left over."""
    a = segments(spark, folder).select("episode_id", F.lit(0).alias("side"), F.col("name").alias("k"), "s", "e")
    b = cues(spark, folder).filter("track = 'sdh'").select("episode_id", F.lit(1).alias("side"), F.lpad(F.col("seq").cast("string"), 12, "0").alias("k"), "s", "e")

    def run(p):
        import pandas as pd

        x, y = p[p["side"] == 0], p[p["side"] == 1]
        spans = lambda q: list(zip(q["s"].tolist(), q["e"].tolist()))
        pairs = matching.greedy_overlap(spans(x), spans(y))
        name = lambda q, i: None if i is None else q["k"].iloc[i]
        return pd.DataFrame([(name(x, i), name(y, j)) for i, j in pairs], columns=["seg", "cue"])

    return segment.by_group(a.unionByName(b), ["episode_id"], ["side", "s", "k"], run, "seg string, cue string")


@query()
def screen_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Frames of 10 s that show the same terms as spans."""
    kata = table(spark, folder, "segments").filter("kata IS NOT NULL").select("episode_id", "name", F.explode("kata").alias("term")).distinct()
    frames = kata.join(segments(spark, folder).select("episode_id", "name", "s"), ["episode_id", "name"]).select("episode_id", F.floor(F.col("s") / 10_000).alias("n"), "term").distinct()
    own = frames.groupBy("episode_id", "n").agg(F.array_sort(F.collect_set("term")).alias("terms"))

    def run(p):
        import pandas as pd

        spans = matching.frame_spans([(n, list(t)) for n, t in zip(p["n"].tolist(), p["terms"])])
        return pd.DataFrame([(i, s["first"], s["last"], sorted(s["counts"])) for i, s in enumerate(spans)], columns=["span", "first", "last", "terms"])

    return segment.by_group(own, ["episode_id"], ["n"], run, "span int, first long, last long, terms array<string>")


@query()
def picked_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Eight segments of an episode with the most terms and names, 5 s apart."""
    n = table(spark, folder, "segments").groupBy("episode_id", "name").agg(F.max(2 * F.coalesce(F.size("kata"), F.lit(0)) + 3 * F.coalesce(F.size("names"), F.lit(0))).alias("score"))
    own = segments(spark, folder).select("episode_id", "name", "s").join(n, ["episode_id", "name"])

    def run(p):
        return p.iloc[matching.pick_apart(list(zip(p["s"].tolist(), p["score"].tolist())), 8)][["name", "s", "score"]]

    return segment.by_group(own, ["episode_id"], ["s", "name"], run, "name string, s long, score int")


@query()
def two_pass_clusters(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors of each label clustered in two passes; those with a positive first coordinate stand for the long turns."""
    import numpy as np

    def run(p):
        import pandas as pd

        x = np.array(p["embedding"].tolist(), float)
        return pd.DataFrame({"vec_id": p["vec_id"], "cluster": matching.two_pass(x, np.where(x[:, 0] >= 0, 3_000, 500))})

    return segment.by_group(table(spark, folder, "embeddings"), ["label"], ["vec_id"], run, "vec_id long, cluster int")


@query()
def without_short_cues(spark: SparkSession, folder: str) -> DataFrame:
    """Cues with those under a second or three letters joined to a neighbour, never over the start of a turn."""
    import pandas as pd

    def run(p):
        out = matching.merge_short(list(zip(p["s"].tolist(), p["e"].tolist(), p["text"], p["text"].str.startswith("-"))))
        return pd.DataFrame([(i, s, e, t) for i, (s, e, t, _) in enumerate(out, 1)], columns=["cue", "start_ms", "end_ms", "text"])

    # what lies over 7 s apart never joins
    own = islands.whole_sessions(cues(spark, folder).filter("s < e AND length(text) > 0"), ["episode_id", "track"], "s", "e", ["s", "seq"], 7_000, strict=True)
    return segment.by_group(own, ["episode_id", "track", "block"], ["s", "seq"], run, "cue int, start_ms long, end_ms long, text string")


@query(
    f"""WITH RECURSIVE {CUES}, v AS (SELECT episode_id, track, seq, s, e, row_number() OVER (PARTITION BY episode_id, track ORDER BY s, seq) AS i FROM timed),
w AS (SELECT episode_id, track, i, seq, s AS a, greatest(e, s + 1) AS z FROM v WHERE i = 1 UNION ALL SELECT v.episode_id, v.track, v.i, v.seq, greatest(s, z), greatest(e, greatest(s, z) + 1) FROM w JOIN v ON v.episode_id = w.episode_id AND v.track = w.track AND v.i = w.i + 1)
SELECT episode_id, track, CAST(seq AS INT) AS seq, a AS start_ms, z AS end_ms FROM w"""
)
def forward_cues(spark: SparkSession, folder: str) -> DataFrame:
    """Cues pushed forward until none starts before the one before it ends."""
    import pandas as pd

    def run(p):
        return pd.DataFrame([(q, s, e) for q, (s, e) in zip(p["seq"].tolist(), matching.rising(list(zip(p["s"].tolist(), p["e"].tolist()))))], columns=["seq", "start_ms", "end_ms"])

    return segment.by_group(cues(spark, folder), ["episode_id", "track"], ["s", "seq"], run, "seq int, start_ms long, end_ms long")


@query()
def reflowed_cues(spark: SparkSession, folder: str) -> DataFrame:
    """Cues merged, halved and retimed."""
    return segment.by_group(cues(spark, folder).filter("text IS NOT NULL"), ["episode_id", "track"], ["s", "seq"], retime.reflow_cues(), "cue int, start_ms long, end_ms long, text string")


def _with_words(f, columns: str):
    """A query on cues beside the words of their track: ``f(cues, words)`` for each episode's track, as rows of ``columns``."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        import pandas as pd

        names = [c.split()[0] for c in columns.split(", ")]
        # the words hold more than the cues: a cue's text may be blank, and cues are those of the reflow
        words = spoken_words(spark, folder).select("episode_id", "track", F.lit(1).alias("side"), "s", "e", F.col("word").alias("text"), "seq", "i")
        own = cues(spark, folder).filter("s < e AND length(text) > 0").select("episode_id", "track", F.lit(0).alias("side"), "s", "e", "text", "seq", F.lit(0).alias("i"))

        def one(p):
            a, b = p[p["side"] == 0], p[p["side"] == 1]
            rows = lambda q: list(zip(q["s"].tolist(), q["e"].tolist(), q["text"]))
            return pd.DataFrame(f(rows(a), rows(b), a["seq"].tolist()), columns=names)

        return segment.by_group(own.unionByName(words), ["episode_id", "track"], ["side", "s", "seq", "i"], one, columns)

    return run


def _spans(cue_rows, words, seqs):
    got = repair.match_words(cue_rows, words)
    return [(q, g[0], g[1], g[2]) for q, g in zip(seqs, got) if g]


def _repaired(cue_rows, words, seqs):
    got = repair.match_words(cue_rows, words)
    out, _ = repair.repair([[*c, g[0], g[1]] for c, g in zip(cue_rows, got) if g], words)
    return [(i, s, e, t.strip()) for i, (s, e, t, _, _) in enumerate(out, 1)]


@query()
def word_spans(spark: SparkSession, folder: str) -> DataFrame:
    """The words that each cue says, and how they were found."""
    return _with_words(_spans, "seq int, first_word int, last_word int, how string")(spark, folder)


@query()
def repaired_cues(spark: SparkSession, folder: str) -> DataFrame:
    """Cues after all repairs: short ones joined or widened, long ones split at their words."""
    return _with_words(_repaired, "cue int, start_ms long, end_ms long, text string")(spark, folder)


@query()
def sentence_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Chunks that cover each episode, cut in silences after the end of a sentence."""
    import pandas as pd

    def run(p):
        rows = list(zip(p["s"].tolist(), p["e"].tolist(), p["text"]))
        gaps, at = [], rows[0][1]
        for s, e, _ in rows[1:]:
            if s - at >= 750:
                gaps.append((at, s))
            at = max(at, e)
        return pd.DataFrame([(i, *c) for i, c in enumerate(repair.sentence_cuts(gaps, rows, int(p["e"].max())))], columns=["chunk", "start_ms", "end_ms"])

    return segment.by_group(cues(spark, folder).filter("s < e"), ["episode_id", "track"], ["s", "seq"], run, segment.SPAN_COLUMNS)


def _two_tracks(spark: SparkSession, folder: str) -> DataFrame:
    """Japanese cues and the English ones of an episode, sides 0 and 1, in order of time."""
    own = cues(spark, folder).filter("s < e AND length(text) > 0")
    side = F.when(F.col("track") == "ja_asr", 0).when(F.col("track") == "en_sub", 1)
    return own.withColumn("side", side).filter("side IS NOT NULL").select("episode_id", "side", "s", "e", "text", "seq")


@query()
def warped_draft(spark: SparkSession, folder: str) -> DataFrame:
    """For each Japanese cue the English ones that fall on it, by the lines between what both say alike."""
    import pandas as pd

    def run(p):
        a, b = ([tuple(r) for r in p[p["side"] == k][["s", "e", "text"]].itertuples(index=False)] for k in (0, 1))
        seqs = [p[p["side"] == k]["seq"].tolist() for k in (0, 1)]
        rows = []
        if a and b:
            rows = [(seqs[0][k], [seqs[1][j] for j in got], alone) for k, got, alone in repair.draft(a, b, repair.text_anchors(a, b))]
        return pd.DataFrame(rows, columns=["seq", "reference", "fallback"])

    return segment.by_group(_two_tracks(spark, folder), ["episode_id"], ["side", "s", "seq"], run, "seq int, reference array<int>, fallback boolean")
