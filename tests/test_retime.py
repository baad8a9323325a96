import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cuefold.functions import rules as R
from cuefold.operators import islands, segment
from cuefold.operators import retime as T
from cuefold.plans import sequence

CUES = st.lists(st.tuples(st.integers(0, 4000), st.integers(1, 12_000), st.sampled_from(["a", "hello there", "x" * 50, "one.\ntwo words here and more of them"])), max_size=12)


def placed(steps):
    at, out = 0, []
    for gap, size, text in steps:
        out.append((at + gap, at + gap + size, text))
        at += gap + size
    return out


@settings(max_examples=80, deadline=None)
@given(CUES)
def test_shrinking_growing_and_halving_keep_order_and_text(steps):
    cues = placed(steps)
    for f in (T.shrink_sparse, T.grow_short, T.halve_long):
        out = f(cues)
        assert all(e > s for s, e, _ in out) and all(a[1] <= b[0] for a, b in zip(out, out[1:]))
        assert "\n".join(t for *_, t in out) == "\n".join(t for *_, t in cues)


def test_rules_of_time():
    assert T.shrink_sparse([(0, 20_000, "abc")]) == [(6_500, 13_500, "abc")]
    assert T.grow_short([(0, 1000, "x"), (1500, 1700, "y" * 14), (3000, 4000, "z")]) == [(0, 1000, "x"), (1100, 2100, "y" * 14), (3000, 4000, "z")]
    assert T.grow_short([(0, 100, "x")]) == [(0, 100, "x")]
    assert T.halve_long([(0, 8000, "aaaa.\nbbbb")]) == [(0, 4444, "aaaa."), (4444, 8000, "bbbb")]
    assert T.few_lines([(0, 1, "a\nb\nc")]) == [(0, 1, "a\nb")]


def test_points_go_to_the_nearest():
    cues = [(0, 1000, "a"), (2000, 3000, "b")]
    assert T.attach_points(cues, [(1100, "x")])[0][2] == "a\nx"
    assert T.attach_points(cues, [(1900, "x"), (1940, "y")])[1] == (1900, 3000, "x\ny\nb")
    assert T.attach_points(cues, [(1500, "why?")])[1][2] == "why?\nb" and T.attach_points(cues, [(1500, "so")])[0][2] == "a\nso"
    assert T.attach_points([], [(1, "x")]) == []


def test_reflow_of_a_group():
    p = pd.DataFrame({"s": [0, 300, 5000, 9000], "e": [200, 4000, 5000, 9500], "text": ["a", "b", "note", None]})
    out = T.reflow_cues()(p)
    assert out["text"].tolist() == ["a\nb"] and out["start_ms"].tolist() == [0]


def test_rules(spark):
    df = spark.createDataFrame([("あ" * 5, "big-pro-x", 2_000_000), (None, "other", None), ("はい、" * 8, "flash", 5), ("x" * 500, "x", 1), ("abcdabcdabcd", "x", 1)], "t string, m string, n long")
    rows = df.select(R.loop_issue(F.col("t")).alias("l"), R.top_gram_count(F.col("t")).alias("g"), R.cjk_share(F.col("t")).alias("c"), R.token_cost(F.col("n"), F.col("m"), {"pro-x": 3, "pro": 1, "flash": 2}).alias("p")).collect()
    assert [r.l for r in rows] == [None, None, "repeated_clause", "line_too_long", None]
    assert [r.g for r in rows] == [2, 0, 7, 497, 3] and rows[0].c == 1.0 and rows[1].c == 0.0
    assert [rows[0].p, rows[1].p, rows[3].p] == [6.0, None, None]
    one = spark.createDataFrame([("Please retry in 3.5s ... 'retryDelay': '9s'", " Title ", "HIGH", " Ab c! ")], "m string, k string, r string, s string")
    got = one.select(R.retry_seconds(F.col("m")), R.kind_of(F.col("k"), ["title_card"]), R.rank_of(F.col("r")), R.slug(F.col("s")), R.backoff_seconds(F.lit(2)), R.vocab_share(F.col("k"), "tle")).first()
    assert got[:5] == (9.0, "title_card", "high", "ab-c", 15.0) and 0 < got[5] < 1


def test_words_are_made_after_the_one_shuffle(spark, tmp_path):
    rng = random.Random(3)
    texts = ["one two three.", "a", " \n ", "こんにちは、これは長いせりふです", "b c\nd  e", "long words here", None, ""]
    rows, at = [], 0
    for i in range(400):
        at += rng.choice([0, 200, 900, 3_000, 15_000, 19_999, 20_001, 45_000, 700_000])
        rows.append((i, "e", rng.choice(["x", "y"]), i, at / 1000, (at + rng.choice([-5, 0, 2, 800, 4_000, 30_000, 90_000])) / 1000, rng.choice(texts)))
    df = spark.createDataFrame(rows, "cue_id long, episode_id string, track string, seq int, start_s double, end_s double, text string").withColumn("loaded_at", F.current_timestamp())
    df.write.parquet(f"{tmp_path}/cues.parquet")
    got = sequence.reflowed_words(spark, str(tmp_path))
    words, keys = sequence.spoken_words(spark, str(tmp_path)), ["episode_id", "track"]
    bounds = words.groupBy(*keys).agg(F.min("s").alias("first"), F.max("e").alias("last"))
    parts = islands.whole_sessions(words, keys, "s", "e", ["s", "seq", "i"], 20_000, strict=True).join(bounds, keys)
    by_words = segment.by_group(parts, [*keys, "block"], ["s", "seq", "i"], T.reflow_words(), "cue int, start_ms long, end_ms long, text string")
    rows = sorted(map(tuple, got.collect()))
    assert len({r[2] for r in rows}) > 20 and rows == sorted(map(tuple, by_words.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1
