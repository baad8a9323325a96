import random

import pytest
from pyspark.sql import functions as F

from cuefold.functions import predicates as P
from cuefold.operators import lineage as L
from cuefold.operators import review as V
from cuefold.operators.quality import inspect_chunks
from cuefold.operators.terms import contained_terms
from cuefold.plans.screen import names_in_clip

TEXTS = ["提供", "田中さん", "ちゃんと", "それは何", "はい。", "AM 10:30", "ヤマカワか", "長い文章、とても長い文章です", "答え", "©2024", "ナイトレース", None, ""]


def marks(spark, f):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    return {TEXTS[r.i] for r in df.select("i", f(F.col("t")).alias("x")).filter("x").collect()}


def test_shapes_of_terms(spark):
    assert marks(spark, P.is_broadcast) == {"提供"}
    assert marks(spark, P.is_screen_noise) == {"提供", "©2024", None, ""}
    assert marks(spark, P.is_sentence_like) == {"はい。", "長い文章、とても長い文章です"}
    assert marks(spark, P.is_addressed) == {"田中さん"}
    assert marks(spark, P.is_bare_name) == {"ヤマカワか", "田中さん"}
    assert marks(spark, P.is_trivial) == {"はい。"}
    assert marks(spark, P.is_question_or_setup) == {"それは何"}
    assert {"ナイトレース", "田中さん"} <= marks(spark, P.is_prompt_safe) and "AM 10:30" not in marks(spark, P.is_prompt_safe)
    assert "答え" in marks(spark, P.is_short_fill) & marks(spark, P.is_instruction_like)


def test_text_forms(spark):
    df = spark.createDataFrame([("「★ナイト★」、", "- はい\n\nSpeaker A: いや\n[画面：表 ]\n-- もう", "あいうえおかきかきかきかき"), (None, None, None)], "a string, b string, c string")
    got = [tuple(r) for r in df.select(P.bare_term(F.col("a")), P.tidy_transcript(F.col("b")), P.without_tail_loop(F.col("c"))).collect()]
    assert got == [("ナイト", "-- はい\n-- いや\n[画面: 表]\n-- もう", "あいうえおかきかき"), ("", "", None)]


def test_errors_reviews_and_retries(spark):
    texts = ["429 x", "RESOURCE_EXHAUSTED", "NO_PROGRESS_TIMEOUT", "read timed out", "500 oops", "ssl", "else", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(P.error_class(F.col("t"))).collect()]
    assert got == ["quota", "quota", "no_progress", "timeout", "transient", "transient", "other", "other"]
    df = spark.createDataFrame([("green", 0, 0, False), ("green", 2, 0, False), ("green", 1, 1, False), ("yellow", 1, 0, False), ("red", 1, 0, False), ("green", 0, 0, True)], "s string, c int, l int, b boolean")
    rows = [tuple(r.m) for r in df.select(P.merged_review(F.col("s"), F.col("c"), F.col("l"), F.col("b")).alias("m")).collect()]
    assert rows == [("green", [], None), ("yellow", ["hard_cps"], "cps_only"), ("yellow", ["hard_cps", "line_count"], "structural"), ("yellow", ["hard_cps", "user_review"], "user"), ("red", [], None), ("red", [], None)]
    tries = spark.createDataFrame([(1, "timeout", None), (1, None, "red"), (2, None, "red"), (1, "quota", None), (1, None, "green")], "n int, e string, s string")
    assert [r[0] for r in tries.select(L.retry_reason(F.col("n"), F.col("e"), F.col("s"))).collect()] == ["error", "quality", None, None, None]


def test_leaks_and_loops_are_red(spark):
    chunks = [("a", "-- はい。\n**Segmenting the audio**"), ("b", "-- " + "はい、" * 14), ("c", "-- はい。\n-- いいえ。"), ("d", "-- " + "a b " * 6)]
    got = {r.k: (r.status, r.issues) for r in inspect_chunks(spark.createDataFrame(chunks, "k string, t string"), ["k"], "t").collect()}
    assert got["a"] == ("red", ["partial_turn_marker_loss", "thought_leak"]) and got["b"] == ("red", ["repeated_token_loop"])
    assert got["c"][0] == "green" and got["d"][0] == "green"


def test_terms_in_texts(spark):
    texts = spark.createDataFrame([("e", 1, "ナイトレースの夜"), ("e", 2, None), ("f", 3, "ナイト")], "k string, i int, t string")
    terms = spark.createDataFrame([("e", "ナイト"), ("e", "ナイト"), ("e", "夜店"), ("e", "夜"), ("f", "ナイトレース"), (None, "ナイト")], "k string, w string")
    assert [tuple(r) for r in contained_terms(texts, terms, ["k"], "t", "w").select("i", "w").collect()] == [(1, "ナイト")]


def test_terms_in_texts_join_no_lists_of_letters(spark):
    rng = random.Random(5)
    word = lambda a, z: "".join(rng.choice("あいaé😀 ") for _ in range(rng.randint(a, z)))
    rows = [(rng.choice(["e", "f", None]), i, word(0, 12)) for i in range(300)]
    own = [(k, word(1, 4)) for k in ("e", "f", "g", None) for _ in range(40)]
    texts, terms = spark.createDataFrame(rows, "k string, i int, t string"), spark.createDataFrame(own, "k string, w string")
    got = contained_terms(texts, terms, ["k"], "t", "w")
    assert sorted(map(tuple, got.collect())) == sorted({(k, i, t, w) for k, i, t in rows for j, w in own if k and k == j and len(w) > 1 and w in t})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Broadcast" not in plan


def test_names_in_clip_broadcast_nothing(spark, tmp_path):
    at = "timestamp '2024-01-01' AS loaded_at"
    spark.sql(f"SELECT id AS cue_id, 'e' AS episode_id, 'sdh' AS track, CAST(id AS int) AS seq, CAST(id AS double) AS start_s, id + 1.0D AS end_s, array('さとうです', 'Sato', '夜')[id % 3] AS text, {at} FROM range(6)").write.parquet(f"{tmp_path}/cues.parquet")
    spark.sql(f"SELECT 1L AS seg_id, 'e' AS episode_id, 'a' AS name, 0D AS seg_start, 2D AS seg_end, 1D AS window_start, 2D AS window_dur, '' AS text, {at}").write.parquet(f"{tmp_path}/segments.parquet")
    spark.sql("SELECT 'e' AS episode_id, n AS name, v AS variants FROM VALUES ('佐藤', array('さとう', 'Sato')), ('夜', array('夜')), ('Sato', null) AS t(n, v)").write.parquet(f"{tmp_path}/entities.parquet")
    got = names_in_clip(spark, str(tmp_path))
    assert sorted(map(tuple, got.select("seg", "canonical", "first_ms", "rank").collect())) == [("a", "Sato", 1000, 1), ("a", "佐藤", 1000, 2)]
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_merges_and_guards(spark):
    a = spark.createDataFrame([("x", 1, 0, 5), ("x", 2, 5, 9), ("x", 3, 9, 12)], "k string, i int, s long, e long")
    b = spark.createDataFrame([("x", 1, 0, 5), ("x", 2, 6, 9), ("x", 4, 9, 12)], "k string, i int, s long, e long")
    assert sorted(tuple(r)[1:] for r in V.timing_faults(a, b, ["k"], "i", ("s", "e")).collect()) == [(2, "moved"), (3, "missing"), (4, "extra")]
    rows = spark.createDataFrame([(1, "a", "A"), (2, "b", " "), (3, "c", None)], "i int, t string, x string")
    assert [r.t for r in V.final_texts(rows, "x", "t", partial=True).orderBy("i").collect()] == ["A", "b", "c"]
    with pytest.raises(Exception, match="no answer"):
        V.final_texts(rows, "x", "t").collect()
    done = spark.createDataFrame([(1, "X"), (2, None)], "i int, t string")
    assert [r.t for r in V.take_done(rows, done, ["i"], "t").orderBy("i").collect()] == ["X", "b", "c"]
    c = spark.createDataFrame([("r", 1, 0, 1000, 4), ("r", 2, 1000, 3000, 4), ("r", 3, 3000, 4000, 0)], "k string, i int, s long, e long, n int")
    assert [V.time_at_offset(c, ["k"], ["i"], "s", "e", "n", F.lit(x)).first().at_ms for x in (0, 2, 4, 6, 8)] == [0, 500, 1000, 2000, 3000]
    state = spark.createDataFrame([(1, "m1"), (2, "m1")], "i int, manifest string")
    assert L.resumable(state, "m1").count() == 2
    with pytest.raises(Exception, match="other settings"):
        L.resumable(state, "m2").collect()
    chunks, results = spark.createDataFrame([(1,), (2,)], "c int"), spark.createDataFrame([(1, "x", None, "green")], "c int, text string, error string, st string")
    assert [r.c for r in L.to_do(chunks, results, "c", "st").collect()] == [2]
    with pytest.raises(Exception, match="red"):
        L.to_do(chunks, results.withColumn("st", F.lit("red")), "c", "st").collect()
    usage = spark.createDataFrame([("a", "x-pro", 1_000_000, 500_000), ("a", "none", 5, 5)], "k string, model string, input_tokens long, output_tokens long")
    assert [tuple(r) for r in L.usage_totals(usage, ["k"], {"pro": (1.0, 2.0)}).collect()] == [("a", 1_000_005, 500_005, 2.0)]
    assert [tuple(r) for r in L.first_ids(a, ["k"], "i", 2).collect()] == [("x", 3, [1, 2])]
    ids = spark.createDataFrame([("l", None), ("l", "rparent")], "a string, b string").select(L.started(F.col("a"), F.col("b"))).collect()
    assert ids[1][0] == "rparent" and len(ids[0][0]) == 9
    assert spark.range(1).select(L.manifest_hash(["id"])).first()[0] != spark.range(1, 2).select(L.manifest_hash(["id"])).first()[0]
