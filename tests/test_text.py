import hashlib

from pyspark.sql import functions as F

from cuefold.functions import timecode
from cuefold.functions.text import bigram_jaccard, char_counts, loose, sequence_ratio, squeeze, tidy_lines, wrap_lines
from cuefold.operators import lineage
from cuefold.operators.quality import inspect_chunks
from cuefold.operators.terms import first_entries, keep_longest, term_noise, within_budget
from cuefold.operators.windows import merge_windows
from cuefold.sources.files import parse_cues, read_cues, read_frames, read_glossary, read_rttm, read_segments, words_of
from cuefold.sources.replies import answers, put_back


def one(spark, text, *cols):
    return tuple(spark.createDataFrame([(text,)], "t string").select(*cols).first())


def test_normal_forms(spark):
    assert one(spark, "コーヒー 「本当」？", squeeze("t"), loose("t")) == ("コヒ本当", "こひほんと")
    assert one(spark, None, squeeze("t"), loose("t")) == ("", "")
    assert one(spark, " a  b \r\n\n c", tidy_lines("t"))[0] == "a b\nc"
    assert one(spark, "a b\tc\n d ", *char_counts("t").values()) == (4, 5, 4, 8)


def test_similarity(spark):
    df = spark.createDataFrame([("abc", "abd"), ("a", "a"), (None, "ab"), ("abc", "abc")], "a string, b string")
    got = [(r[0], round(r[1], 3)) for r in df.select(bigram_jaccard(F.col("a"), F.col("b")), sequence_ratio("a", "b")).collect()]
    assert got == [(1 / 3, 0.667), (0.0, 1.0), (0.0, 0.0), (1.0, 1.0)]


def test_wrap(spark):
    assert one(spark, "one two three four five six", wrap_lines(10)("t"))[0] == "one two\nthree four five six"
    assert one(spark, None, wrap_lines(10)("t"))[0] is None


def test_timecodes(spark):
    assert one(spark, "01:02:03.004", timecode.parse(F.col("t")))[0] == 3_723_004
    assert one(spark, "02:03,004", timecode.parse(F.col("t")))[0] == 123_004
    assert one(spark, "x", timecode.parse(F.col("t")))[0] is None
    df = spark.createDataFrame([(59_999,), (3_600_000,), (-5,)], "ms long")
    assert [r[0] for r in df.select(timecode.render(F.col("ms"), hours=False)).collect()] == ["00:59.999", "01:00:00.000", "00:00.000"]
    assert [r[0] for r in df.select(timecode.render(F.col("ms"), ",")).collect()] == ["00:00:59,999", "01:00:00,000", "00:00:00,000"]


VTT = "\ufeffWEBVTT\r\n\r\nNOTE x\r\n\r\n1\r\n00:00:01.000 --> 00:00:02.500 align:start\r\nHello\r\nthere\r\n\r\n00:03.000 --> 00:04.000\r\n\r\n"


def test_cue_files(spark, tmp_path):
    (tmp_path / "a.vtt").write_text(VTT, encoding="utf-8")
    got = [tuple(r)[1:] for r in read_cues(spark, str(tmp_path / "a.vtt")).orderBy("seq").collect()]
    assert got == [(1, 1000, 2500, "Hello\nthere"), (2, 3000, 4000, "")]
    srt = spark.createDataFrame([("k", "1\n00:00:01,000 --> 00:00:02,000\nA\n\n2\n00:00:03,000 --> 00:00:04,000\nB --> C\n"), ("n", None)], "k string, v string")
    assert [tuple(r) for r in parse_cues(srt, "k", "v").orderBy("seq").collect()] == [("k", 1, 1000, 2000, "A"), ("k", 2, 3000, 4000, "B --> C")]


def test_other_files(spark, tmp_path):
    (tmp_path / "a.rttm").write_text("SPEAKER f 1 0.50 1.25 <NA> <NA> s1 <NA> <NA>\nNOISE x\nSPEAKER short\n")
    assert [tuple(r)[1:] for r in read_rttm(spark, str(tmp_path / "a.rttm")).collect()] == [("s1", 500, 1750)]
    (tmp_path / "g.tsv").write_text("source\ttarget\nア\tA\nイ\t\n", encoding="utf-8")
    assert sorted(r.shown for r in read_glossary(spark, str(tmp_path / "g.tsv")).collect()) == ["ア (A)", "イ"]
    (tmp_path / "s.json").write_text('[{"start": 0.5, "end": 1, "text": "x", "words": [{"start": 0.7, "end": 0.8, "word": "b"}, {"start": 0.5, "end": 0.6, "word": "a"}, {"start": 0, "end": 0, "word": " "}]}]')
    seg = read_segments(spark, str(tmp_path / "s.json"))
    assert [(r.seq, r.s, r.e) for r in seg.collect()] == [(1, 500, 1000)]
    assert [(r.i, r.word) for r in words_of(seg, ["path"]).orderBy("i").collect()] == [(1, "a"), (2, "b")]
    (tmp_path / "f.jsonl").write_text('{"frame": "a", "frame_no": 1, "time_sec": 0.5, "lines": ["x"]}\nnot json\n{"frame": "b"}\n')
    assert read_frames(spark, str(tmp_path / "f.jsonl")).count() == 1


def test_replies(spark):
    texts = ['```json\n{"translations": [{"id": "2", "text": "b"}, {"text": "x"}]}\n```', 'so: {"translations": [{"id": 1, "text": "a"}, {"id": 1, "text": "z"}, {"id": 9, "text": "q"}]} ok', "no", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k int, r string")
    got = [(r.k, r.id, r.text) for r in answers(df, ["k"], "r").orderBy("k", "pos").collect()]
    assert got == [(0, 2, "b"), (0, 2, "x"), (1, 1, "a"), (1, 1, "z"), (1, 9, "q")]
    cues = spark.createDataFrame([(1, 1, "s1"), (1, 2, "s2")], "k int, n long, text string")
    out = [(r.n, r.answer, r.fallback) for r in put_back(cues, answers(df, ["k"], "r"), ["k"], "n", "text").orderBy("n").collect()]
    assert out == [(1, "a", False), (2, "s2", True)]


def test_chunk_rules(spark):
    data = [("visual", "[画面: x]"), ("partial", "\n".join(["-- a%d" % i for i in range(8)] + ["b1", "b2"])), ("empty", None), ("bare", "x"), ("loop", "\n".join(["-- あ"] * 12 + ["-- い"])), ("good", "-- a")]
    got = {r.k: (r.status, r.issues) for r in inspect_chunks(spark.createDataFrame(data, "k string, t string"), ["k"], "t").collect()}
    assert got["visual"] == ("red", ["visual_only_chunk"]) and got["partial"] == ("yellow", ["partial_turn_marker_loss"])
    assert got["empty"][0] == "red" and got["bare"] == ("red", ["missing_turn_markers"]) and got["loop"][1] == ["dominant_short_line_loop"] and got["good"] == ("green", [])


def test_terms(spark):
    noise = {r.t: r.n for r in spark.createDataFrame([(t,) for t in ["12:30", "ああああ", "第3話", "名前", "x", "!?", "3月4日", None]], "t string").select("t", term_noise(F.col("t")).alias("n")).collect()}
    assert noise == {"12:30": "time", "ああああ": "one_sign", "第3話": "counter", "名前": None, "x": "too_short", "!?": "signs", "3月4日": "date", None: "too_short"}
    entries = spark.createDataFrame([("e", 1, "Ab", None, None), ("e", 2, "aB", "t", "c"), ("e", 3, "cde", "x", ""), ("e", 4, None, "x", "")], "k string, i int, s string, t string, c string")
    own = first_entries(entries, ["k"], "s", ["i"], "t", "c", 9)
    assert [(r.source, r.target) for r in own.orderBy("rank").collect()] == [("Ab", "Ab"), ("cde", "x")]
    assert within_budget(own, ["k"], "source", ["rank"], 7).count() == 2
    assert within_budget(own, ["k"], "source", ["rank"], 6).count() == 1
    terms = ["abc", "ab", "bc", "c", "xab", "q", "abc", None]
    kept = keep_longest(spark.createDataFrame([("k", t) for t in terms], "k string, t string"), ["k"], "t")
    assert sorted(r.t for r in kept.collect()) == ["abc", "q", "xab"]


def test_windows_merge(spark):
    w = [("k", 0, 2000, "a", "A", 1, 2), ("k", 1000, 3000, "b", "B", 5, 1), ("k", 5000, 7000, "c", "C", 0, 0)]
    got = merge_windows(spark.createDataFrame(w, "k string, start_ms long, end_ms long, primary_text string, secondary_text string, primary_chars int, secondary_chars int"), ["k"], 750)
    assert [(r.start_ms, r.end_ms, r.secondary_text, r.primary_chars) for r in got.orderBy("start_ms").collect()] == [(0, 3000, "A", 5), (5000, 7000, "C", 0)]


def test_lineage(spark):
    rows = [("x", "asr", "2024-01-01 00:00:00", "2024-01-01 00:00:02", "o"), ("y", "asr", "2024-01-02 00:00:00", None, "o")]
    led = spark.createDataFrame(rows, "ledger_run_id string, step string, a string, b string, output_path string").selectExpr("ledger_run_id", "step", "to_timestamp(a) started_at", "to_timestamp(b) finished_at", "output_path")
    got = {r.ledger_run_id: (r.run_id, r.elapsed_ms) for r in lineage.elapsed(led).collect()}
    assert got["x"] == ("r" + hashlib.sha1(b"x").hexdigest()[:8], 2000) and got["y"][1] is None
    assert lineage.latest_outputs(led).first().ledger_run_id == "y"
    assert lineage.preferred(led).first().output_path == "o"


def test_long_chains_of_merges(spark):
    from cuefold.plans.text import effective_ids

    chain = [("e", f"s{i}", f"s{i + 1}" if i < 50 else None) for i in range(51)]
    circle = [("e", "a", "b"), ("e", "b", "a"), ("e", "c", "a"), ("f", "s0", None)]
    got = effective_ids(spark.createDataFrame(chain + circle, "episode_id string, spk_id string, merged_into string")).collect()
    assert {(r.episode_id, r.spk_id): r.effective_id for r in got} == {("e", f"s{i}"): "s50" for i in range(51)} | {("f", "s0"): "s0"}
