import json

import pytest
from pyspark.sql import functions as F

from cuefold.sources import artifacts as A
from cuefold.sources import chunks as C
from cuefold.sources.files import clamp_parts, parse_cues


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value, ensure_ascii=False), encoding="utf-8")
    return str(path)


def test_chunk_files(spark, tmp_path):
    got = C.read_bounds(spark, put(tmp_path / "b.json", [{"start_sec": 0, "end_sec": 1.5}, {"start_sec": 1.5, "end_sec": 3}])).orderBy("chunk").collect()
    assert [tuple(r)[1:] for r in got] == [(0, 0, 1500), (1, 1500, 3000)]
    two = put(tmp_path / "c.json", [{"chunk": 4, "chunk_start_s": 1, "chunk_end_s": 2, "text": "a"}, {"start": 2, "end": 3, "text": "b", "error": "x"}])
    assert [tuple(r)[1:] for r in C.read_chunks(spark, two).collect()] == [(4, 1000, 2000, "a", None), (1, 2000, 3000, "b", "x")]
    with pytest.raises(Exception, match="without times"):
        C.read_chunks(spark, put(tmp_path / "d.json", [{"text": "a"}])).collect()
    put(tmp_path / "set" / "chunk_002.json", {"chunk": 2, "chunk_start_s": 5, "chunk_end_s": 6, "text": "z"})
    put(tmp_path / "set" / "chunk_001.json", {"chunk": 1, "chunk_start_s": 0, "chunk_end_s": 5, "text": "y"})
    put(tmp_path / "set" / "chunk_003.json", "{broken")
    put(tmp_path / "set" / "other.json", {"chunk": 9, "chunk_start_s": 0, "chunk_end_s": 5, "text": "n"})
    assert [r.text for r in C.assembled(C.read_chunk_files(spark, str(tmp_path / "set"))).collect()] == ["y", "z"]
    good, bad = put(tmp_path / "k" / "g.json", [{"start": 0, "end": 1, "text": "a"}]), put(tmp_path / "k" / "h.json", [{"start": 0, "end": 1, "text": "a"}, {"start": 1, "text": "b"}])
    assert C.read_cached(spark, good).count() == 1 and C.read_cached(spark, bad).count() == 0


def test_times_of_parts(spark):
    df = spark.createDataFrame([("e", i, i, i + 1, "x" if i else " ") for i in range(12)], "k string, seq int, s long, e long, t string")
    assert C.prepass(df, ["k"], "t").count() == 11 and C.prepass(df, ["k"], "t", 12).count() == 0
    w = spark.createDataFrame([(1000, 5, 9, [(0.5, 0.75, "a", 1.0)])], "at long, s long, e long, words array<struct<start:double,end:double,word:string,probability:double>>")
    r = C.shifted(w, "at", "s", "e", "words").first()
    assert (r.s, r.e, r.words[0].start, r.words[0].end) == (1005, 1009, 1.5, 1.75)
    parts = spark.createDataFrame([(100, 200, -5, 50), (100, 200, 90, 150), (100, 200, 120, 130)], "a long, z long, s long, e long")
    assert sorted((r.s, r.e) for r in clamp_parts(parts, ("a", "z"), ("s", "e")).collect()) == [(100, 150), (190, 200)]


def test_diagnostics_and_sinks(spark, tmp_path):
    path = put(tmp_path / "diag.json", {"chunks": [{"chunk": 1, "chunk_start_s": 10, "repaired_unaligned_details": [{"line_index_in_chunk": 2, "text": "a", "repair_mode": "after_previous", "repaired_local_start_s": 1, "repaired_local_end_s": 1.08}]}, {"chunk": 2}]})
    assert [tuple(r)[1:] for r in C.repaired_lines(spark, path).collect()] == [(1, 2, "a", "after_previous", 11_000, 11_080)]
    seg = spark.createDataFrame([("e1", 0, 1500, "a", None)], "ep string, s long, e long, text string, words array<struct<start:double,end:double,word:string,probability:double>>")
    C.write_words(seg, str(tmp_path / "out"), ["ep"])
    assert [tuple(r)[:3] for r in spark.read.json(str(tmp_path / "out")).select("start", "end", "text").collect()] == [(0.0, 1.5, "a")]
    with pytest.raises(Exception, match="exists"):
        C.write_words(seg, str(tmp_path / "out"), ["ep"])
    b = C.spoken_blocks(seg.withColumn("who", F.lit("鈴")).withColumn("n", F.lit("x")), "s", "e", "text", "who", "n").first().block
    assert b == "NOTE\nx\n\n00:00.000 --> 00:01.500\n鈴: a\n"
    back = parse_cues(spark.createDataFrame([("k", "WEBVTT\n\n" + b)], "k string, v string"), "k", "v").collect()
    assert [tuple(r)[1:] for r in back] == [(1, 0, 1500, "鈴: a")]
    pairs = spark.createDataFrame([(0, 1000, "a\nb", None)], "s long, e long, x string, y string")
    assert C.side_by_side(pairs, "s", "e", "x", "y").first().shown == "[00:00:00.000 - 00:00:01.000]\nA: a\nA: b\nB: (none)"


def test_artifacts(spark, tmp_path):
    put(tmp_path / "ep" / "translation" / "show_en_reflow.vtt", "WEBVTT")
    put(tmp_path / "ep" / "transcription" / "show_en_ctc_words.json", "[]")
    put(tmp_path / "ep" / "transcription" / "show_en_reflow.json", "[]")
    assert A.word_stems("a_reflow_repaired") == ["a_reflow_repaired", "a_reflow_repaired_ctc_words", "a", "a_ctc_words", "a_reflow", "a_reflow_ctc_words"]
    files = A.listing(spark, str(tmp_path / "ep"), "*.json")
    assert A.aligned_words(files, "show_en_reflow", "translation").first().stem == "show_en_reflow"
    assert A.aligned_words(files, "show_en", "translation").first().stem == "show_en_ctc_words"
    assert A.aligned_words(files, "gone", "translation").count() == 0 and A.aligned_words(files, "show_en", "other").count() == 0
    assert A.best_named(files, {"ctc": 3, "reflow": 2}).first().stem == "show_en_ctc_words" and A.best_named(files, {"none": 1}).count() == 0
    assert A.latest(files).first().stem == "show_en_reflow"
    labels = spark.createDataFrame([("chunks_vad_60s", None), ("semantic_240", 300), ("x", None)], "stem string, t int").select(A.plan_label(F.col("stem"), F.col("t"))).collect()
    assert [r[0] for r in labels] == ["vad_60", "semantic_300", "fixed"]
    frames = spark.createDataFrame([("f1", ["a"]), ("f1", ["b"]), ("f2", None)], "frame string, lines array<string>")
    assert [r.frame for r in A.seen_frames(frames).collect()] == ["f1"]
