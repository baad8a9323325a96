from pyspark.sql import functions as F

from cuefold.streaming.ingest import append_once, event_sessions, follow

SCHEMA = "chunk int, text string, error string"


def test_append_once_survives_restart_and_repeats(spark, tmp_path):
    src, out, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    src.mkdir()

    def run():
        append_once(follow(spark, str(src), SCHEMA), str(out), ["chunk"], str(state), "length(text) > 0 AND error IS NULL").awaitTermination()
        return sorted((r.chunk, r.text) for r in spark.read.parquet(str(out)).collect())

    (src / "1.json").write_text('{"chunk": 1, "text": "a"}\n{"chunk": 1, "text": "a"}\n{"chunk": 2, "text": "", "error": "x"}\n')
    assert run() == [(1, "a")]
    (src / "2.json").write_text('{"chunk": 1, "text": "again"}\n{"chunk": 2, "text": "b"}\n')
    assert run() == [(1, "a"), (2, "b")]
    assert run() == [(1, "a"), (2, "b")]


def test_sessions_on_a_static_table(spark):
    rows = [("u", f"2024-01-01 00:00:{s:02d}") for s in (0, 5, 30)]
    df = spark.createDataFrame(rows, "u string, t string").withColumn("t", F.to_timestamp("t"))
    got = event_sessions(df, "u", "t", "10 seconds", "1 minute")
    assert sorted(r.events for r in got.collect()) == [1, 2]
