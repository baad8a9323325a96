import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from cuefold.operators import segment


def frame(pairs, **more):
    return pd.DataFrame([(s, e) for s, e in pairs], columns=["s", "e"]).assign(**more)


def test_batches_by_count_and_time():
    p = frame([(i * 1000, i * 1000 + 1000) for i in range(13)])
    assert segment.batches(12, 45_000)(p)[["first_cue", "last_cue"]].values.tolist() == [[1, 12], [13, 13]]
    long = frame([(0, 60_000), (60_000, 61_000)])
    assert segment.batches()(long)["last_cue"].tolist() == [1, 2]
    assert len(segment.batches()(frame([]))) == 0


def test_cover_is_whole_and_cut_in_silence():
    assert segment.cover(100_000)(frame([(0, 100_000)]))[["start_ms", "end_ms"]].values.tolist() == [[0, 90_000], [90_000, 100_000]]
    p = frame([(0, 50_000), (55_000, 100_000), (103_000, 200_000)])
    out = segment.cover(200_000)(p)
    assert out["start_ms"].iloc[0] == 0 and out["end_ms"].iloc[-1] == 200_000
    assert (out["start_ms"].iloc[1:].to_numpy() == out["end_ms"].iloc[:-1].to_numpy()).all()
    assert out["end_ms"].iloc[0] == 52_500


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5000), st.integers(1, 30_000)), max_size=30))
def test_pack_speech_covers_every_segment(steps):
    at, pairs = 0, []
    for gap, size in steps:
        pairs.append((at + gap, at + gap + size))
        at += gap + size
    out = segment.pack_speech()(frame(pairs))
    spans = out[["start_ms", "end_ms"]].values.tolist()
    for s, e in pairs:
        assert any(a <= s < b for a, b in spans) and any(a < e <= b for a, b in spans)
    assert all(b > a for a, b in spans) and all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))


def test_reflow_groups_at_pauses_and_halves_at_the_longest_gap():
    p = frame([(0, 500), (800, 1000), (1001, 1200), (5000, 5000)], word=["a ", "b ", "c", "x"])
    assert segment.reflow()(p)["text"].tolist() == ["a", "b c"]
    long = frame([(0, 4000), (4100, 8000), (8250, 12_000)], word=["a", "b", "c"])
    assert segment.reflow()(long)["text"].tolist() == ["ab", "c"]
    tiny = frame([(0, 100), (450, 900)], word=["a", "b"])
    assert segment.reflow()(tiny)["text"].tolist() == ["ab"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 900), st.integers(0, 4000)), max_size=40))
def test_reflow_keeps_words_and_order(steps):
    at, pairs = 0, []
    for gap, size in steps:
        pairs.append((at + gap, at + gap + size))
        at += gap + size
    out = segment.reflow()(frame(pairs, word=[f"{i};" for i in range(len(pairs))]))
    assert "".join(out["text"]) == "".join(f"{i};" for i, (s, e) in enumerate(pairs) if e > s)
    assert (out["end_ms"] - out["start_ms"] <= 10_000).all() or (out["words"] == 1).any()


def test_pack_lines():
    p = frame([(0, 1000), (1100, 2000), (2100, 3000), (9000, 9500), (9400, 9900)], text=["one", "two", "three", "", "five"], turn=[False, False, True, False, None])
    out = segment.pack_lines()(p)
    assert out["text"].tolist() == ["one\ntwo", "- three", "five"]


def test_clusters_measure_from_the_first():
    assert segment.near_first(50)(pd.DataFrame({"s": [0, 40, 80, 120]}))["size"].tolist() == [2, 2]


def test_average_linkage_finds_directions():
    rng = np.random.default_rng(0)
    x = np.vstack([rng.normal(c, 0.05, (6, 3)) for c in np.eye(3)])
    lab = segment.average_linkage(x, 0.7)
    assert len(set(lab)) == 3 and all(len(set(lab[i : i + 6])) == 1 for i in (0, 6, 12))
    assert len(segment.average_linkage(np.zeros((0, 3)), 0.7)) == 0
