import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from cuefold.operators import matching as M

SPANS = st.lists(st.tuples(st.integers(0, 50), st.integers(0, 9)).map(lambda x: (x[0], x[0] + x[1])), max_size=9)


@settings(max_examples=80, deadline=None)
@given(SPANS, SPANS)
def test_greedy_overlap_uses_each_once(a, b):
    out = M.greedy_overlap(a, b)
    assert sorted(i for i, _ in out if i is not None) == list(range(len(a)))
    assert sorted(j for _, j in out if j is not None) == list(range(len(b)))
    assert all(a[i][0] < b[j][1] and a[i][1] > b[j][0] for i, j in out if None not in (i, j))


def test_greedy_overlap_takes_the_longest_then_the_first():
    assert M.greedy_overlap([(0, 10), (0, 10)], [(0, 4), (2, 9), (3, 10)]) == [(0, 1), (1, 2), (None, 0)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from(["aa", "bbb", "ccccc", "dd ee", "f"]), max_size=8), st.lists(st.sampled_from(["aa", "bbb", "cccc", "dd", "g"]), max_size=8))
def test_lines_keep_order_unless_moved(a, b):
    out = M.match_lines(a, b)
    assert sorted(i for i, _, _ in out if i is not None) == list(range(len(a)))
    assert sorted(j for _, j, _ in out if j is not None) == list(range(len(b)))
    kept = [j for i, j, kind in out if kind in ("equal", "contains", "similar")]
    assert kept == sorted(kept)
    assert all(a[i] == b[j] for i, j, kind in out if kind == "equal")


def test_lines_by_kind():
    out = M.match_lines(["hello there", "one", "walked home", "zz"], ["one", "hello there friend", "walking home"])
    assert (1, 0, "equal") in out and (2, 2, "similar") in out and (3, None, "dropped") in out and (0, 1, "moved") in out


def test_rising():
    assert M.rising([(0, 5), (3, 4), (2, 9)]) == [(0, 5), (5, 6), (6, 9)]


def test_frame_spans():
    frames = [(1, ["a", "b"]), (2, ["a", "b", "c"]), (3, []), (4, ["a"]), (9, ["a"]), (10, ["x", "y", "z"])]
    assert [(s["first"], s["last"]) for s in M.frame_spans(frames)] == [(1, 4), (9, 9), (10, 10)]
    assert M.frame_spans(frames)[0]["counts"] == {"a": 3, "b": 2, "c": 1}


def test_weak_groups_and_picks():
    assert M.weak_groups([5, 6, 8, 20], 22) == [(3, 10), (18, 21)]
    assert M.pick_apart([(0, 3), (2_000, 5), (6_000, 3), (9_000, 0), (12_000, 3)], 2) == [1, 4]
    assert M.pick_apart([], 3) == []


def test_two_pass_clusters():
    rng = np.random.default_rng(1)
    x = np.vstack([rng.normal(c, 0.05, (8, 3)) for c in np.eye(3)])
    ms = np.array(([3000] * 5 + [500] * 3) * 3)
    lab = M.two_pass(x, ms)
    assert all(len(set(lab[i : i + 8].tolist())) == 1 for i in (0, 8, 16)) and set(lab.tolist()) == {0, 1, 2}
    assert M.two_pass(-x[:1], ms[:1]).tolist() == [-1]


def test_merge_short():
    cues = [(0, 500, "aaaa"), (600, 3000, "bbbb"), (3000, 3400, "cccc"), (9000, 9500, "dddd")]
    assert M.merge_short(cues) == [(0, 3000, "aaaa\nbbbb"), (3000, 9500, "cccc\ndddd")]
    assert M.merge_short([(0, 1500, "aaaa"), (1500, 1800, "no"), (1800, 3200, "bbbb")]) == [(0, 1500, "aaaa"), (1500, 3200, "no\nbbbb")]
    turn = [(0, 500, "aaaa", False), (600, 3000, "bbbb", True)]
    assert M.merge_short(turn) == turn
    assert M.merge_short([]) == []


def test_frame_spans_reach_over_two_frames():
    seen = lambda *n: [(s["first"], s["last"]) for s in M.frame_spans([(k, ["a"]) for k in n])]
    assert seen(1, 4) == [(1, 4)] and seen(1, 5) == [(1, 1), (5, 5)]
