import random

import pytest

from cuefold.operators.coverage import sweep
from cuefold.operators.intervals import best_overlap, nearest, overlap_join, point_in_interval
from cuefold.operators.islands import gaps, longest_run, runs, sessions
from cuefold.operators.ordered import carry_forward, previous, running_sum


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def naive_sweep(data):
    out, by = [], {}
    for k, s, e in data:
        if s is not None and e is not None and s < e:
            by.setdefault(k, []).append((s, e))
    for k, own in by.items():
        merged = []
        for s, e in sorted(own):
            if merged and s <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], e)
            else:
                merged.append([s, e])
        out += [(k, "period", s, e) for s, e in merged]
        out += [(k, "gap", a[1], b[0]) for a, b in zip(merged, merged[1:])]
    return sorted(out, key=repr)


def test_sweep_matches_brute_force(spark):
    rng = random.Random(3)
    data = []
    for _ in range(400):
        s = rng.randrange(0, 900)
        data.append((rng.choice(["a", "b", None]), rng.choice([s, s, s, None]), s + rng.randrange(-3, 12)))
    data += data[:40]
    df = spark.createDataFrame(data, "k string, s long, e long")
    assert rows(sweep(df, ["k"], "s", "e", 50)) == naive_sweep(data)


def test_sweep_edges(spark):
    empty = spark.createDataFrame([], "k string, s long, e long, kind string")
    assert rows(sweep(empty, ["k"], "s", "e")) == []
    df = spark.createDataFrame([("a", 0, 5, "x"), ("a", 5, 9, "y"), ("a", 7, 7, "z"), ("a", -8, -2, "w")], "k string, s long, e long, kind string")
    assert rows(sweep(df, ["k"], "s", "e")) == [("a", "gap", -2, 0), ("a", "period", -8, -2), ("a", "period", 0, 9)]


def test_overlap_join_matches_brute_force(spark):
    rng = random.Random(5)
    a = [("k", i, s, s + rng.randrange(0, 40)) for i in range(60) for s in [rng.randrange(500)]]
    b = [("k", i, s, s + rng.randrange(0, 40)) for i in range(60) for s in [rng.randrange(500)]]
    left, right = spark.createDataFrame(a, "k string, i int, s long, e long"), spark.createDataFrame(b, "k string, j int, cs long, ce long")
    got = rows(overlap_join(left, right, ["k"], ("s", "e"), ("cs", "ce"), 16).select("i", "j"))
    assert got == sorted([(x[1], y[1]) for x in a for y in b if x[2] < y[3] and x[3] > y[2]], key=repr)
    assert "NestedLoop" not in overlap_join(left, right, ["k"], ("s", "e"), ("cs", "ce"))._jdf.queryExecution().toString()
    near = rows(nearest(left, right, ["k"], ["i"], ("s", "e"), ("cs", "ce"), ["j"], 16).select("i", "j", "distance_ms"))
    want = []
    for x in a:
        if not any(x[2] < y[3] and x[3] > y[2] for y in b):
            d, j = min((x[2] - y[3] if y[3] <= x[2] else y[2] - x[3], y[1]) for y in b)
            want.append((x[1], j, d))
    assert near == sorted(want, key=repr)
    best = rows(best_overlap(left, right, ["k"], ["i"], ("s", "e"), ("cs", "ce"), ["j"], 16).select("i", "j"))
    want = []
    for x in a:
        o = [(-(min(x[3], y[3]) - max(x[2], y[2])), y[1]) for y in b]
        if min(o)[0] < 0:
            want.append((x[1], min(o)[1]))
    assert best == sorted(want, key=repr)


def test_touching_intervals_do_not_overlap(spark):
    left = spark.createDataFrame([("k", 0, 1000)], "k string, s long, e long")
    right = spark.createDataFrame([("k", 1000, 2000), (None, 0, 5), ("k", None, 5)], "k string, cs long, ce long")
    assert overlap_join(left, right, ["k"], ("s", "e"), ("cs", "ce")).count() == 0
    assert overlap_join(left, right, ["k"], ("s", "e"), ("cs", "ce"), closed=True).count() == 1


def test_point_in_interval(spark):
    points = spark.createDataFrame([("k", 0), ("k", 10), ("k", None)], "k string, at long")
    spans = spark.createDataFrame([("k", 0, 10), ("k", 10, 10), ("k", 5, 30)], "k string, s long, e long")
    assert rows(point_in_interval(points, spans, ["k"], "at", ("s", "e"), 4).select("at", "s")) == [(0, 0), (10, 5)]


@pytest.mark.parametrize("width", [1, 7, 1000])
def test_two_level_scans(spark, width):
    rng = random.Random(9)
    data = [(rng.choice(["a", "b"]), i, rng.choice([None, 1, 2, 3])) for i in range(120)]
    df = spark.createDataFrame(data, "k string, i long, v long").selectExpr("*", f"floor(i / {width}) AS block")
    carried, total, last, seen = {}, {}, {}, []
    for k, i, v in data:
        carried[k] = v if v is not None else carried.get(k)
        total[k] = total.get(k, 0) + (v or 0)
        seen.append((k, i, carried[k], total[k], last.get(k)))
        last[k] = i
    a = carry_forward(df, ["k"], "block", ["i"], "v", "c")
    assert rows(a.select("k", "i", "c")) == sorted([x[:3] for x in seen], key=repr)
    assert rows(running_sum(df, ["k"], "block", ["i"], "v", "t").select("k", "i", "t")) == sorted([(x[0], x[1], x[3]) for x in seen], key=repr)
    assert rows(previous(df, ["k"], "block", ["i"], "i", "p").select("k", "i", "p")) == sorted([(x[0], x[1], x[4]) for x in seen], key=repr)


def test_islands(spark):
    df = spark.createDataFrame([("k", 0, 500), ("k", 800, 900), ("k", 950, 950), ("k", 1300, 1400), ("k", None, 3)], "k string, s long, e long")
    assert rows(sessions(df, ["k"], "s", "e", ["s"], 300).select("s", "session")) == [(0, 1), (1300, 3), (800, 2)]
    assert rows(sessions(df, ["k"], "s", "e", ["s"], 300, strict=True).select("s", "session")) == [(0, 1), (1300, 2), (800, 1)]
    assert rows(gaps(df, ["k"], "s", "e", ["s"], 300)) == [("k", 500, 800, 300, 1300), ("k", 950, 1300, 350, 2250)]
    frames = spark.createDataFrame([("t", n) for n in (1, 2, 2, 3, 5)], "k string, n int")
    assert rows(longest_run(frames, ["k"], "n")) == [("t", 3)]
    same = spark.createDataFrame([("k", i, v) for i, v in enumerate("aabba")], "k string, i int, v string").selectExpr("*", "0 AS block")
    assert [r.run for r in runs(same, ["k"], "block", ["i"], "v").orderBy("i").collect()] == [1, 1, 2, 2, 3]


def test_blocks_hold_whole_sessions(spark):
    from cuefold.operators.islands import whole_sessions

    df = spark.createDataFrame([("k", s, s + 10) for s in (0, 50, 95, 180, 300, 330)], "k string, s long, e long")
    got = whole_sessions(df, ["k"], "s", "e", ["s"], 60, block_ms=100)
    assert [r.block for r in got.orderBy("s").collect()] == [0, 0, 0, 1, 3, 3]
