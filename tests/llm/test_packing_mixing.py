import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cuefold.llm import mixing, packing, tokens


def brute_scores(items, seed, k1=1.2, b=0.75):
    n, mean = len(items), np.mean([len(x) for x in items])
    df = Counter(t for x in items for t in set(x))
    out = []
    for x in items:
        tf = Counter(x)
        s = 0.0
        for t in set(items[seed]):
            idf = np.log((n - df[t] + 0.5) / (df[t] + 0.5))
            if idf > 0 and tf[t]:
                s += idf * tf[t] * (k1 + 1) / (tf[t] + k1 * (1 - b + b * len(x) / mean))
        out.append(s)
    return out


def test_bm25_matches_brute_force():
    rng = random.Random(2)
    items = [[rng.randrange(40) for _ in range(rng.randrange(1, 30))] for _ in range(25)]
    index = packing.Index([np.array(x) for x in items])
    for seed in range(25):
        assert np.allclose(index.scores(seed), brute_scores(items, seed))


@pytest.mark.parametrize("seed", range(6))
def test_every_item_once_and_none_over(seed):
    rng = random.Random(seed)
    items = [np.array([rng.randrange(50) for _ in range(rng.choice([1, 5, 17, 60, 100]))]) for _ in range(80)]
    sizes = [len(x) for x in items]
    out = packing.pack(sizes, items, 100)
    assert sorted(i for c in out for i in c) == list(range(80))
    fills = [sum(sizes[i] for i in c) for c in out]
    assert max(fills) <= 100 and sum(fills) / (100 * len(out)) > 0.75
    assert packing.pack([], [], 100) == []


def test_neighbours_share_a_container():
    a, b = np.arange(0, 30), np.arange(100, 130)
    items = [a, b, a + 0, b + 0] + [np.arange(1000 + 50 * i, 1030 + 50 * i) for i in range(8)]
    out = packing.pack([len(x) for x in items], items, 60)
    assert [0, 2] in out and [1, 3] in out


DOCS = [(1, "alpha beta gamma " * 30, "s"), (2, "x " * 900, "s"), (3, None, "s"), (4, "", "s"), (5, "こんにちは。" * 50, "s"), (6, "x", "s"), (None, "null id", "s")]


def test_documents(spark):
    df = spark.createDataFrame([(*r, 9) for r in DOCS], "doc_id long, t string, source string, n_tokens int")
    got = packing.pack_documents(df, "doc_id", "t", 128, shard_chars=1_000).collect()
    enc = tokens.load(open(tokens.DEFAULT_FILE, "rb").read())
    sizes = {d: len(enc.encode_ordinary(t)) for d, t, _ in DOCS if t}
    per = defaultdict(list)
    fill = Counter()
    for r in got:
        per[r.doc_id].append((r.part_no, r.from_token, r.to_token))
        fill[r.container_id] += r.n_tokens
        assert r.n_tokens == r.to_token - r.from_token and (r.n_parts == 1 or sizes[r.doc_id] > 128)
    assert set(per) == set(sizes) and max(fill.values()) <= 128
    for d, parts in per.items():
        parts.sort()
        assert parts[0][1] == 0 and parts[-1][2] == sizes[d] and all(x[2] == y[1] for x, y in zip(parts, parts[1:]))
    assert packing.pack_documents(df.limit(0), "doc_id", "t").count() == 0
    report = packing.fill_report(packing.pack_documents(df, "doc_id", "t", 128)).first()
    assert report.tokens == sum(sizes.values()) and 0 < report.fill <= 1


def test_copies_meet_in_a_shard(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choices(words, k=60)) for _ in range(120)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, t + " end") for i, t in enumerate(texts)]
    got = packing.pack_documents(spark.createDataFrame(docs, "doc_id long, t string"), "doc_id", "t", 1024, shard_chars=5_000).collect()
    shard = {r.doc_id: r.container_id >> 24 for r in got}
    assert len(shard) == 240 and len(set(shard.values())) > 5
    assert sum(shard[i] == shard[1000 + i] for i in range(120)) > 100


def test_hot_documents_are_divided(spark):
    docs = [(i, "alpha beta gamma " * 10) for i in range(300)]
    got = packing.pack_documents(spark.createDataFrame(docs, "doc_id long, t string"), "doc_id", "t", 512, shard_chars=5_000).collect()
    per = Counter(r.container_id >> 24 for r in got)
    assert sum(per.values()) == 300 and max(per.values()) < 100


def test_frequencies_of_all_items_count():
    items, among = [np.array([1, 2]), np.array([1, 3])], np.zeros(9, int)
    among[[1, 2, 3]] = 2, 1, 1
    assert packing.Index(items).scores(0)[1] == 0  # here in all items, but rare among all
    assert packing.Index(items, stats=(100, 2.0, among)).scores(0)[1] > 0


def test_token_counts(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, t string, n_tokens string")
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(df, ["doc_id"], "t").collect()}
    assert got[3] == got[4] == 0 and got[6] == 1 and got[2] > 128


@pytest.mark.parametrize("total", [None, 700, 10**9])
@pytest.mark.parametrize("block", [7, 50_000])
def test_mix(spark, total, block):
    rng = random.Random(8)
    docs = [(i, rng.choice(["a", "a", "a", "b", "c", None, "other"]), "word " * rng.randrange(1, 40)) for i in range(200)] + [(900, "b", None), (901, "b", "")]
    df = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, src string, t string, epoch int")
    want = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 4), ("c", 0.2, 2), ("gone", 0.1, 2), ("none", None, 1)], "source string, target_share double, max_repeats int")
    drawn, report = mixing.mix(df, want, "doc_id", "src", "t", total, block_rows=block)
    rows, rep = drawn.collect(), {r.source: r for r in report.collect()}
    assert set(rep) == {"a", "b", "c", "gone"} and rep["gone"].drawn_tokens == 0
    most = {"a": 1, "b": 4, "c": 2}
    uses = Counter((r.source, r.doc_id) for r in rows)
    assert all(n <= most[s] for (s, _), n in uses.items())
    for s in most:
        own = [r for r in rows if r.source == s]
        assert sum(r.used_tokens for r in own) == rep[s].budget_tokens == rep[s].drawn_tokens
        assert rep[s].shortfall_tokens == rep[s].asked_tokens - rep[s].drawn_tokens and (rep[s].shortfall_tokens > 0) == (total == 10**9)
        assert sum(r.used_tokens != r.n_tokens for r in own) <= 1
        assert abs(rep[s].actual_share - {"a": 0.5, "b": 0.3, "c": 0.2}[s]) < 0.002
        # a source is used up before any of its documents comes again
        last = max(r.epoch for r in own)
        full = {d for d, src, t in docs if src == s and t}
        assert all({r.doc_id for r in own if r.epoch == e} == full for e in range(1, last))
        order = [(r.mix_key, r.doc_id) for r in own if r.epoch == last]
        everyone = sorted(spark.createDataFrame([(d, last) for d in full], "d long, e long").selectExpr("xxhash64(d, e, 11) k", "d").collect())
        assert sorted(order) == [tuple(x) for x in everyone][: len(order)]
    if total == 700:
        assert sum(r.used_tokens for r in rows) in (699, 700, 701)


def test_more_sources_than_are_sent(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"s{i % 3}", "word " * (i % 7 + 1)) for i in range(60)], "doc_id long, src string, t string")
    want = spark.createDataFrame([(f"s{i}", 0.25, 2) for i in range(4)], "source string, target_share double, max_repeats int")
    few = sorted(map(tuple, mixing.mix(docs, want, "doc_id", "src", "t")[0].collect()))
    monkeypatch.setattr(mixing, "MOST_SOURCES", 2)
    assert sorted(map(tuple, mixing.mix(docs, want, "doc_id", "src", "t")[0].collect())) == few


def test_rarest_terms():
    rng = random.Random(3)
    among = np.array([rng.randrange(5) for _ in range(40)])
    rows = [sorted(rng.sample(range(40), rng.randrange(0, 12))) for _ in range(60)]
    first, second = packing.rarest(np.array([t for r in rows for t in r], np.uint16), np.cumsum([0, *map(len, rows)]), among)
    for r, a, b in zip(rows, first, second):
        own = sorted((t for t in r if among[t] > 1), key=lambda t: (among[t], t))
        assert [a, b] == (own + [-1, -1])[:2]


def test_mix_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, src string, t string")
    want = spark.createDataFrame([("a", 1.0, 1)], "source string, target_share double, max_repeats int")
    drawn, report = mixing.mix(docs, want, "doc_id", "src", "t")
    assert drawn.count() == 0 and report.first().actual_share == 0.0
    assert mixing.mix(docs, want.limit(0), "doc_id", "src", "t")[0].count() == 0
