import random

import numpy as np

from cuefold.llm import spam as S

WORDS = "cheap sale online coupon review watch free download buy best".split()
PROSE = ["The crew met at the old pier before noon.", "Nobody knew who had the spare key.", "She put the lamp down and left the room.", "Rain fell on the market all day long.", "We asked the guard, and he pointed north.", "It was late when the last boat came in."]


def page(rng, spam):
    if not spam:
        own = [rng.choice(PROSE) + (" https://a.example/x/%d" % rng.randrange(99) if rng.random() < 0.1 else "") for _ in range(rng.randrange(4, 14))]
        return rng.choice([" ", "\n"]).join(own)
    kind = rng.randrange(5)
    n = rng.randrange(15, 40)
    title = rng.choice(["Neon Race", "Tunnel Town", "夜店クイズ"])
    return {
        0: " | ".join(f"{title} {rng.choice(WORDS)}" for _ in range(n)), 1: "\n".join(f"- {title} {rng.choice(WORDS)} https://b.example/{i}" for i in range(n)), 2: " ".join("#" + rng.choice(WORDS) for _ in range(n)),
        3: "\n".join(f"{title} {rng.choice(WORDS)} A-{rng.randrange(100, 9999)} XL {rng.randrange(9999)} USD" for _ in range(n)), 4: " ".join(f"Get {title} {rng.choice(WORDS)}, {title} {rng.choice(WORDS)} and {title}!" for _ in range(n)),
    }[kind]


def test_held_out_accuracy():
    rng = random.Random(1)
    truth = [i % 4 == 0 for i in range(800)]
    x = np.array([S.page_features(page(rng, t)) for t in truth], np.float32)
    trees = S.Trees(x[:400], np.array(truth[:400], float))
    right = (trees.predict(x[400:]) > 0.5) == np.array(truth[400:])
    assert right.mean() > 0.98
    assert ((x[:, 0] > 0.5) == np.array(truth)).mean() > 0.98


def test_lists_that_inform_and_refrains_are_no_spam():
    rng = random.Random(2)
    cast = "Night Show\n" + "\n".join(f"{rng.choice(['Host', 'Judge', 'Guest'])}\u3000{rng.choice(['Aida', 'Brook', 'Chan'])} / Show{i}" for i in range(25))
    table = "\n".join(f"{9 + i // 4:02d}:{i % 4 * 15:02d} {PROSE[i % 6]}" for i in range(24))
    glossary = "\n".join(f"{''.join(rng.choices('abcdefgh', k=6))} — {''.join(rng.choices('mnopqrst', k=7))}" for i in range(25))
    song = PROSE[0] + "\n" + "Go! " * 30 + "\n" + PROSE[1] + " " + PROSE[2] + " " + PROSE[3]
    for t in (cast, table, glossary, song):
        assert S.page_features(t)[0] < 0.45, t
    mixed = " ".join(PROSE * 3) + "\n" + "sale | " * 8
    assert S.page_features(mixed)[0] < 0.5


def test_features_of_nothing():
    for t in (None, "", "  \n ", "\n"):
        assert S.page_features(t) == [0.0] * len(S.NAMES)
    assert all(np.isfinite(S.page_features("https://x.example/" + "a" * 200_000)))
    assert len(S.page_features("。")) == len(S.NAMES)


def test_table(spark):
    rng = random.Random(3)
    rows = [(i, page(rng, i % 5 == 0), f"https://h{i % 3}.example/p/{i}", 1.0) for i in range(150)] + [(500, None, None, 0.0), (501, "", "odd", 0.0), (0, page(rng, True), "https://h0.example/p/0", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, t string, url string, score double")
    got = S.spam_scores(df, "doc_id", "t", "url", fit_rows=100).collect()
    assert len(got) == len(rows)
    right = sum((r.score > 0.5) == (r.doc_id % 5 == 0 and r.doc_id < 150) for r in got)
    assert right >= len(got) - 2
    assert S.spam_scores(df.limit(0), "doc_id", "t", "url").count() == 0
    assert [r.score > 0.5 for r in S.spam_scores(df.filter("doc_id IN (1, 2)"), "doc_id", "t", "url").collect()] == [False, False]


KEYWORDS = "cheap sale online coupon review watch free download buy best stream discount subtitles merch HD episode signup size box top preview trailer cast clip".split()


def test_salads_of_many_keywords():
    rng = random.Random(4)
    for between in (" ", " - ", "・", "、", ", ", " | "):
        text = between.join(rng.choice(KEYWORDS) for _ in range(150))
        assert S.page_features(text)[0] > 0.9, between
        assert S.page_features(PROSE[0] + "\n" + text)[0] > 0.55, between
    lines = "\n".join(rng.choice(KEYWORDS) for _ in range(60))
    assert S.page_features(PROSE[0] + "\n" + lines)[0] > 0.8
    assert S.page_features("\n".join(f"{rng.choice(['Host', 'Judge', 'Guest'])} {a}{b}" for a in "Aida Brook Chan".split() for b in "abcdefg"))[0] < 0.45
    cloud = " - ".join(f"{rng.choice(KEYWORDS)} {rng.choice(['wheel', 'ladder', 'timer', 'scale'])} ({rng.randrange(999)})" for _ in range(40))
    assert S.page_features(cloud)[0] > 0.9
    prose = " ".join(x.rstrip(".") for x in ("the man who had the key went down to the pier and met the crew there", "nobody knew why a lamp was left in the room by the guard", "rain fell on the market and the last boat came in late", "she asked a boy for the way to the old gate near the hill", "he pointed north and said the road was closed for the night"))
    assert S.page_features(prose)[0] < 0.45


def test_trees_do_not_restate_the_weak_rules():
    rng = random.Random(5)
    f = np.array([S.page_features(page(rng, i % 4 == 0)) for i in range(800)], np.float32)
    labels = S.weak_labels(f)
    assert set(labels[::4]) <= {1, -1} and set(np.delete(labels, np.s_[::4])) <= {0, -1}
    contradicted = f[labels == 0][:1].copy()
    contradicted[0, S.NAMES.index("linked")] = 0.9
    assert S.weak_labels(contradicted)[0] == -1
    assert not set(S.WEAK) & set(S.SEEN)
    known = labels >= 0
    trees = S.Trees(f[known][:, len(S.WEAK) :], (labels[known] == 1).astype(float))
    assert len({t[0] for t in trees.trees}) > 3  # no stump that all share


def test_a_host_of_spam_turns_a_verdict(spark):
    rng = random.Random(6)
    rows = [(i, page(rng, i < 300), "https://%s.example/p/%d" % ("bad" if i <= 300 else f"h{i % 9}", i)) for i in range(4000)] + [(9000, "", "https://bad.example/x")]
    got = {r.doc_id: r for r in S.spam_scores(spark.createDataFrame(rows, "doc_id long, t string, url string"), "doc_id", "t", "url").collect()}
    assert got[300].page_score < 0.5 < got[300].score
    assert got[301].score < 0.5 and got[9000].score == 0
