import random
import unicodedata

import pytest

from cuefold.llm import lookalike as L

BASE = ["ガード", "café", "hello, world", "finale", "一二三", "ペンキ", "ab cd", "naïve — x", "", "テスト\n行"]


def dirty(rng, t):
    out = []
    for c in t:
        if rng.random() < 0.2:
            out.append(rng.choice("\u200b\u200d\u00ad\ufeff\u2060"))
        d = unicodedata.normalize("NFD", c) if rng.random() < 0.4 else c
        d = d.replace("a", rng.choice("aаａ")).replace("o", rng.choice("oоο")).replace(" ", rng.choice("  \u3000 "))
        out.append(d.replace("カ", rng.choice("カ力ｶ")).replace("ト", rng.choice("ト卜ﾄ")))
    s = "".join(out).replace("fi", rng.choice(["fi", "ﬁ"]))
    return rng.choice(["", " ", "\u3000"]) + s


@pytest.fixture(scope="module")
def table():
    return L.Classes(L.seeds(), {"a": 9, "カ": 5, "ト": 5}).rewrite


def test_one_form_whatever_the_spelling(table):
    rng, do = random.Random(1), L.Rewriter(table)
    for t in BASE:
        forms = {do(dirty(rng, t)) for _ in range(40)}
        assert len(forms) == 1, (t, forms)
        form = forms.pop()
        assert do(form) == form


def test_what_counts_stays_apart(table):
    do = L.Rewriter(table)
    for a, b in [("ハ", "バ"), ("ハ", "パ"), ("e", "é"), ("a", "A"), ("a b", "a  b"), ("a\nb", "a b"), ("x", "y"), ("0", "O"), ("い", "り"), ("\na", "a")]:
        assert do(a) != do(b), (a, b)
    for a, b in [("ﾊﾞ", "バ"), ("ハ゛", "バ"), ("⼆", "二"), ("Ａ！", "A!"), ("a\r\nb", "a\nb"), ("x‑y", "x-y"), ("A", "\u0391"), ("\uac01", "\u1100\u1161\u11a8")]:
        assert do(a) == do(b), (a, b)


def test_classes_are_transitive_and_led_by_frequency():
    got = L.Classes([("a", "b"), ("b", "c"), ("x", "y")], {"c": 5, "y": 1}).rewrite
    assert got == {"a": "c", "b": "c", "x": "y"}
    assert L.Classes([("b", "a")], {}).rewrite == {"b": "a"}


def test_ligatures_meet_their_letters_whatever_is_frequent():
    for counts in ({"\ufb01": 9}, {"\u0456": 9, "\ufb01": 1}, {"fi": 3}, {}):
        do = L.Rewriter(L.Classes(L.seeds(), counts).rewrite)
        forms = {do(t) for t in ("final office", "\ufb01nal o\ufb03ce", "f\u0456nal off\u0456ce", "\uff46\uff49nal of\ufb01ce")}
        assert len(forms) == 1 and do(next(iter(forms))) in forms


def brute(data, do):
    out = set()
    for i, (g, a, t) in enumerate(data):
        for h, b, u in data[i + 1 :]:
            if None not in (g, h, t, u, a, b) and g == h and a != b and t != u and do(t) == do(u):
                out.add((g, min(a, b), max(a, b)))
    return out


@pytest.mark.parametrize("block", [1, 3, 2000])
def test_pairs_match_brute_force(spark, block):
    rng = random.Random(block)
    data = [(rng.choice(["e1", "e2", None]), rng.randrange(1, 150), dirty(rng, rng.choice(BASE))) for _ in range(160)]
    data += [("e1", 900 + i, "ガード") for i in range(12)] + [("e1", 7, None), ("e1", None, "x")] + data[:10]
    df = spark.createDataFrame([(*r, "z", 1) for r in data], "g string, id long, t string, id_1 string, raw int")
    got = [tuple(r) for r in L.pairs(df, ["g"], "id", "t", block).collect()]
    table = L.fit(df.dropna(subset=["t"]), "t")
    assert len(got) == len(set(got)) and set(got) == brute(data, L.Rewriter(table))


def test_classes_say_what_pairs_say(spark):
    rng = random.Random(9)
    data = [(rng.choice(["e1", "e2", None]), i, dirty(rng, rng.choice(BASE))) for i in range(200)] + [("e1", 900 + i, "ガード") for i in range(30)] + [("e1", 7, None)]
    df = spark.createDataFrame([(*r, "z") for r in data], "g string, id long, t string, class_id string")
    links = {}
    for g, a, b in L.pairs(df, ["g"], "id", "t").collect():
        for x in (a, b):
            links[g, x] = links.get((g, x), 0) + 1
    got = L.classes(df, ["g"], "id", "t").collect()
    assert {(r.g, r.id): r.links for r in got} == links and len(got) == len(links)
    form = L.Rewriter(L.fit(df.dropna(subset=["t"]), "t"))
    of = {i: (g, form(t)) for g, i, t in data if t is not None}
    assert len({(r.g, r.class_id) for r in got}) == len({of[r.id] for r in got})


def test_edges(spark):
    empty = spark.createDataFrame([], "g string, id long, t string")
    assert L.pairs(empty, ["g"], "id", "t").count() == 0
    long = "ト" * 50_000
    df = spark.createDataFrame([("e", 1, long), ("e", 2, long.replace("ト", "卜", 1)), ("e", 3, ""), ("e", 4, " \u200b")], "g string, id long, t string")
    assert sorted(tuple(r) for r in L.pairs(df, ["g"], "id", "t").collect()) == [("e", 1, 2), ("e", 3, 4)]
    assert [r.n for r in L.rewrite(spark.createDataFrame([(None, "x"), ("ａ", "x"), ("aa", "x")], "t string, n string"), "t", "n").collect()] == [None, "a", "aa"]
