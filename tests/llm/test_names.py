import math
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from cuefold.llm import names as N

PEOPLE = [
    (1, "縄舟戸晴彦", "なわふなと はるひこ", "Haruhiko Nawafunato", "ピアノオー工房"), (2, "苺鞍玄作", "いちごくら げんさく", "Gensaku Ichigokura", None), (3, "帯綴宙", "おびつづり そら", "Sora Obitsuzuri", None),
    (4, "帯綴嵐", "おびつづり あらし", "Arashi Obitsuzuri", None), (5, "塩栞杏樹", "しおしおり あんじゅ", "Anju Shioshiori", None), (6, "渦栞杏樹", "うずしおり あんじゅ", "Anju Uzushiori", None), (7, "粉垂陸央", "こなたれ りくお", "Rikuo Konatare", None),
    (8, "鯨巻陸央", "くじらまき りくお", "Rikuo Kujiramaki", None), (9, "墨駒玄作", "すみごま げんさく", "Gensaku Sumigoma", None), (10, "虹梁晴彦", "にじはり はるひこ", "Haruhiko Nijihari", None),
]
TEAMS = frozenset(N.team_forms("ピアノオー工房"))
MEANT = {
    "縄舟戸晴彦": 1, "ナワフナトハルヒコ": 1, "ﾅﾜﾌﾅﾄ ﾊﾙﾋｺ": 1, "縄舟戸　晴彦(48)": 1, "Nawafunato Haruhiko": 1, "Haruhiko Nawafunoto": 1, "nawafunatoharuhiko": 1, "H. Nawafunato": 1, "Nawafunato, H.": 1, "繩舟戸晴彦": 1,
    "縄舟戸さん": 1, "ピアノオー工房縄舟戸晴彦": 1, "縄舟戸晴彦（ピアノオー工房）": 1, "なわはる": 1, "縄​舟戸晴彦ず": 1, "なわふなと晴彦": 1, "Нawafunato-san": 1, "莓鞍玄作": 2, "しおあん": 5, "うずあん": 6, "コナタレリオ": 7,
}
NOBODY = ["菱滝六助", "楠園さん", "キネソノトモエ", "Takaichi Kusuzono", "  ", "(48)", "さん", "12", "長" * 5000]


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(PEOPLE, "person_id long, name string, reading string, romaji string, team string")


@pytest.fixture(scope="module")
def rows(people):
    return N.person_forms(people).withColumn("fid", F.xxhash64("kind", "words", "parts")).cache()


def scores(spark, rows, people, names):
    """``{name: {person_id: score}}`` by the join."""
    normal = N.normal_names(spark.createDataFrame([(n,) for n in names], "name string"), people)
    found = N.matches(normal.select("key").distinct(), rows, len(PEOPLE), 4)
    members = rows.filter("kind NOT LIKE 'known%'").select("fid", "person_id").distinct()
    out = {n: {} for n in names}
    for r in normal.join(found, "key").join(members, "fid").collect():
        out[r.name][r.person_id] = max(out[r.name].get(r.person_id, 0), r.score)
    return out


def brute(rows, names):
    """The same, every name against every form."""
    own = rows.collect()
    known = {k: {r.parts[0] for r in own if r.kind == k} for k in ("known0", "known1")}
    count = {}
    for k in ("known0", "known1"):
        each = [r.parts[0] for r in own if r.kind == k]
        count |= {x: each.count(x) for x in set(each)}
    weight = lambda x: math.log(1 + len(PEOPLE) / count[x]) if x in count else 1.0
    out = {n: {} for n in names}
    for n in names:
        for q in N.queries_of(N.normal_name(n, TEAMS)):
            for r in own:
                if r.kind.startswith("known"):
                    continue
                a, b = N.grams(q), N.grams(r.words)
                if len(a & b) < 0.3 * len(a | b):
                    continue
                s = N.verify(q, r.kind, tuple(r.parts), tuple(weight(x) for x in r.parts), known["known0"] | known["known1"], known["known0"])
                if s:
                    out[n][r.person_id] = max(out[n].get(r.person_id, 0), s)
    return out


def test_variants_and_nobody(spark, rows, people):
    got = scores(spark, rows, people, [*MEANT, *NOBODY])
    for name, person in MEANT.items():
        best = sorted(((s, p) for p, s in got[name].items()), reverse=True)
        assert best and best[0][1] == person and (len(best) == 1 or best[1][0] < best[0][0]), (name, best)
    for name in NOBODY:
        assert [s for s in got[name].values() if s >= 0.6] == [], name


def test_the_join_finds_what_all_pairs_find(spark, rows, people):
    rng = random.Random(3)
    names = [*MEANT, "Kujiramak Rikuo", "鯨巻陸", "いちごくらげんさ", "帯綴"]
    for _, name, reading, romaji, _ in PEOPLE:
        for x in (name, reading, romaji):
            i = rng.randrange(len(x))
            names += [x[:i] + x[i + 1 :], x[:i] + rng.choice("abcかき巻") + x[i:], x[::-1]]
    names = sorted({n for n in names if n.strip()})
    got, want = scores(spark, rows, people, names), brute(rows, names)
    for n in names:
        assert got[n].keys() == want[n].keys() and all(abs(got[n][p] - want[n][p]) < 1e-9 for p in want[n]), n


def test_rare_tokens_count_more():
    half = [(3.0, 1.0), (1.0, 0.5)]
    assert N.soft(half) == 0.875 > N.soft([(1.0, 1.0), (3.0, 0.5)])


def test_teams_by_join(spark, people):
    names = spark.createDataFrame([(n,) for n in [*MEANT, *NOBODY]], "name string")
    few = {tuple(r) for r in N.normal_names(names, people).collect()}
    assert {tuple(r) for r in N.normal_names(names, people, most_teams=0).collect()} == few
    assert dict(few)["ピアノオー工房縄舟戸晴彦"] == unicodedata.normalize("NFC", "縄舟戸晴彦")


def test_table(spark, people):
    cast = spark.createDataFrame([("e1", 3), ("e1", 5), ("e1", None), ("e2", 4)], "ep string, person_id long")
    items = [("e1", 1, "帯綴"), ("e2", 2, "帯綴"), ("e3", 3, "帯綴"), ("e3", 4, "帯綴嵐"), ("e1", 5, None), ("e1", 6, ""), ("e1", 7, "帯綴"), ("e1", 8, "菱滝六助"), (None, 9, "苺鞍玄作")]
    df = spark.createDataFrame([(*r, "x") for r in items], "ep string, id long, n string, person_id string")
    got = N.link_names(df, ["id"], "ep", "n", people, cast)
    assert sorted(tuple(r) for r in got.collect()) == [(1, 3), (2, 4), (4, 4), (7, 3), (9, 2)]
    assert N.link_names(df.limit(0), ["id"], "ep", "n", people, cast).count() == 0
    assert N.link_names(df, ["id"], "ep", "n", people.limit(0), cast).count() == 0
