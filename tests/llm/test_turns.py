import random

from cuefold.llm import turns as T

CAST = [
    {"spk_id": "SPEAKER_00", "name": "鈴燭菊路", "romaji": "Kikuji Suzushoku", "merged_into": None},
    {"spk_id": "SPEAKER_01", "name": "粉曲輪澪奈", "romaji": "Miona Konakuruwa", "merged_into": None},
    {"spk_id": "SPEAKER_02", "name": None, "romaji": None, "merged_into": "SPEAKER_03"},
    {"spk_id": "SPEAKER_03", "name": None, "romaji": None, "merged_into": "SPEAKER_01"},
]


def test_labels_find_their_speaker():
    own = {x: T.normal_label(x) for x in ["鈴燭", "鈴燭菊路", "鈴燭さん", "SUZUSHOKU", "Suzushoku", "Kikuji Suzushoku", "S0", "ＳＰＫ0", "speaker_0", "speaker 0", "SPEAKER_00", "Suzushokku", "粉曲輪氏", "SPEAKER_02", "Spk3", "拍手", "door", "Rule no"]}
    got = T.link_labels(sorted(set(own.values())), CAST)
    want = {x: "SPEAKER_01" if x in ("粉曲輪氏", "SPEAKER_02", "Spk3") else None if x in ("拍手", "door", "Rule no") else "SPEAKER_00" for x in own}
    assert {x: got.get(own[x]) for x in own} == want


def test_a_label_that_fits_two_means_nobody_and_cycles_end():
    cast = [{"spk_id": f"SPEAKER_0{i}", "name": n, "romaji": None, "merged_into": m} for i, (n, m) in enumerate([("帯綴宙", None), ("帯綴嵐", None), (None, "SPEAKER_03"), (None, "SPEAKER_02")])]
    got = T.link_labels(["帯綴", "帯綴嵐", "#2"], cast)
    assert "帯綴" not in got and got["帯綴嵐"] == "SPEAKER_01" and got["#2"] in ("SPEAKER_02", "SPEAKER_03")
    assert T.link_labels([], []) == {} and T.link_labels(["x"], [], spoken=set()) == {}


def test_utterances():
    assert T.utterances("[00:01:02] >> SUZUSHOKU : Well, uh, go. (applause)") == [("suzushoku", False, True, " Well, uh, go. "), ("applause", True, False, "")]
    assert T.utterances("（手紙の話は3ページに書いてあります。）") == [(None, True, True, "（手紙の話は3ページに書いてあります。）")]
    assert [u[:3] for u in T.utterances("S1: えーと…。\n【粉曲輪】はい。")] == [("#1", False, False), ("粉曲輪", True, True)]
    assert T.utterances("♪ ♪") == [] and T.utterances("") == []
    assert T.utterances("Miona Konakuruwa -- Er, um...")[0][0].startswith("mionakonakuruwa")
    assert not T.is_speech("えっとー……。") and not T.is_speech("Er, um...") and T.is_speech("えっ！？") and T.is_speech("あのー、はい。")


def brute(rows, cast):
    out = {}
    once = {}
    for src, ep, key, ms, text, at in rows:
        if None not in (key, ms, text) and (src, ep, key) not in once or at > once.get((src, ep, key), (None, None, -1))[2]:
            once[src, ep, key] = (ms, text, at)
    for (src, ep, key), (ms, text, _) in sorted(once.items(), key=lambda x: (x[0][0], x[0][1], x[1][0], x[0][2])):
        state = out.setdefault((src, ep), {"who": None, "turns": []})
        utts = T.utterances(text)
        means = T.link_labels(sorted({u[0] for u in utts if u[0]}), cast)
        for label, firm, speech, _ in utts:
            who = means.get(label) if label else None
            speech = speech or (label is not None and not firm and who is None)
            state["who"] = who or state["who"]
            if speech and state["who"]:
                t = state["turns"]
                if t and t[-1][0] == state["who"]:
                    t[-1][2] = ms
                else:
                    t.append([state["who"], ms, ms])
    return sorted((s, e, i, *t) for (s, e), v in out.items() for i, t in enumerate(v["turns"], 1))


def test_turns_match_brute_force(spark):
    rng = random.Random(4)
    forms = ["鈴燭：", "S0: ", "[粉曲輪] ", "SPEAKER_03 - ", "", "", ">> KONAKURUWA:", "<v 鈴燭菊路>", "Rule no. 8: "]
    said = ["はい。", "えーと…。", "（拍手）", "行きましょう。", "（本当です。）", "00:00:01 いや。"]
    rows = []
    for i in range(150):
        text = "\n".join(rng.choice(forms) + rng.choice(said) for _ in range(rng.randrange(1, 3)))
        rows.append((rng.choice(["a", "b"]), "e1", f"k{i:04d}", rng.randrange(0, 4_000_000), text, 1))
    rows += [(*r[:4], "S0: 後。", 2) for r in rows[:6]] + [("a", "e1", "n1", None, "S0: x", 1), ("a", "e1", None, 5, "S0: x", 1), ("a", "e1", "n2", 6, None, 1)]
    df = spark.createDataFrame(rows, "src string, ep string, k string, ms long, t string, at long").selectExpr("src", "ep", "k", "ms", "t", "timestamp_seconds(at) at", "'x' AS turn_no")
    cast = spark.createDataFrame([("e1", c["spk_id"], c["name"], c["romaji"], c["merged_into"]) for c in CAST + CAST[:1]], "ep string, spk_id string, name string, romaji string, merged_into string")
    want = brute([r for r in rows if None not in r], CAST)
    for block in (100_000, 600_000):
        got = T.speaker_turns(df, cast, "src", "ep", "k", "ms", "t", "at", block)
        assert sorted(tuple(r) for r in got.collect()) == want
    assert T.speaker_turns(df.limit(0), cast, "src", "ep", "k", "ms", "t", "at").count() == 0


def test_variants_meet_each_other_first():
    groups = {frozenset(g) for g in T.cluster(["suzushoku", "suzushokku", "kikujisuzushoku|suzushoku", "ksuzushoku", "konatare", "#1", "#11", "door"])}
    assert groups == {frozenset(["suzushoku", "suzushokku", "kikujisuzushoku|suzushoku", "ksuzushoku"]), frozenset(["konatare"]), frozenset(["#1"]), frozenset(["#11"]), frozenset(["door"])}
    # a last name that two people share joins neither
    assert sorted(map(len, T.cluster(["kana mori|mori".replace(" ", ""), "rikumori|mori", "mori"]))) == [1, 1, 1]
    # a variant that fits nobody means whom its cluster means
    cast = [{"spk_id": "SPEAKER_00", "name": None, "romaji": "Kikuji Suzushoku", "merged_into": None}]
    assert T.link_labels(["suzushoku", "suzushokku", "suzushokkuu"], cast)["suzushokkuu"] == "SPEAKER_00"


def test_transcripts_without_a_cast(spark):
    long = "あ" * 70
    rows = [("a", "e9", "1", 0, "Suzushoku: はい。"), ("a", "e9", "2", 1, "suzushokku: いや。（拍手）"), ("a", "e9", "3", 2, f"{long}: どうも。"), ("a", "e9", "4", 3, "それで。")]
    df = spark.createDataFrame(rows, "src string, ep string, k string, ms long, t string").selectExpr("*", "timestamp_seconds(1) at")
    cast = spark.createDataFrame([], "ep string, spk_id string, name string, romaji string, merged_into string")
    got = sorted(tuple(r) for r in T.speaker_turns(df, cast, "src", "ep", "k", "ms", "t", "at").collect())
    assert got == [("a", "e9", 1, "label:suzushokku", 0, 1), ("a", "e9", 2, f"label:{long}", 2, 3)]


def test_clean_lines(spark):
    cast = spark.createDataFrame([("e1", c["spk_id"], c["name"], c["romaji"], c["merged_into"]) for c in CAST], "ep string, spk_id string, name string, romaji string, merged_into string")
    rows = [("a", "e1", "1", 5, "[00:01:02] >> SUZUSHOKU : Well, uh, go. (applause)\n【粉曲輪】えーと、はい。"), ("a", "e1", "2", 6, "Um... ♪ ♪")]
    df = spark.createDataFrame(rows, "src string, ep string, k string, ms long, t string").selectExpr("*", "timestamp_seconds(1) at")
    got = sorted(tuple(r)[2:] for r in T.speaker_lines(df, cast, "src", "ep", "k", "ms", "t", "at").collect())
    assert [(r[0], r[1], r[5]) for r in got] == [(1, "SPEAKER_00", "Well, go."), (2, "SPEAKER_01", "はい。")]
    assert T.clean_speech("uh-huh, yes") == "uh-huh, yes" and T.clean_speech("") == ""
