import pytest

from cuefold.llm import sentences as S

ONES = [
    "Let's go.", "They met again at 6 p.m.", "Dr. Adams says the bell weighs 3.5 kg.", "Run to the pier, Brook!", "Is it from ‘Dr. Siren’?", "“Where is it? Hand it over!” Adams shouted.", "It was 9.30 a.m. when Brook woke up.",
    "Brook flew back to the U.S.", "Bring ropes, tape, etc. and wait.", "Well... I suppose it is yours.", "No. 64 was red.", "Mr. Brook pressed it 3 times.", "Not again...", "It starts at 5 p.m. in the hall.",
]
JA = ["行きましょう。", "「行くぞ！」「おう！」と二人は叫びました。", "私は……手紙を信じます。", "『急げ！夜店』という番組を覚えていますか？", "まさか……。", "（手紙の話は3ページに書いてあります。）", "実は昨日、屋上で会いました。", "扉が開きます。", "えっ！？"]
TH = ["รีบวิ่งไปที่ท่าเรือเร็วเข้านะครับ", "ไม่อยากจะเชื่อเลยค่ะ", "หมายเลข 10 เป็นของคุณใช่ไหมคะ", "ถ้าเจอกุญแจ ช่วยบอกด้วยนะคะ"]


def corpus():
    out = []
    for own, sep in ((ONES, " "), (JA, ""), (TH, " ")):
        for i in range(len(own) * 24):
            a, b = own[i % len(own)], own[(i * 7 + i // len(own)) % len(own)]
            out += [a, b, a + sep + b]
    out += [x.rstrip("。") for x in JA[6:8]] * 20
    out += [x.replace(a, a + "\n") for x in JA for a in ("を", "と", "で", "は") if a in x] * 12
    return out


@pytest.fixture(scope="module")
def splitter():
    return S.Splitter(S.fit(corpus()))


def texts(splitter, t):
    return [t[a:b] for a, b in splitter.spans(t)]


def test_pairs_of_known_sentences_come_apart(splitter):
    right = total = 0
    for own, sep in ((ONES, " "), (JA, ""), (TH, " ")):
        for a in own:
            for b in own:
                total += 1
                right += texts(splitter, a + sep + b) == [a, b]
    assert right >= 0.97 * total, (right, total)


def test_new_words_in_known_places(splitter):
    assert texts(splitter, "Dr. Zeller says a bell weighs 9.1 kg. Run to the gate, Zeller!") == ["Dr. Zeller says a bell weighs 9.1 kg.", "Run to the gate, Zeller!"]
    assert texts(splitter, "実は昨日、裏門で会いました 扉が開きます") == ["実は昨日、裏門で会いました", "扉が開きます"]


def test_labels_stamps_and_notes_belong_to_no_sentence(splitter):
    t = "[00:01:17] SPEAKER_01: 行きましょう。 (笑)\n- 扉が開きます。 ♪"
    assert texts(splitter, t) == ["行きましょう。", "扉が開きます。"]
    for t in ("", "   ", "（拍手）", "♪ ♪", "[音楽]", "00:00:01", "- ", "S1: [applause]", "…"):
        assert splitter.spans(t) == [], t


def test_line_breaks_end_nothing(splitter):
    assert texts(splitter, "『急げ！夜店』という番組を\n覚えていますか？") == ["『急げ！夜店』という番組を\n覚えていますか？"]


def test_positions_hold_for_stored_text(splitter):
    t = "行き​ましょう。﻿扉が開きます。"
    assert [b for _, b in splitter.spans(t)] == [8, 16]
    assert [b for _, b in splitter.spans("Ｌｅt's ｇｏ． Ｌｅt's ｇｏ．")] == [9, 19]


def test_table(spark):
    rows = [(1, "行きましょう。扉が開きます。", 5), (1, "行きましょう。扉が開きます。", 5), (2, None, 5), (3, "", 5), (4, "扉が開きます。" * 3000, 5)]
    df = spark.createDataFrame(rows, "row_id long, t string, end_pos int")
    got = S.sentence_ends(df, ["row_id"], "t")
    assert got.columns == ["row_id", "end_pos"]
    assert sorted((r.row_id, r.end_pos) for r in got.filter("row_id < 4").collect()) == [(1, 7), (1, 7), (1, 14), (1, 14)]
    assert got.filter("row_id = 4").count() == 3000
    assert S.sentence_ends(spark.createDataFrame([], "row_id long, t string"), ["row_id"], "t").count() == 0


def test_long_texts_alone_fit_a_model(spark):
    parts = ["Dr. Aida met Mr. Brook at 5 p.m. on the pier.", "Nobody knew who had the spare key!", "Was it late when the last boat came in?", "She put the lamp down and left the room."]
    rows = [(i, "\n".join(" ".join(parts[(i + j + k) % 4] for k in range(3)) for j in range(30))) for i in range(60)] + [(99, "「" + "長い話。" * 150 + "」と言った。")]
    df = spark.createDataFrame(rows, "row_id long, t string")
    assert all(len(t) > 2000 for _, t in rows[:-1]) and len(S.sample_texts(df, "t", 20_000)) > 3
    assert len(S.sample_texts(df, "t", 20_000, fit_chars=1_000)) < len(S.sample_texts(df, "t", 20_000))
    got = S.sentence_ends(df, ["row_id"], "t")
    ends = {r.row_id: r.n for r in got.groupBy("row_id").count().withColumnRenamed("count", "n").collect()}
    assert ends[0] >= 80
    assert got.filter("row_id = 99 AND end_pos < 602").isEmpty()  # nothing ends within a quotation, however long it is
