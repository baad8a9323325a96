import random

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cuefold.operators import repair as R
from cuefold.operators import retime as T

WORDS = [(0, 300, "行き"), (300, 600, "ましょう。"), (900, 1200, "扉が"), (1200, 1500, "開きます。"), (2000, 2300, "行き"), (2300, 2600, "ましょう。")]


def test_cues_find_their_words():
    cues = [(0, 600, "行きましょう。"), (900, 1500, "扉が\n開きます。"), (2000, 2600, "行きましょう。"), (2100, 2200, "ちがう"), (9000, 9100, "無")]
    assert R.match_words(cues, WORDS) == [(0, 1, "near"), (2, 3, "near"), (4, 5, "near"), None, None]
    assert R.match_words([(850, 1500, "ちがう")], WORDS)[0] == (2, 3, "time")
    assert R.match_words([(0, 1, " ")], WORDS) == [None] and R.match_words([(0, 1, "x")], []) == [None]


def slow_match(cue, words, pos):
    """Word by word, as the rule is stated."""
    target, best = R._form(cue[2]), None
    for i in range(max(0, pos - 120), min(len(words), pos + 121)):
        for j in range(i, len(words)):
            if R._form("".join(w[2] for w in words[i : j + 1])) == target:
                score = abs(words[i][0] - cue[0]) + abs(words[j][1] - cue[1]) + (250 if i < pos else 0)
                best = min(best or (score, i, j), (score, i, j))
                break
    return best and best[1:]


def test_matching_agrees_with_word_by_word():
    rng = random.Random(5)
    for _ in range(40):
        words = [(i * 100, i * 100 + 90, rng.choice(["あ", "い", "ab ", "う。"])) for i in range(60)]
        cues, at = [], 0
        while at < 55:
            n = rng.randrange(1, 5)
            cues.append((words[at][0], words[at + n - 1][1], "".join(w[2] for w in words[at : at + n])))
            at += n
        got, pos = R.match_words(cues, words), 0
        for c, g in zip(cues, got):
            want = slow_match(c, words, pos)
            assert g[:2] == want
            pos = g[1] + 1


def test_options_and_repair():
    words = [(i * 500, i * 500 + 450, w) for i, w in enumerate(["これは", "とても", "長い", "文章です。", "でも", "まだ", "続き", "ます。"] * 3)]
    long = R._of_words(words, 0, 15)
    assert R.is_long(long) and R.split_places(long, words)[0] in (3, 7, 11)
    out, done = R.repair([long, R._of_words(words, 16, 16), R._of_words(words, 17, 23)], words)
    assert "".join(c[2] for c in out) == "".join(w[2] for w in words) and any(n.startswith("split") for _, n in done)
    assert all(a[4] + 1 == b[3] for a, b in zip(out, out[1:]))
    assert R.repair([], []) == ([], [])
    kept, did = R.repair([[0, 500, "はい。", 0, 0]], [(0, 500, "はい。")])
    assert kept == [[0, 500, "はい。", 0, 0]] and did == []
    assert [o[1] for o in R.options([[0, 700, "そうです。", 0, 0], [3000, 6000, "扉が開きます。", 1, 1]], [(0, 700, "そうです。"), (3000, 6000, "扉が開きます。")], 0)] == ["keep", "extend_right", "extend_both"]


def test_regions_keep_their_text():
    cues = [(0, 1000, "ab cd"), (1000, 3000, "efgh")]
    assert R.rebuild(cues, ["abc", "defgh"]) == [(0, 750, "abc"), (750, 3000, "defgh")]
    for bad in ([], ["abc"], ["abcd", " ", "efgh"]):
        with pytest.raises(ValueError):
            R.rebuild(cues, bad)


def test_rescue_splits_and_leads():
    rows = [(0, 0, "あい"), (0, 0, "うえ"), (5, 9, "お")]
    assert R.rescue(rows, {1}, [(10, 20, "あい"), (30, 30, "う"), (40, 50, "え"), (60, 70, "お")]) == [(0, 0, "あい"), (40, 50, "うえ"), (5, 9, "お")]
    parts = R.split_long(0, 25_000, [(i * 1000, i * 1000 + 900, f"{i};") for i in range(25)])
    assert "".join(t for *_, t in parts) == "".join(f"{i};" for i in range(25)) and all(e - s <= 10_000 for s, e, _ in parts)
    assert R.split_line((0, 9_000, "ab。cd"), [(0, 4000, "ab。"), (4000, 9000, "cd")]) == [(0, 4000, "ab。"), (4000, 9000, "cd")]
    assert R.split_line((0, 100, "x"), []) == [(0, 100, "x")]
    assert R.cap_lead(0, 1000, (800, 1500), 0, None) == (600, 1600) and R.cap_lead(0, 1000, (800, 1500), 0, 1200) == (600, 1200)


CUES = st.lists(st.tuples(st.integers(0, 3000), st.integers(1, 3000), st.sampled_from(["a", "hello there", "x" * 30])), max_size=14)


@settings(max_examples=60, deadline=None)
@given(CUES)
def test_merging_keeps_text_and_order(steps):
    cues, at = [], 0
    for gap, size, text in steps:
        cues.append((at + gap, at + gap + size, text))
        at += gap + size
    for f in (R.merge_hurried, R.merge_micro):
        out = f(cues)
        assert " ".join(" ".join(t for *_, t in out).split()) == " ".join(" ".join(t for *_, t in cues).split())
        assert all(a[1] <= b[0] for a, b in zip(out, out[1:])) and f(out) == out


def test_rewrap_and_words():
    assert R.rewrap(["a", "bb", "ccc"]) == "a bb\nccc" and R.rewrap(["a"]) == "a" and R.rewrap(["a", "b"], 1) is None
    p = pd.DataFrame({"s": [0, 700, 900, 5000], "e": [500, 900, 900, 9000], "word": ["hello ", "you", "!", "there"]})
    out = T.reflow_words()(p)
    assert "".join("".join(out["text"]).split()) == "helloyou!there" and (out["start_ms"].diff().dropna() > 0).all()


def test_cuts_at_sentences():
    gaps = [(100_000, 101_000), (200_000, 201_000), (240_000, 241_000)]
    speech = [(95_000, 100_000, "そして"), (195_000, 200_000, "終わりました。"), (235_000, 240_000, "それから")]
    assert R.sentence_cuts(gaps, speech, 400_000) == [(0, 200_500), (200_500, 400_000)]
    assert R.sentence_cuts([], [], 800_000, hard=300_000) == [(0, 300_000), (300_000, 600_000), (600_000, 800_000)]
    assert [R.boundary_score(t) for t in ("はい。", "行って", "x", "")] == [2, 0, 1, 1]


def test_time_warp():
    a = [(0, 1000, "good morning all"), (2000, 3000, "see the old clock"), (4000, 5000, "bye for now then")]
    b = [(0, 2000, "good morning, all"), (4000, 6000, "see an old clock"), (8000, 10_000, "bye for now, then")]
    anchors = R.text_anchors(a, b)
    assert anchors == [(0, 0), (1000, 2000), (5000, 10_000), (9000, 18_000), (10_000, 20_000)]
    assert R.draft(a, b, anchors) == [(0, [0], False), (1, [1], False), (2, [2], False)]
    assert R.draft(a, b[:1], [(0, 0), (10_000, 20_000)])[2] == (2, [0], True)
    assert R.retimed(b, anchors, 5000) == [(0, 1000, b[0][2]), (2000, 3000, b[1][2]), (4000, 5000, b[2][2])]
    assert R.text_anchors([], b) == [] and R.draft(a, [], [(0, 0), (1, 1)])[0] == (0, [], False)
