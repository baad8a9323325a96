import re

from hypothesis import given, settings
from hypothesis import strategies as st

from cuefold.llm import chunks as C

ALPHABET = st.sampled_from(list("abcあ漢é .,。!\n\n　…♪「」-") + ["\r\n", "é", "x" * 30])


@settings(max_examples=250, deadline=None)
@given(st.lists(ALPHABET, min_size=1, max_size=120).map("".join), st.sampled_from([(40, 8), (20, 0), (120, 20)]))
def test_pieces_cover_and_fit(t, size):
    limit, overlap = size
    own, forced = C.pieces(t, limit, overlap)
    assert "".join(t[n:b] for _, n, b in own) == t
    assert own[0][0] == 0
    for a, n, b in own:
        assert a <= n < b and b - a <= limit and n - a <= overlap
    # no separator in a stretch longer than the limit
    import regex

    assert forced == bool(regex.search(r"[^\s\p{Z}\p{P}\p{S}]{%d}" % (limit + 1), t))


def test_cuts_at_the_widest_unit():
    t = "One two three. Four five six.\n\nSeven eight nine ten."
    own, _ = C.pieces(t, 34, 0)
    assert [t[a:b] for a, _, b in own] == ["One two three. Four five six.\n\n", "Seven eight nine ten."]
    own, _ = C.pieces("One two three. Four five six.", 20, 0)
    assert [b for _, _, b in own] == [15, 29]


def test_overlap_starts_at_a_word():
    t = " ".join(["word%02d" % i for i in range(30)])
    own, _ = C.pieces(t, 50, 15)
    for a, n, _ in own[1:]:
        assert a < n and (a == 0 or t[a - 1] == " ")


def test_clusters_stay_whole():
    t = "e\u0301" * 100
    own, forced = C.pieces(t, 31, 0)
    assert forced and all(re.match("e", t[b:]) for _, _, b in own[:-1])


def test_table(spark):
    rows = [(1, "word " * 40, 0, 1000), (2, "short", 0, 9), (3, None, 0, 9), (4, "", 0, 9), (5, "y" * 130, None, 9), (6, "z" * 121, 9, 9)]
    df = spark.createDataFrame([(*r, "q") for r in rows], "cue_id long, t string, s long, e long, text string")
    got = [r.asDict() for r in C.split_oversized(df, ["cue_id"], "t", 120, 20, "s", "e").orderBy("cue_id", "piece_no").collect()]
    assert {r["cue_id"] for r in got} == {1, 5, 6}
    first = [r for r in got if r["cue_id"] == 1]
    assert first[0]["start_ms"] == 0 and first[-1]["end_ms"] == 1000 and all(x["end_ms"] == y["start_ms"] for x, y in zip(first, first[1:]))
    assert not first[0]["forced"] and all(r["forced"] and r["start_ms"] is None for r in got if r["cue_id"] != 1)
    assert C.split_oversized(df.limit(0), ["cue_id"], "t").count() == 0
    assert C.split_oversized(df, ["cue_id"], "t", all_rows=True).filter("cue_id = 2").count() == 1
