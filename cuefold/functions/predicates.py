"""What a term, a line or a cue looks like, as column expressions. Null counts as the empty text throughout."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import loose, squeeze

# What stations show on any programme, in lower case.
BROADCAST = (
    "提供", "字幕", "次回予告", "番組", "再生", "停止", "ご覧のスポンサー", "番組の途中ですが", "放送", "生放送", "収録", "スタジオ",
    "tbs", "テレビ朝日", "フジテレビ", "日本テレビ", "テレビ東京", "mbs", "abc", "ytv", "nhk", "bsテレ東", "bs-tbs", "bs朝日", "bsフジ",
    "読売テレビ", "関西テレビ", "東海テレビ", "中京テレビ", "cbcテレビ", "テレビ大阪", "all rights reserved",
)
# Screen texts that are noise as a whole, and the shapes of further noise.
SCREEN_NOISE = ("提供", "字幕", "次回予告", "番組", "再生", "停止")
SIGNS_ONLY = "^[^\\p{L}\\p{N}_]+$"
SHORT_LATIN = "^[A-Za-z0-9]{1,2}$"
CREDITS = "©|(?i:\\bProduced by\\b)"
COPYRIGHT = "^[©◎]\\s*[0-9]{4}"
# Short tokens that fill a board without saying anything.
FILL = ("答え", "解答")
FILL_SIGNS = "^[?？!！↓↑→←]+$"
# Words and endings of instructions.
ORDERS = ("答え", "解答", "方法", "してください", "できません", "可能", "掛け算", "動かして")
ORDER_SIGNS = "[?？↓↑→←]|[0-9]{3,}"
ORDER_ENDS = "(?:[はをにへでとのが]|している|されている|できる|できない|できません|する|した|して|なる|なった|ある|いる|せよ|とは)$"
# Shapes that make a term unsafe for a prompt.
UNSAFE = "^[0-9A-Za-z?？!！↓↑→←\\-=(){}./:~〜]+$|\\b(?:AM|PM)\\b|[0-9]{1,2}:[0-9]{2}|パーソナリティ|番組HP"
# Names with a form of address, what only looks like one, and shorts that say nothing.
ADDRESSED = "[ぁ-んァ-ヶ一-龯A-Za-z0-9]{1,12}(?:さん|くん|ちゃん|氏)"
NOT_ADDRESSED = ("くんない", "ちゃんと", "さんざん")
TRIVIAL = ("あ", "え", "お", "うん", "はい", "へえ", "うわ", "おお", "ええ", "マジ", "本当", "ほんま")
NO_NAMES = ("オッケー", "オーケー", "やばい", "やだね", "ほんでも", "ほんでもよ")
# Words of narration, in spoken regions and in lines on screen.
NARRATION = ("一方", "ここで", "時刻", "スタートから", "ご覧の通り", "現在地", "現在位置", "到着", "状況", "優勢", "劣勢", "右狙い", "左狙い", "ゴール目前", "ゴール", "引いた", "だったが", "抜けると", "到達", "経過", "PM")
SCREEN_NARRATION = ("ご覧の通り", "現在地", "現在位置", "状況", "一方", "優勢", "劣勢", "スタートから", "ルール", "挑戦", "設定", "被害者", "刑事", "残り", "得点", "経過", "順位", "ここまで")
# Words that ask or set up.
ASKING = ("何", "どう", "なんで", "どこ", "誰", "かい", "って")
JAPANESE = "[ぁ-ゟァ-ヿ一-龯]"
LETTER = "[ぁ-んァ-ン一-龯ー]"
ENDED = "[。！？!?」』）】]$"
#: White space of any kind, spelt out for engines that know ASCII only.
SPACE = "[\\s\u3000\u00a0\u2000-\u200a]"


def _t(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def holds_any(text: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(_t(text), F.lit(w)) for w in words])


def is_broadcast(term: Column) -> Column:
    return F.lower(_t(term)).isin(*BROADCAST)


def is_screen_noise(term: Column) -> Column:
    """A fixed text, one character or none, signs alone, two Latin letters, one sign eight times or more, credits."""
    t = _t(term)
    return t.isin(*SCREEN_NOISE) | (F.length(t) <= 1) | t.rlike(SIGNS_ONLY) | t.rlike(SHORT_LATIN) | t.rlike("^(.)\\1{7,}$") | t.rlike(CREDITS)


def is_short_fill(term: Column) -> Column:
    t = _t(term)
    return (F.length(t) <= 2) | t.isin(*FILL) | t.rlike(FILL_SIGNS)


def is_sentence_like(term: Column) -> Column:
    t = _t(term)
    return (F.length(t) >= 24) | t.rlike("[。！？!?]$") | (F.contains(t, F.lit("、")) & (F.length(t) >= 12))


def is_instruction_like(term: Column) -> Column:
    return holds_any(term, ORDERS) | _t(term).rlike(f"{ORDER_SIGNS}|{ORDER_ENDS}")


def is_entity_like(term: Column) -> Column:
    return ~is_screen_noise(term) & ~is_sentence_like(term) & ~is_instruction_like(term) & F.length(_t(term)).between(2, 20)


def is_prompt_safe(term: Column) -> Column:
    t = _t(term)
    return ~is_screen_noise(t) & ~is_sentence_like(t) & ~is_instruction_like(t) & (F.length(t) <= 24) & ~t.rlike(UNSAFE)


def is_japanese(line: Column) -> Column:
    return _t(line).rlike(JAPANESE)


def is_addressed(text: Column) -> Column:
    """Whether a name with a form of address seems to be there."""
    return ~holds_any(text, NOT_ADDRESSED) & _t(text).rlike(ADDRESSED)


def is_bare_name(text: Column) -> Column:
    """Whether a short text may be a name alone, asked for or addressed: a stem of two to six, then ``か`` or ``さん``."""
    form = loose(text)
    stops = {"".join(chr(ord(c) - 0x60) if "ァ" <= c <= "ヶ" else c for c in w.replace("ー", "")) for w in NO_NAMES}
    stem = F.regexp_replace(F.regexp_replace(form, "か$", ""), "さん$", "")
    return ~form.isin(*stops) & _t(text).rlike("[ァ-ヶ一-龯A-Za-z]") & form.rlike("(?:か|さん)$") & F.length(stem).between(2, 6)


def asks(text: Column) -> Column:
    return _t(text).rlike("[?？]")


def is_worth_checking(text: Column) -> Column:
    """A short line whose words matter: it names, asks or counts."""
    return is_addressed(text) | is_bare_name(text) | asks(text) | squeeze(text).rlike("\\p{Nd}")


def is_trivial(text: Column) -> Column:
    return squeeze(text).isin(*TRIVIAL)


def is_question_or_setup(text: Column) -> Column:
    t = F.regexp_replace(_t(text), f"^{SPACE}+|{SPACE}+$", "")
    return t.rlike("[?？]$") | holds_any(t, ASKING)


def is_interjection(text: Column) -> Column:
    return F.length(F.translate(_t(text), " \n", "")) <= 8


def looks_split(left: Column, right: Column) -> Column:
    """Whether a sentence seems to run over the border of two cues: letters on both sides and no mark between."""
    a, b = F.replace(_t(left), F.lit("\n"), F.lit("")), F.replace(_t(right), F.lit("\n"), F.lit(""))
    return (F.length(a) > 0) & (F.length(b) > 0) & ~a.rlike(ENDED) & a.rlike(f"{LETTER}$") & b.rlike(f"^{LETTER}")


def is_weak_anchor(vocab_share: Column, start_ms: Column, end_ms: Column, text: Column) -> Column:
    return (vocab_share < 0.4) | ((end_ms <= start_ms) & (F.length(_t(text)) <= 10))


def error_class(message: Column) -> Column:
    """``quota``, ``no_progress``, ``timeout``, ``transient`` or ``other``, by what a service's message says."""
    m, low = _t(message), F.lower(_t(message))
    any_of = lambda *words: holds_any(low, words)
    return (
        F.when(F.contains(m, F.lit("429")) | any_of("resource_exhausted", "rate-limit errors", "rate limit"), "quota")
        .when(any_of("no_progress_timeout"), "no_progress")
        .when(any_of("deadline_exceeded", "timed out", "timeout"), "timeout")
        .when(F.contains(m, F.lit("499")) | any_of("cancelled") | F.contains(m, F.lit("500")) | any_of("internal", "connectionreset", "connectionerror", "brokenpipe", "eof", "ssl"), "transient")
        .otherwise("other")
    )


def merged_review(said: Column, cps_faults: Column, line_faults: Column, broken: Column) -> Column:
    """A reviewer's mark with what the counts say: ``review, reasons, yellow_class``.

    A broken batch is red. Faults make it yellow at least, never milder than what was said. A yellow one is
    ``structural`` with line faults, else ``user`` if it was said, else ``cps_only``.
    """
    faults = F.filter(F.array(F.when(cps_faults > 0, "hard_cps"), F.when(line_faults > 0, "line_count")), lambda x: x.isNotNull())
    review = F.when(broken, "red").when(said == "red", "red").when((F.size(faults) > 0) | (said == "yellow"), "yellow").otherwise("green")
    kind = F.when(line_faults > 0, "structural").when(said == "yellow", "user").otherwise("cps_only")
    reasons = F.when(said == "yellow", F.concat(faults, F.array(F.lit("user_review")))).otherwise(faults)
    return F.struct(review.alias("review"), F.when(review == "yellow", reasons).otherwise(F.array().cast("array<string>")).alias("reasons"), F.when(review == "yellow", kind).alias("yellow_class"))


# Signs at a term's edges that aren't part of it.
EDGES = "[\\s\u3000\\-−—―─–\"'「」『』【】（）()\\[\\]《》〈〉・、。,.!！?？:：;；~〜…♪★☆●○◆◇▶▷◀◁△▽→←↑↓※♥❤\ufe0f#＃]+"


def bare_term(term: Column) -> Column:
    """A term without signs and white space at its edges."""
    return F.regexp_replace(_t(term), f"^{EDGES}|{EDGES}$", "")


def tidy_transcript(text: Column) -> Column:
    """Lines of a transcript in one notation: ``-- `` before speech, ``[画面: …]`` around what is shown; empty lines go."""
    strip = lambda x: F.regexp_replace(x, f"^{SPACE}+|{SPACE}+$", "")
    fenced = F.regexp_replace(F.regexp_replace(strip(_t(text)), "^```[A-Za-z]*\\s*", ""), "\\s*```$", "")
    lines = F.filter(F.transform(F.split(fenced, "\r?\n"), strip), lambda x: F.length(x) > 0)
    dash = lambda x: F.regexp_replace(x, "^- +(?!-)", "-- ")
    named = lambda x: F.regexp_replace(x, "^(?i:speaker\\s+[a-z0-9]+:)\\s*", "-- ")
    shown = lambda x: F.when(x.rlike("^\\[画面[:：]"), F.concat(F.lit("[画面: "), strip(F.regexp_replace(F.regexp_replace(x, "^\\[画面[:：]", ""), "\\]$", "")), F.lit("]"))).otherwise(x)
    return F.array_join(F.transform(lines, lambda x: shown(named(dash(x)))), "\n")


def without_tail_loop(text: Column, least: int = 2, most: int = 50, keep: int = 2) -> Column:
    """A text whose end says one phrase three times or more, with two of them left; the phrase that covers most counts.

    A phrase has ``least`` to ``most`` characters, the shortest of equal cover. Null stays null.
    """
    n = F.length(text)

    sizes = F.filter(F.sequence(F.lit(least), F.lit(most)), lambda k: k * 3 <= n)

    def copies(k):
        tail = F.substr(text, n - k + 1, k)
        # how many whole copies stand at the end: step back while the piece before equals the tail
        steps = F.sequence(F.lit(1), F.floor(n / k).cast("int"))
        return F.aggregate(steps, F.lit(0), lambda a, i: F.when((a == i - 1) & (F.substr(text, n - i * k + 1, k) == tail), i).otherwise(a))

    found = F.filter(F.transform(sizes, lambda k: F.struct((copies(k) * k).alias("cover"), (-k).alias("k"), copies(k).alias("c"))), lambda x: x["c"] >= 3)
    best = F.array_max(found)
    cut = F.substr(text, F.lit(1), n - best["cover"] - best["k"] * keep)
    return F.when(F.size(found) > 0, F.regexp_replace(cut, f"{SPACE}+$", "")).otherwise(text)
