"""Sentence ends in many scripts: candidate boundaries, classified by a maximum-entropy model.

Candidates are final marks, closed quotations that hold a final mark, bracketed sentences, and, in scripts written
without spaces, white space. The model is fitted on reliable examples alone: where one text ends and another begins is
a boundary; a mark before a small letter, a digit or a comma is none, and neither is one after a word that the sample
often shows inside texts but never at their end (abbreviations, particles, openers).
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookalike import BLANKS, SHARED_SHAPES, SHOWN_FORMATS

#: Scripts whose words aren't divided by spaces: Thai to Tibetan, Myanmar, Khmer, kana and Han.
_DENSE = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3041-\u30ff\u3400-\u9fff\uf900-\ufaff"
_FINAL = ".!?！？。।॥…؟۔"
_NOTE = r"<[^<>\n]+>|[\[【〔〈][^\[【〔〈\]】〕〉\n]+[\]】〕〉]|\*[^*\n]+\*|\d?\d:\d\d:\d\d(?:[.,]\d+)?"
_TOKEN = re.compile(
    rf"(?P<note>{_NOTE}|[♪♫♬]+~?)"
    r"|(?P<round>[(（][^()（）]+[)）])"
    r"|(?P<quote>「[^「」]*」|『[^『』]*』|“[^“”]*”|„[^„“”]*[“”]|«[^«»]*»|‘[^‘’]*’)"
    rf"|(?P<mark>[{_FINAL}]+[\"”’»」』\]]*)"
    rf"|(?P<space>(?<=[{_DENSE}])\s+)"
)
_INVISIBLE = re.compile("[" + "".join(chr(c) for c in range(0x10000) if unicodedata.category(chr(c)) == "Cf" and c not in SHOWN_FORMATS) + BLANKS + "\ufe00-\ufe0f]")
_WORD = re.compile(r"[^\W_]+")
#: What stands before speech: dashes, notes, stamps and labels. Labels have 31 and asides 60 code points at most, as longer
#: ones are sentences; this tells where a sentence begins, never where it ends.
_LEAD = re.compile(
    rf"(?:[\s\-–—>♪♫♬~]+|{_NOTE}|[(（][^()（）\n.!?。！？…]{{1,60}}[)）]"
    r"|speaker[_ ]?\d+\s+-(?=\s)|[^\s:：.!?。！？「『“„«(（\[<][^:：\n.!?。！？「『“„«]{0,30}[:：](?!\d\d:))*",
    re.I,
)
_LABELLED = re.compile(r"\s*(?:[-–—>]+\s*)*(?:[\[(<]?\d?\d:\d\d:\d\d|speaker[ _]?\d+\s*[-:：]|[A-Z][A-Za-z0-9_]+\s?[:：](?!\d\d:)|[\u3400-\u9fff]{1,8}(?:氏|さん)?\s?[:：])", re.I)
_SEP = re.compile(r"(\s*)((?:[-–—>]+\s*)?)([^\W\d_]+|\d+|.)?", re.S)
_CJK = re.compile("[\u3041-\u30ff\u3400-\u9fff]")
_SMALL = str.maketrans("0123456789", "0" * 10)


def _plain() -> dict[int, str]:
    """One code point for one: width variants, radicals and shared letter shapes in their plain form."""
    to = {ord(x): w[0] for w in SHARED_SHAPES.split()[:-12] for x in w[1:]}
    for c in [*range(0x2E80, 0x2FE0), *range(0xFF01, 0xFFEF), *range(0x2000, 0x2010), 0xA0, 0x3000, 0x202F, 0x205F]:
        form = unicodedata.normalize("NFKC", chr(c))
        if len(form) == 1 and form != chr(c):
            to[c] = form
    return {c: x for c, x in to.items() if chr(c) not in "！？（）："}


_PLAIN = _plain()
_ODD = re.compile(_INVISIBLE.pattern[:-1] + "".join(map(chr, _PLAIN)) + "]")


def _clean(text: str) -> tuple[str, list[int] | None]:
    """The text as the scanner reads it and, where invisible code points were left out, the place of each kept one."""
    if text.isascii() or not _ODD.search(text):
        return text, None
    if _INVISIBLE.search(text):
        at = [i for i, c in enumerate(text) if not _INVISIBLE.match(c)]
        return "".join(text[i] for i in at).translate(_PLAIN), at
    return text.translate(_PLAIN), None


def _short(word: str) -> str:
    if not word:
        return word
    if word[-1] > "\u0dff" and _dense(word[-1]):
        word = word[-3:]
        return word if word.isalpha() else word.translate(_SMALL)
    if word.isalpha():
        return word[:14].lower()
    return "0" * min(len(word), 9) if word.isdigit() else word[:14].lower().translate(_SMALL)


def _kind(mark: str) -> str:
    return mark.replace("？", "?").replace("！", "!")


def _dense(c: str) -> bool:
    return "\u0e00" <= c <= "\u109f" or "\u1780" <= c <= "\u17ff" or "\u3005" <= c <= "\u9fff" or "\uf900" <= c <= "\ufaff"


def _shape(token: str) -> str:
    if not token:
        return "none"
    c = token[0]
    if c.isdigit():
        return "digit"
    if c.isupper():
        return "upper1" if len(token) == 1 else "upper" if token.isupper() else "title"
    if c.islower():
        return "lower1" if len(token) == 1 else "lower"
    if "\u3041" <= c <= "\u309f":
        return "hiragana"
    if "\u30a0" <= c <= "\u30ff":
        return "katakana"
    if c.isalpha():
        return "han" if "\u3400" <= c <= "\u9fff" else "thai" if "\u0e00" <= c <= "\u0e7f" else "letter"
    return "p" + c


def candidates(t: str) -> Iterator[tuple[int, int, tuple, bool]]:
    """``(end, next, key, sure)`` of every place in a cleaned text where a sentence may end, in order.

    key: kind, the two words before, what separates, the word after. sure: no decision is needed. The last candidate is
    the end of the last speech in the text.
    """
    last, n = 0, len(t)
    notes: list[tuple[int, int]] = []
    for m in _TOKEN.finditer(t):
        kind, (a, b) = m.lastgroup, m.span()
        if kind == "round":
            inner = t[a + 1 : b - 1].rstrip()
            kind = "aside" if inner and inner[-1] in _FINAL else "note"
        if kind in ("note", "aside"):
            left = len(t[last:a].rstrip()) + last
            if left > last and _dense(t[left - 1]):
                yield left, a, _key(t, last, left, "close", a), False
            if kind == "note":
                notes.append((a, b))
            else:
                yield b, b, _key(t, a, b, "aside", b), True
            if not t[last:a].strip() or kind == "aside":
                last = b
            continue
        if kind == "quote":
            inner = t[a + 1 : b - 1].rstrip()
            if not inner or inner[-1] not in _FINAL:
                continue
            before = t[last:a].rstrip()[-1:]
            yield b, b, _key(t, last, b, "q" + t[a] + _kind(inner[-1]) + (before if before in ":：,、，" else "w" if before else ""), b), False
        elif kind == "mark":
            yield b, b, _key(t, last, b, _kind(m.group()[:3]), b), False
        else:
            yield a, b, _key(t, last, a, "space", a), False
    end = n
    while end:
        while end and (t[end - 1].isspace() or t[end - 1] in "-–—>"):
            end -= 1
        if notes and notes[-1][1] == end:
            end = notes.pop()[0]
        else:
            break
    if end:
        yield end, n, _key(t, last, end, "end", n), True


def _key(t: str, low: int, end: int, kind: str, after: int) -> tuple:
    words = _WORD.findall(t, max(low, end - 40), end)
    sep, dash, nxt = _SEP.match(t, after).groups()
    between = "dash" if dash else "line" if "\n" in sep else "space" if sep else ""
    if sep and _LABELLED.match(t, after):
        between, nxt = "dash", ""
    return kind, _short(words[-2]) if len(words) > 1 else "", _short(words[-1]) if words else "", _shape(words[-1]) if words else "none", between, nxt or ""


def features(key: tuple) -> list[str]:
    kind, before, prev, shape, between, nxt = key
    after, word = _shape(nxt), _short(nxt)[:6]
    k = f"{kind}|"
    return [
        "bias", k, k + shape, k + prev, k + prev[-2:], k + prev[-1:], k + before + "_" + prev, "<" + prev, "<2" + before,
        ">" + word, k + ">" + after, k + shape + ">" + after, ">1" + nxt[:1], "sep" + between, k + between + ">" + after, "len" + str(min(len(prev), 5)),
    ]


def _reliable(texts: list[str]) -> tuple[list[tuple], list[int]]:
    """Keys and labels (1: boundary) that can be trusted without annotation."""
    inner: list[tuple] = []
    seen, final = Counter(), Counter()
    heads, tails = defaultdict(list), defaultdict(list)

    def types(key: tuple) -> list[tuple]:
        kind, before, prev, shape, *_ = key
        return [(kind, before, prev), (kind, prev), (kind, prev[-2:], "suffix"), (kind, shape)]

    for text in texts:
        t, own = _clean(text)[0], None
        own = list(candidates(t))
        if not own:
            continue
        end = own[-1][0]
        for a, _, key, sure in own[:-1]:
            if a < end and not sure:
                inner.append(key)
                seen.update(types(key))
        # what ends the text, read as the same place would be inside one
        reopened = [c for c in candidates(t[:end] + " _") if c[0] == end and not c[3]]
        if not reopened and _dense(t[end - 1]):
            reopened = [(end, end, _key(t, max(0, end - 40), end, "space", len(t)), False)]
        m = _LEAD.match(t)
        head = _SEP.match(t, m.end()).group(3) or ""
        script = bool(_CJK.search(t)), "\u0e00" <= max(t) <= "\u0eff"
        heads[script].append(head)
        if reopened:
            seen.update(types(reopened[0][2]))
            final.update(types(reopened[0][2]))
            tails[script].append(reopened[0][2])
    keys, labels = [], []
    for group, own in tails.items():
        own_heads = heads.get(group) or [h for hs in heads.values() for h in hs]
        for i, (kind, before, prev, shape, _, _) in enumerate(own):
            nxt = own_heads[(i * 7919) % len(own_heads)]
            for between in ("space", "line") if kind == "space" else ("space", "line", "dash", "") if i % 2 else ("space", ""):
                keys.append((kind, before, prev, shape, between, nxt))
                labels.append(1)
            if kind == "space":  # the same end before an annotation
                keys.append(("close", before, prev, shape, "", "（"))
                labels.append(1)
    for key in inner:
        kind, _, prev, shape, between, nxt = key
        if between == "dash" and not nxt:  # a label follows
            keys.append(key)
            labels.append(1)
            continue
        after = _shape(nxt)
        small = after in ("lower", "lower1") or nxt[:1] in tuple(",;、，:：)）") or (after == "digit" and not between and kind == ".")
        # the narrowest kind of place that the sample shows often enough decides
        known = next((x for x, least in zip(types(key), (4, 6, 25, 40)) if seen[x] >= least), None)
        never = known is not None and final[known] < 0.02 * seen[known]
        if small or never:
            keys.append(key)
            labels.append(0)
    return keys, labels


def fit(texts: list[str], rounds: int = 150, decay: float = 1e-5) -> dict[str, float]:
    """Weights of the maximum-entropy model, by full gradient steps (Adam) on the reliable examples of ``texts``."""
    keys, labels = _reliable(texts)
    merged: Counter = Counter(zip(keys, labels))
    index: dict[str, int] = {}
    rows, cols = [], []
    y, n = np.array([lab for _, lab in merged], float), np.array([*merged.values()], float)
    for i, (key, _) in enumerate(merged):
        for f in features(key):
            rows.append(i)
            cols.append(index.setdefault(f, len(index)))
    rows_, cols_ = np.array(rows, int), np.array(cols, int)
    n = np.minimum(n, 50)
    for lab in (0, 1):  # both labels weigh the same
        n[y == lab] /= max(1.0, n[y == lab].sum())
    w, m, v = np.zeros(len(index)), np.zeros(len(index)), np.zeros(len(index))
    for step in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.bincount(rows_, w[cols_], len(y))))
        g = np.bincount(cols_, (n * (p - y))[rows_], len(index)) + decay * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.3 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return {f: float(w[i]) for f, i in index.items() if abs(w[i]) > 1e-3}


class Splitter:
    """Sentence ends of texts under a fitted model. Decisions are kept by their key, as keys repeat."""

    def __init__(self, weights: dict[str, float], keep: int = 300_000):
        self.w, self.memo, self.keep = weights, {}, keep

    def boundary(self, key: tuple) -> bool:
        got = self.memo.get(key)
        if got is None:
            if len(self.memo) > self.keep:
                self.memo.clear()
            got = self.memo[key] = sum(self.w.get(f, 0.0) for f in features(key)) > 0
        return got

    def spans(self, text: str) -> list[tuple[int, int]]:
        """``(start, end)`` of each sentence, in code points of the stored text."""
        t, at = _clean(text)
        out, last = [], 0
        for end, after, key, sure in candidates(t):
            if end <= last:
                continue
            if not (sure or self.boundary(key)):
                continue
            begin = _LEAD.match(t, last, end).end()
            if begin < end and _WORD.search(t, begin, end):
                out.append((begin, end))
            last = max(after, end) if key[0] in ("space", "close") else end
        return out if at is None else [(at[a], at[b - 1] + 1) for a, b in out]


def sample_texts(df: DataFrame, text: str, fit_rows: int, fit_chars: int = 20_000_000) -> list[str]:
    """A sample of distinct texts for the fit, those of the smallest digests, which no order or layout changes.

    Texts over 2,000 code points stand for each of their paragraphs, and paragraphs over that for their last 200: the end
    is what is reliable, and a text of very many sentences would outweigh it. At most ``fit_rows`` texts or paragraphs with
    ``fit_chars`` code points in all are taken, of texts of any length. A share of the digests is cut off first, so that about
    three times the sample leaves the executors at any size.
    """
    own = df.select(F.col(text).alias("t"))
    texts = own.select(F.explode(F.when(F.length("t") <= 2000, F.array("t")).otherwise(F.split("t", "\n\\s*"))).alias("t")).filter("length(t) > 0")
    texts = texts.withColumn("t", F.when(F.length("t") <= 2000, F.col("t")).otherwise(F.substring("t", -200, 200)))
    size = texts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("t")), F.lit(0)).alias("chars")).first()
    share = min(1.0, 3 * fit_rows / max(1, size.n), 3 * fit_chars / max(1, size.chars))
    kept = texts.withColumn("h", F.xxhash64("t")).filter(F.col("h") <= int((share - 0.5) * 2**64) if share < 1 else F.lit(True))
    out, chars = [], 0
    for r in kept.distinct().orderBy("h", "t").limit(fit_rows).collect():
        chars += len(r.t)
        if chars > fit_chars and out:
            break
        out.append(r.t)
    return out


def sentence_ends(df: DataFrame, keys: list[str], text: str, fit_rows: int = 20_000) -> DataFrame:
    """One row ``keys, end_pos`` for each sentence of each row of ``df``, repeated rows included.

    Positions count code points up to the sentence's last one. Null, empty and speechless texts give no row; a text of
    any length is read whole. Other columns are ignored. The model is fitted on at most ``fit_rows`` texts or paragraphs of
    ``df``, by jobs that run when this is called.
    """
    weights = fit(sample_texts(df, text, fit_rows))
    source = df.select(*keys, F.col(text).alias("_text")).filter("_text IS NOT NULL")
    fields = source.select(*keys).schema
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["end_pos int"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Splitter(weights)
        for b in batches:
            index, ends = [], []
            for i, t in enumerate(b.column(len(keys)).to_pylist()):
                for _, e in own.spans(t):
                    index.append(i)
                    ends.append(e)
            take = pa.array(index, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(i).take(take) for i in range(len(keys))] + [pa.array(ends, pa.int32())], names=[*keys, "end_pos"])

    return source.mapInArrow(split, ddl)
