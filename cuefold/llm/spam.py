"""Keyword-stuffed, link-list and tag pages: bagged decision trees on content and link features, smoothed by host.

The trees learn from weak labels (:func:`weak_labels`): rules that each know one kind of page and otherwise abstain. What
those rules read is kept from the trees, which judge every page from its other features. A page's odds are moved by those
of its host, leaving the page itself out.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import hot_join
from ..session import cut
from .sentences import _clean

_LINK = re.compile(r"<a\s[^>]*>.*?</a>|\[[^\[\]\n]*\]\(\s*(?:https?:)?//[^)\s]*\)|(?:https?://|www\.)\S+", re.I | re.S)
_PRODUCT = re.compile(r"\b[A-Z]{1,3}-?\d{3,6}\b.*?\d+ ?(?:円|元|₩|€|\$|JPY|USD|EUR|% ?OFF)|\d+% ?OFF", re.I)
_TOKEN = re.compile(r"[ァ-ヺー]+|[㐀-鿿々]+|[가-힣]+|[\u0900-ॿ]+|[฀-๿]+|[ぁ-ゟ]+|\d+|[^\W\d_ぁ-ヿ㐀-鿿가-힣\u0900-ॿ฀-๿]+")
_ENDS = re.compile(r"(?<=[。！？!?।|])|(?<=\.)\s")
_STOPS = re.compile(r"(?<=[。！？!?।])|(?<=\.)\s")
#: What a line of one keyword doesn't hold.
_LISTED = re.compile("[\1#＃|/:：]")
_KANA = re.compile(r"[ぁ-ゟ]")
_BARS = re.compile(r"\s*\|\s*|\s/\s")
_ENDED = re.compile(r"[.!?。！？।](?:\s|$)")
#: What a price or discount looks like: without one on a page, no line is a product's.
_PRICED = re.compile(r"\d ?(?:円|元|₩|€|\$|JPY|USD|EUR|% ?OFF)", re.I)
#: What the weak rules read, which the trees don't see: the share of all of them, each one's own, and that of sentences.
WEAK = ("share", "linked", "products", "tag_lines", "salads", "stuffed", "sentences")
#: What the trees see.
SEEN = ("links", "link_text", "hashes", "top1", "top3", "kinds", "repeats", "same", "packed", "slashes", "finals", "log_length", "bare_lines", "longest", "word_length", "numbers", "prices")
NAMES = WEAK + SEEN


def _salad(words: list[str], letters: int = 9) -> bool:
    """Whether a passage without a sentence's end says few, short words again and again, more than prose of its length does.

    Short are words of ``letters`` letters on average.
    """
    own = [w for w in words if not "ぁ" <= w[0] <= "ゟ" and not w.isdigit()]
    n = len(own)
    if n < 12:
        return False
    count = Counter(own)
    if len(count) < 5 or sum(map(len, count)) > letters * len(count):  # a refrain; phrases of a script without spaces
        return False
    counted = 4 * sum(map(str.isdigit, words)) >= n  # entries with a number each, as in clouds of tags
    least = 0.5 if counted else min(0.85, max(0.5, 0.5 + 0.1 * math.log2(n / 20)))
    if sum(c for c in count.values() if c > 1) < least * n:
        return False
    seen = set(own[: n // 2])
    return sum(w in seen for w in own[n // 2 :]) >= 0.4 * (n - n // 2)


def _listed(lines: list[str]) -> dict[int, int]:
    """The lines of keyword salads of one keyword a line, each with the number of its salad's lines."""
    out, run = {}, []
    for i, line in enumerate([*lines, "\1"]):
        p = line.strip()
        if p and len(p) <= 20 and p[-1] not in ".!?。！？।" and not _LISTED.search(p):
            run.append((i, p.lower()))
        elif p:
            if len(run) >= 12 and _salad([x for _, x in run], 12):
                out |= {k: len(run) for k, _ in run}
            run = []
    return out


def page_features(text: str | None) -> list[float]:
    """The features ``NAMES`` of a page; zeros where there is no text."""
    if not text or not text.strip():
        return [0.0] * len(NAMES)
    t = _clean(text)[0]
    n = len(t) - sum(map(t.count, " \n\t\r\u3000"))
    plain, link_sizes = t, []
    if "://" in t or "www." in t or "<a" in t:
        link_sizes = [m.end() - m.start() for m in _LINK.finditer(t)]
        plain = _LINK.sub("\1", t)
    whole = n
    # per passage: its words and their size; words over all passages are counted once
    passages: list[tuple[int, list[str], bool]] = []
    linked = products = tag_lines = salads = sentences = longest = 0
    said: list[str] = []  # the words of salads
    at = iter(link_sizes)
    marked, priced = "#" in plain or "＃" in plain, len(_PRICED.findall(plain))
    all_lines = plain.split("\n")
    listed = _listed(all_lines)
    for i, line in enumerate(all_lines):
        if i in listed:
            salads += _size(line)
            said += _TOKEN.findall(line.lower())
            longest = max(longest, listed[i])
            continue
        if "\1" in line:
            here = [next(at) for _ in range(line.count("\1"))]
            if all(len(x) <= 60 and not _ENDED.search(x) for x in line.split("\1")):  # a few words around links: a list
                linked += sum(here) + _size(line) - len(here)
                continue
            n -= sum(here)  # a link behind a sentence is no text of its own
            line = line.replace("\1", " ")
        own = _STOPS.split(line)
        if len(line) >= 40 and not (marked and ("#" in line or "＃" in line)):
            rest = []
            for p in own:
                if len(p) >= 40 and p[-1] not in ".!?。！？।" and _salad(ws := _TOKEN.findall(p.lower())):
                    salads += _size(p)
                    said += ws
                    longest = max(longest, len(ws))
                else:
                    rest.append(p)
            if len(rest) < len(own):
                own, line = rest, " ".join(rest)
        if line.count("|") + line.count(" / ") > 2:
            own = _BARS.split(line)
        elif "|" in line:
            own = _ENDS.split(line)
        for p in own:
            size = _size(p)
            if not size:
                continue
            if priced and _PRODUCT.search(p):
                products += size
            elif marked and (k := p.count("#") + p.count("＃")):
                if k > 2:
                    tag_lines += size
                else:
                    passages.append((size, _TOKEN.findall(p.lower()), False))
            else:
                passages.append((size, _TOKEN.findall(p.lower()), p[-1] not in ".!?。！？।”\"」』)）"))
    n = max(n, 1)
    kana = _KANA.search(plain) is not None
    words = [w for ws in (said, *(ws for _, ws, _ in passages)) for w in ws if not (kana and "ぁ" <= w[0] <= "ゟ")]
    count, total = Counter(words), len(words) or 1
    ranked = count.most_common(6)
    keys = [w for w, c in ranked if c >= 4 and c >= 0.12 * total and len(w) <= 12]
    held: list[tuple[int, set[str]]] = []
    lists, often, before = 0, max(3, 0.02 * total), None
    for size, ws, bare in passages:
        own = [w for w in ws if not "ぁ" <= w[0] <= "ゟ"] if kana else ws
        again, before = ws == before and not bare, ws
        if not own or again:  # a passage said again at once is a refrain
            continue
        hit, met = 0, set()
        for w in own if keys else ():
            for k in keys:
                if w == k or (len(k) > 1 and k in w):
                    hit += len(k)
                    met.add(k)
                    break
        alone = len(set(own)) == 1
        if met and hit >= 0.4 * sum(map(len, own)) and not (alone and len(own) > 2):
            held.append((size, met))
        elif bare and len(own) <= 6 and all(count[w] >= often for w in own):
            long = [len(w) for w in own if not w.isdigit()]
            if sum(long) <= 8.5 * len(long):
                lists += size  # short entries of nothing but often repeated, short words
    size = sum(x for x, _ in held)
    # passages are stuffed if they share a word, not if each repeats its own
    stuffed = lists + (size if held and max(sum(x for x, ks in held if k in ks) for k in keys) >= 0.6 * size else 0)
    sentences = sum(x for x, _, bare in passages if not bare)
    longest = max(longest, max((len(ws) for _, ws, bare in passages if bare), default=0))
    share = min(1.0, (linked + products + salads + stuffed + tag_lines) / n)
    lines = 1 + plain.count("\n")
    finals = sum(map(plain.count, ".!?。！？।"))
    raw = plain.encode()
    return [
        share, linked / n, products / n, tag_lines / n, salads / n, stuffed / n, sentences / n,
        len(link_sizes) / (1 + lines), sum(link_sizes) / whole, (plain.count("#") + plain.count("＃")) / n,
        ranked[0][1] / total if ranked else 0.0, sum(c for _, c in ranked[:3]) / total, len(count) / total, sum(c for c in count.values() if c > 1) / total,
        sum(map(str.__eq__, words, words[1:])) / total, len(zlib.compress(raw, 1)) / max(1, len(raw)), sum(map(plain.count, "/|,、")) / n,
        finals / total, float(np.log1p(n)), sum(b for _, _, b in passages) / (len(passages) or 1), float(np.log1p(longest)), sum(map(len, count)) / (len(count) or 1),
        (len(raw) - len(raw.translate(None, b"0123456789"))) / n, priced / lines,
    ]


def _size(p: str) -> int:
    return len(p) - p.count(" ") - p.count("\t") - p.count("\r") - p.count("\u3000")


def weak_labels(f: np.ndarray) -> np.ndarray:
    """1 for spam, 0 for none, -1 where no rule speaks or two contradict, of pages' features ``NAMES``.

    Five rules know spam, each by what half of the text is: links, products, tags, salads, stuffed passages. Four know
    none: sentences that no word leads; and, where links, hashes and prices are rare, text that packs badly, whole
    phrases of a script without spaces, and lists of short entries that no word leads.
    """
    c = dict(zip(NAMES, f.T))
    spam = np.any([c[k] >= 0.5 for k in ("linked", "products", "tag_lines", "salads", "stuffed")], axis=0)
    plain = (c["links"] < 0.1) & (c["hashes"] < 0.04) & (c["prices"] < 0.1)
    read = (c["sentences"] >= 0.6) & ((c["top1"] <= 0.11) | (c["repeats"] < 0.3))
    read |= plain & ((c["packed"] >= 0.45) & (c["longest"] < np.log1p(12)) | (c["word_length"] >= 9))
    read |= plain & (c["bare_lines"] >= 0.5) & (c["longest"] < np.log1p(12)) & (c["top1"] <= 0.25) & (c["kinds"] >= 0.1)
    return np.where(c["log_length"] == 0, -1, np.where(spam & ~read, 1, np.where(read & ~spam, 0, -1)))


class Trees:
    """Bagged decision trees for two classes, on quantile bins; each split chooses among half of the features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, count: int = 25, depth: int = 8, least: int = 3, bins: int = 48, seed: int = 7):
        self.rng = rng = np.random.default_rng(seed)
        self.edges = [np.unique(np.quantile(np.unique(x[:, j]), np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)])
        self.trees = []
        for _ in range(count):
            rows = self._draw(rng, y)
            self.trees.append(self._grow(binned[rows], y[rows], depth, least, bins))

    @staticmethod
    def _draw(rng: np.random.Generator, y: np.ndarray) -> np.ndarray:
        """Rows drawn with replacement; the rarer class makes up a quarter at least."""
        own = [np.flatnonzero(y == k) for k in (0, 1)]
        share = min(max(float(y.mean()), 0.25), 0.75)
        n = round(share * len(y))
        return np.concatenate([rng.choice(own[0], len(y) - n), rng.choice(own[1], n)])

    def _grow(self, b, y, depth, least, bins):
        p = float(y.mean())
        if depth == 0 or len(y) < 2 * least or p in (0.0, 1.0):
            return p
        best = (0.0, None, None)
        whole = p * (1 - p) * len(y)
        for j in self.rng.permutation(b.shape[1])[: -(-b.shape[1] // 2)]:
            n = np.bincount(b[:, j], minlength=bins)
            s = np.bincount(b[:, j], y, minlength=bins)
            nl, sl = np.cumsum(n)[:-1], np.cumsum(s)[:-1]
            nr, sr = len(y) - nl, y.sum() - sl
            ok = (nl >= least) & (nr >= least)
            if not ok.any():
                continue
            gain = np.where(ok, whole - sl * (1 - sl / np.maximum(nl, 1)) - sr * (1 - sr / np.maximum(nr, 1)), 0)
            k = int(gain.argmax())
            if gain[k] > best[0] + 1e-12:
                best = (float(gain[k]), int(j), k)
        if best[1] is None:
            return p
        _, j, k = best
        left = b[:, j] <= k
        return j, k, self._grow(b[left], y[left], depth - 1, least, bins), self._grow(b[~left], y[~left], depth - 1, least, bins)

    def predict(self, x: np.ndarray) -> np.ndarray:
        binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)]) if len(x) else np.zeros((0, x.shape[1]), int)
        out = np.zeros(len(x))
        for tree in self.trees:
            self._walk(tree, binned, np.arange(len(x)), out)
        return out / len(self.trees)

    def _walk(self, node, b, rows, out):
        if isinstance(node, float):
            out[rows] += node
        elif len(rows):
            j, k, left, right = node
            small = b[rows, j] <= k
            self._walk(left, b, rows[small], out)
            self._walk(right, b, rows[~small], out)


def spam_scores(df: DataFrame, doc_id: str, text: str, url: str, fit_rows: int = 20_000, pull: float = 1.0, prior: float = 20.0) -> DataFrame:
    """``doc_id, share, page_score, host_rate, score`` of every page, repeated pages each for itself.

    ``page_score`` is the trees' vote, ``host_rate`` the mean vote of the host's other pages, drawn to the mean of all
    pages by ``prior`` pages; ``score`` moves the vote's log odds by ``pull`` times the host's over those of all pages: at
    1 the host's rate takes the place of the general one, as by Bayes' rule, and can turn a verdict. Trees are fitted on
    at most ``fit_rows`` pages with a weak label, chosen by digest. Null or empty texts score 0; a null or odd ``url``
    counts as the host ''. An empty table gives an empty result; if one class has no labelled page, the vote is the weak
    share itself. Building the result runs jobs; features and votes are materialised in the checkpoint folder.
    """
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[a-zA-Z]+://(?:www\.|m\.)?([^/?#:]+)", 1)), F.lit(""))
    source = df.select(F.col(doc_id).cast("long").alias("d"), host.alias("host"), F.col(text).alias("t"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = np.array([page_features(t) for t in b.column(2).to_pylist()], np.float32).reshape(-1, len(NAMES))
            seen = pa.array(list(f[:, len(WEAK) :]), pa.list_(pa.float32()))
            label = pa.array(weak_labels(f), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(f[:, 0], pa.float64()), label, seen], names=["d", "host", "share", "label", "f"])

    pages = cut(source.mapInArrow(measure, "d long, host string, share double, label int, f array<float>"))
    clear = pages.filter("label >= 0").withColumn("h", F.xxhash64("d", "f"))
    part = min(1.0, 3 * fit_rows / max(1, clear.count()))
    rows = clear.filter(F.col("h") <= int((part - 0.5) * 2**64) if part < 1 else F.lit(True)).orderBy("h", "d").limit(fit_rows).select("label", "f").collect()
    x = np.array([r.f for r in rows], np.float32).reshape(-1, len(SEEN))
    y = np.array([r.label for r in rows], float)
    trees = Trees(x, y) if 0 < y.sum() < len(y) else None

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            f = np.array(b.column(4).to_pylist(), np.float32).reshape(-1, len(SEEN))
            held = f[:, SEEN.index("log_length")] > 0
            p = np.where(held, trees.predict(f), 0.0) if trees else b.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(p, pa.float64()), pa.array(held)], names=["d", "host", "share", "page_score", "held"])

    voted = cut(pages.mapInArrow(vote, "d long, host string, share double, page_score double, held boolean"))
    hosts = voted.groupBy("host").agg(F.sum("page_score").alias("s"), F.count(F.lit(1)).alias("n"))
    mean = hosts.agg((F.sum("s") / F.sum("n")).alias("m")).first().m or 0.0
    rate = (F.col("s") - F.col("page_score") + prior * mean) / (F.col("n") - 1 + prior)
    squeeze = lambda c: F.least(F.greatest(c, F.lit(0.01)), F.lit(0.99))
    odds = lambda c: F.log(squeeze(c) / (1 - squeeze(c)))
    joined = hot_join(voted, hosts, ["host"], ["d"]).withColumn("host_rate", rate)
    moved = odds(F.col("page_score")) + pull * (odds(F.col("host_rate")) - odds(F.lit(float(mean))))
    return joined.select(F.col("d").alias("doc_id"), "share", "page_score", "host_rate", F.when(F.col("held"), 1 / (1 + F.exp(-moved))).otherwise(0.0).alias("score"))
