"""One form for texts that look the same: look-alike classes by union-find, rewritten by a multi-pattern automaton.

Classes join strings and code points. Their sources are rules over Unicode's decompositions (width variants, radicals,
ligatures, hyphens, kinds of spaces) and a short fixed list of letters that different scripts share. The members of a
class are linked transitively; the member that the corpus uses most represents it; the automaton replaces every other
member, longest match first. Case, accents, voicing marks, line breaks and the number of spaces stay as they are.
"""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import hot_join
from ..session import cut

# Letters of different scripts with one shape, a class a word.
SHARED_SHAPES = """
aа cсϲ eе hһ iіι jјϳ oоοօ pрρ qԛ sѕ uυ vνѵ wԝ xх yуγ kκк dԁ lӏ nո
AАΑ BВΒ CСϹ EЕΕ GԌ HНΗ IІΙӀ JЈͿ KКΚ MМΜ NΝ OОΟ PРΡ QԚ SЅ TТΤ UՍ VѴ WԜ XХΧ YҮΥ ZΖ
ー一 卜ト 夕タ 八ハ 力カ 二ニ 口ロ 工エ 才オ 丿ノ りリ へヘ
"""
#: Code points that show nothing, beside those of category Cf and Cc.
BLANKS = "\u034f\u115f\u1160\u17b4\u17b5\u3164\uffa0\u180b\u180c\u180d\u180f"
SHOWN_FORMATS = {*range(0x600, 0x606), 0x6DD, 0x70F, 0x890, 0x891, 0x8E2, 0x110BD, 0x110CD}


@lru_cache(1)
def _invisible() -> regex.Pattern:
    spans = [chr(c) for c in range(0x20000) if unicodedata.category(chr(c)) in ("Cf", "Cc") and c not in SHOWN_FORMATS and chr(c) not in "\t\n\r\v\f"]
    return regex.compile("[" + regex.escape("".join(spans) + BLANKS, special_only=False) + "\ufe00-\ufe0f\U000e0000-\U000e0fff]+")


@lru_cache(1)
def seeds() -> list[tuple[str, str]]:
    """Pairs of canonically decomposed strings that look the same."""
    pairs = [(w[0], other) for w in SHARED_SHAPES.split() for other in w[1:]]
    pairs += [("\r\n", "\n"), ("\r", "\n"), ("‐", "-"), ("゛", "゙"), ("゜", "\u309a")]
    for c in range(sys.maxunicode + 1):
        form, ch = unicodedata.decomposition(chr(c)), chr(c)
        if not form.startswith("<"):
            continue
        kind, plain = form.split("> ", 1)
        plain = "".join(chr(int(x, 16)) for x in plain.split())
        letters = all(unicodedata.category(x)[0] == "L" for x in plain)
        if (
            kind in ("<wide", "<narrow", "<noBreak")
            or kind == "<compat" and plain == " "
            or kind == "<compat" and letters and (unicodedata.category(ch) == "So" or "LIGATURE" in unicodedata.name(ch, ""))
        ):
            pairs.append((ch, unicodedata.normalize("NFD", plain)))
    return pairs


class Classes:
    """Transitive classes over strings, from pairs and the corpus's counts of their members."""

    def __init__(self, pairs: Iterable[tuple[str, str]], counts: dict[str, int]):
        self.parent: dict[str, str] = {}
        for a, b in pairs:
            self.parent[self._root(a)] = self._root(b)
        members: dict[str, list[str]] = {}
        for x in self.parent:
            members.setdefault(self._root(x), []).append(x)
        self.rewrite: dict[str, str] = {}
        for own in members.values():
            # letters in a row speak for their ligature, as their own look-alikes come in many ways; ties: the plainest
            rows = [x for x in own if len(x) > 1 and x.isalpha()]
            best = max(rows or own, key=lambda x: (counts.get(x, 0), [-ord(c) for c in x]))
            self.rewrite |= {x: best for x in own if x != best}
        single = {x: to for x, to in self.rewrite.items() if len(x) == len(to) == 1}
        self.rewrite = {x: "".join(single.get(c, c) for c in to) for x, to in self.rewrite.items()}

    def _root(self, x: str) -> str:
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x


class Rewriter:
    """Brings a text to the form of its class representatives."""

    def __init__(self, rewrite: dict[str, str]):
        import ahocorasick

        self.auto = ahocorasick.Automaton()
        for x, to in rewrite.items():
            self.auto.add_word(x, (len(x), to))
        self.auto.make_automaton()
        self.invisible = _invisible()
        self.ascii_stays = not any(x.isascii() and x.isprintable() for x in rewrite)

    def __call__(self, text: str) -> str:
        if text.isascii() and text.isprintable() and self.ascii_stays:
            return text.strip(" ")
        text = unicodedata.normalize("NFD", self.invisible.sub("", text))
        out, at = [], 0
        for end, (n, to) in self.auto.iter_long(text):
            out += (text[at : end + 1 - n], to)
            at = end + 1
        if out:
            text = unicodedata.normalize("NFD", "".join(out) + text[at:])
        return text.strip(" ")


def member_counts(df: DataFrame, text: str) -> dict[str, int]:
    """How often the members of any seed pair occur in ``text``. At most one count per member comes to the driver."""
    strings = sorted({x for pair in seeds() for x in pair if len(x) > 1})
    singles = {x for pair in seeds() for x in pair if len(x) == 1}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            joined = "\0".join(x for x in b.column(0).to_pylist() if x)
            own = Counter(joined)
            total.update({k: n for k, n in own.items() if k in singles})
            total.update({s: n for s in strings if s[0] in own and (n := joined.count(s))})
        yield pa.RecordBatch.from_pydict({"member": [*total], "n": [*total.values()]}, pa.schema([("member", pa.string()), ("n", pa.int64())]))

    rows = df.select(text).mapInArrow(count, "member string, n long").groupBy("member").agg(F.sum("n").alias("n")).collect()
    return {r.member: r.n for r in rows}


def fit(df: DataFrame, text: str) -> dict[str, str]:
    """The rewriting table of the look-alike classes for the texts of ``df``."""
    return Classes(seeds(), member_counts(df, text)).rewrite


def rewrite(df: DataFrame, text: str, into: str, table: dict[str, str] | None = None) -> DataFrame:
    """``df`` with the column ``into``: ``text`` in its consistent form. Null stays null; blank text becomes ''.

    A column ``into`` of ``df`` is replaced. ``table`` is that of :func:`fit`, made here from ``df`` if not given.
    """
    table = fit(df, text) if table is None else table

    @F.pandas_udf("string")
    def form(s):
        do = _rewriter(table)
        return s.map(lambda x: None if x is None else do(x))

    return df.withColumn(into, form(F.col(text)))


_REWRITERS: dict[int, tuple[dict, Rewriter]] = {}


def _rewriter(table: dict[str, str]) -> Rewriter:
    own = _REWRITERS.get(id(table))
    if own is None or own[0] is not table:
        _REWRITERS.clear()
        own = _REWRITERS[id(table)] = (table, Rewriter(table))
    return own[1]


def _forms(df: DataFrame, groups: Sequence[str], row_id: str, text: str) -> DataFrame:
    """``_g0.., id, look, raw``: digests of every text's consistent form and of the text itself, materialised."""
    gs = [f"_g{i}" for i in range(len(groups))]
    source = df.select(*[F.col(g).cast("string").alias(n) for g, n in zip(groups, gs)], F.col(row_id).cast("long").alias("id"), F.col(text).alias("t")).dropna()
    table = fit(source, "t")
    schema = pa.schema([(n, pa.string()) for n in gs] + [("id", pa.int64()), ("look", pa.int64()), ("raw", pa.int64())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        do, wrap = Rewriter(table), 1 << 63
        for b in batches:
            look, raw = [], []
            for t in b.column(len(gs) + 1).to_pylist():
                r = xxhash.xxh3_64_intdigest(t.encode()) - wrap
                form = do(t)
                raw.append(r)
                look.append(r if form == t else xxhash.xxh3_64_intdigest(form.encode()) - wrap)
            cols = [b.column(i).cast(pa.string()) for i in range(len(gs))]
            yield pa.RecordBatch.from_arrays([*cols, b.column(len(gs)).cast(pa.int64()), pa.array(look, pa.int64()), pa.array(raw, pa.int64())], schema=schema)

    return cut(source.mapInArrow(digest, ", ".join([f"{n} string" for n in gs] + ["id long", "look long", "raw long"])))


def _mixed(forms: DataFrame, of: list[str]) -> DataFrame:
    """``of, raw, n``: the spellings of classes that have several, with their rows' number."""
    counts = forms.groupBy(*of, "raw").agg(F.count(F.lit(1)).alias("n"))
    several = counts.groupBy(*of).agg(F.min("raw").alias("lo"), F.max("raw").alias("hi")).filter("lo < hi").select(*of)
    return cut(counts.join(several, of))


def classes(df: DataFrame, groups: Sequence[str], row_id: str, text: str) -> DataFrame:
    """``groups, id, class_id, links``: each row's class of texts that look the same, and how many other texts' rows it links to.

    Only classes with texts of different code points, null-safe as :func:`pairs`; a row with several texts has a row for
    each class, and links to a row once for each pair of texts. This says all that the pairs say, in one row a row.
    """
    gs = [f"_g{i}" for i in range(len(groups))]
    of = [*gs, "look"]
    forms = _forms(df, groups, row_id, text)
    mixed = _mixed(forms, of)
    linked = mixed.join(mixed.groupBy(*of).agg(F.sum("n").alias("all")), of).select(*of, "raw", (F.col("all") - F.col("n")).alias("links"))
    found = hot_join(forms, linked, [*of, "raw"], ["id"]).groupBy(*gs, "id", "look").agg(F.sum("links").alias("links"))
    return found.select(*[F.col(n).alias(g) for g, n in zip(groups, gs)], "id", F.col("look").alias("class_id"), "links")


def pairs(df: DataFrame, groups: Sequence[str], row_id: str, text: str, block: int = 2000) -> DataFrame:
    """Pairs of rows of one group whose texts differ in code points but look the same.

    Returns ``groups, id_1, id_2`` with ``id_1 < id_2``, each pair once, also if a row occurs with several texts. Null
    texts, null ids and null group values pair with nothing; texts equal in all code points are no pair; blank texts
    look like the empty one. Other columns are ignored. Building the result runs jobs and materialises the digests.

    Only digests move. Classes with one spelling fall out by an aggregation with map-side combine; in the rest, rows
    meet per ordered pair of spellings, and the rows of a frequent spelling are dealt to several tasks in every join.
    """
    gs = [f"_g{i}" for i in range(len(groups))]
    of = [*gs, "look"]
    forms = _forms(df, groups, row_id, text)
    mixed = _mixed(forms, of).withColumn("parts", F.ceil(F.col("n") / block).cast("int")).drop("n")
    rows = cut(hot_join(forms, mixed, [*of, "raw"], ["id"]))
    a = mixed.select(*of, F.col("raw").alias("raw_a"))
    b = mixed.select(*of, F.col("raw").alias("raw_b"), F.col("parts").alias("parts_b"))
    meet = a.join(b, of).filter("raw_a < raw_b")
    left = hot_join(rows.select(*of, F.col("raw").alias("raw_a"), F.col("id").alias("a")), meet, [*of, "raw_a"], ["a"])
    left = left.select(*of, "raw_b", "a", F.explode(F.sequence(F.lit(0), F.col("parts_b") - 1)).alias("part"))
    right = rows.select(*of, F.col("raw").alias("raw_b"), F.col("id").alias("b"), F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"))
    found = left.join(right, [*of, "raw_b", "part"]).filter("a <> b")
    return found.select(*[F.col(n).alias(g) for g, n in zip(groups, gs)], F.least("a", "b").alias("id_1"), F.greatest("a", "b").alias("id_2")).distinct()
