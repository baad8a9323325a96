"""Column functions on text: normal forms for comparison, counts, similarities. Built-in expressions where they exist."""

from __future__ import annotations

import textwrap
import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What doesn't count when transcripts are compared (white space, the ideographic space, punctuation,
# brackets, the middle dot, colons, the hyphen and the long-vowel mark), and pairs of spellings taken as one.
COMPARE_DROPS = "\\s\u3000、。！？?!…,.，「」『』（）()【】\\[\\]・:：\\-ー"
SPELLINGS = (("本当に", "ほんとに"), ("本当", "ほんと"))
KATAKANA = "".join(chr(c) for c in range(0x30A1, 0x30F7))
HIRAGANA = "".join(chr(c - 0x60) for c in range(0x30A1, 0x30F7))


def squeeze(text) -> Column:
    """Text without what doesn't count in comparison; null gives ''."""
    return F.regexp_replace(F.coalesce(_col(text), F.lit("")), f"[{COMPARE_DROPS}]+", "")


@F.pandas_udf(T.StringType())
def nfkc(text: pd.Series) -> pd.Series:
    """Compatibility form; the JVM functions have none."""
    return text.map(lambda t: None if t is None else t if t.isascii() else unicodedata.normalize("NFKC", t))


def fold_kana(text) -> Column:
    """Katakana as hiragana, after the compatibility form."""
    return F.translate(nfkc(_col(text)), KATAKANA, HIRAGANA)


def loose(text) -> Column:
    """The loose form for comparison: squeezed, kana folded, spellings made one. Applying it again changes nothing."""
    out = fold_kana(squeeze(text))
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def bigrams(form: Column) -> Column:
    """The distinct pairs of neighbouring characters of a text, empty below two characters."""
    pairs = F.transform(F.sequence(F.lit(1), F.length(form) - 1), lambda i: F.substr(form, i, F.lit(2)))
    return F.when(F.length(form) < 2, F.array().cast("array<string>")).otherwise(F.array_distinct(pairs))


def bigram_jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct bigrams of two forms; 0 if either has none. Nulls count as ''."""
    x, y = bigrams(F.coalesce(a, F.lit(""))), bigrams(F.coalesce(b, F.lit("")))
    both = F.size(F.array_intersect(x, y))
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(both / F.size(F.array_union(x, y)))


@F.pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """The matching-blocks ratio of the standard library, on forms; its order of arguments matters."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)], dtype="float64")


def contains_either(a: Column, b: Column) -> Column:
    """Whether one non-empty form holds the other."""
    return (F.length(a) > 0) & (F.length(b) > 0) & (F.contains(a, b) | F.contains(b, a))


def char_counts(text) -> dict[str, Column]:
    """The four ways to count a cue's characters: without spaces, breaks and tabs; without spaces and breaks; without any white space; all, with breaks as spaces and stripped."""
    t = F.coalesce(_col(text), F.lit(""))
    return {
        "chars_plain": F.length(F.translate(t, " \n\t", "")),
        "chars_lines": F.length(F.translate(t, " \n", "")),
        "chars_compact": F.length(F.regexp_replace(t, "[\\s\u3000\u00a0\u2000-\u200a\u202f\u205f]+", "")),
        "chars_spaced": F.length(F.regexp_replace(F.replace(t, F.lit("\n"), F.lit(" ")), "^[\\s\u3000\u00a0\u2000-\u200a\u202f\u205f]+|[\\s\u3000\u00a0\u2000-\u200a\u202f\u205f]+$", "")),
    }


def tidy_lines(text) -> Column:
    """Lines without outer and double white space, empty lines dropped."""
    lines = F.split(F.replace(_col(text), F.lit("\r"), F.lit("\n")), "\n")
    return F.array_join(F.filter(F.transform(lines, lambda x: F.trim(F.regexp_replace(x, "[\\s\u3000\u00a0]+", " "))), lambda x: F.length(x) > 0), "\n")


def wrap_lines(width: int, most: int = 2):
    """A function that wraps English text to ``most`` lines of ``width``; what is over goes into the second line."""

    def one(t):
        if t is None:
            return None
        lines = [x for x in (" ".join(p.split()) for p in t.replace("\r", "\n").split("\n")) if x]
        if not lines or (len(lines) <= most and all(len(x) <= width for x in lines)):
            return "\n".join(lines)
        out = textwrap.wrap(" ".join(lines), width, break_long_words=False, break_on_hyphens=False)
        return "\n".join(out if len(out) <= most else [out[0], " ".join(out[1:])])

    return F.pandas_udf(lambda s: s.map(one), T.StringType())


def _col(text) -> Column:
    return F.col(text) if isinstance(text, str) else text
