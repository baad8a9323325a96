"""Small rules as column expressions: loops in generated text, costs, delays, names of kinds."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of kinds of on-screen items, and the kinds and ranks that are known.
KIND_ALIASES = {"title": "title_card", "titlecard": "title_card", "name": "name_card", "namecard": "name_card", "rule": "info_card", "rulecard": "info_card", "rule_text": "info_card", "infocard": "info_card"}
RANKS = ("high", "medium", "low")


def kind_of(value: Column, known: Sequence[str]) -> Column:
    """A kind in its one spelling, ``other`` for an unknown or missing one."""
    t = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    named = F.coalesce(F.create_map(*[F.lit(x) for kv in KIND_ALIASES.items() for x in kv])[t], t)
    return F.when(named.isin(*known), named).otherwise("other")


def rank_of(value: Column) -> Column:
    """An importance, ``medium`` for an unknown or missing one."""
    t = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return F.when(t.isin(*RANKS), t).otherwise("medium")


def token_cost(tokens: Column, model: Column, prices: Mapping[str, float]) -> Column:
    """Tokens times the price a million of the first entry whose key the model's name holds; null if none does or tokens are."""
    price = F.lit(None).cast("double")
    for key, value in reversed(list(prices.items())):
        price = F.when(F.contains(model, F.lit(key)), F.lit(float(value))).otherwise(price)
    return tokens / 1_000_000 * price


def backoff_seconds(attempt: Column, cap: float = 30.0, half: float = 2.0) -> Column:
    """A delay that rises towards ``cap`` and has half of it at attempt ``half``."""
    return F.lit(cap) * attempt / (attempt + F.lit(half))


def retry_seconds(message: Column) -> Column:
    """The longest delay that an error message asks for; null if it asks for none."""
    asked = F.concat(F.regexp_extract_all(message, F.lit(r"Please retry in ([0-9]+(?:\.[0-9]+)?)s"), 1), F.regexp_extract_all(message, F.lit(r"'retryDelay': '([0-9]+)s'"), 1))
    return F.array_max(F.transform(asked, lambda x: x.cast("double")))


def loop_issue(text: Column, most_line: int = 400) -> Column:
    """Why generated text looks like a loop, null if it doesn't.

    Over 4000 characters; over 300 lines; a line over ``most_line``; one clause of at most 24 characters eight times in a row.
    """
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.transform(F.split(t, "\n"), lambda x: F.trim(x)), lambda x: F.length(x) > 0)
    body = lambda x: F.regexp_replace(F.regexp_replace(x, "^-- ", ""), "^\\[画面: (.*)\\]$", "$1")
    clauses = lambda x: F.filter(F.split(body(x), "[、,。！？!?\\s]+"), lambda c: F.length(c) > 0)
    # a run of eight: the clause equals each of the seven behind it
    eight = lambda c: F.exists(F.sequence(F.lit(1), F.size(c) - 7), lambda i: (F.length(F.element_at(c, i)) <= 24) & (F.size(F.array_distinct(F.slice(c, i, F.lit(8)))) == 1))
    loops = F.exists(lines, lambda x: F.when(F.size(clauses(x)) >= 8, eight(clauses(x))).otherwise(F.lit(False)))
    return (
        F.when(F.length(t) > 4000, "too_long").when(F.size(lines) > 300, "too_many_lines").when(F.exists(lines, lambda x: F.length(x) > most_line), "line_too_long").when(loops, "repeated_clause")
    )


def top_gram_count(text: Column, n: int = 4) -> Column:
    """How often a text's most frequent run of ``n`` characters occurs; 0 if it is shorter."""
    t = F.trim(F.coalesce(text, F.lit("")))
    grams = F.array_sort(F.transform(F.sequence(F.lit(1), F.length(t) - n + 1), lambda i: F.substr(t, i, F.lit(n))))
    # sorted, so equal ones stand together: the longest step back that finds the same
    longest = F.aggregate(grams, F.struct(F.lit("").alias("g"), F.lit(0).alias("c"), F.lit(0).alias("best")), lambda a, g: F.struct(g.alias("g"), F.when(a["g"] == g, a["c"] + 1).otherwise(1).alias("c"), F.greatest(a["best"], F.when(a["g"] == g, a["c"] + 1).otherwise(1)).alias("best")), lambda a: a["best"])
    return F.when(F.length(t) < n, 0).otherwise(longest)


def cjk_share(text: Column) -> Column:
    """The share of kana and Han characters of a text's characters; 0 for none."""
    t = F.trim(F.coalesce(text, F.lit("")))
    return F.when(F.length(t) == 0, 0.0).otherwise(F.length(F.regexp_replace(t, "[^\\u3040-\\u30ff\\u3400-\\u9fff]", "")) / F.length(t))


def slug(text: Column) -> Column:
    """Lower-case letters and digits with single hyphens between."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+", "-"), "^-+|-+$", "")


def vocab_share(text: Column, vocab: str) -> Column:
    """The share of a text's characters that the vocabulary holds; 0 for an empty text."""
    t = F.coalesce(text, F.lit(""))
    inside = F.length(t) - F.length(F.translate(t, vocab, ""))
    return F.when(F.length(t) == 0, 0.0).otherwise(inside / F.length(t))
