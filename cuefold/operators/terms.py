"""Terms seen on screen or in glossaries: which are noise, how often they come, which to keep."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Shapes of terms that carry no name, as patterns over the whole term.
STRUCTURAL = {
    "signs": "[^\\p{L}\\p{N}_]+",
    "digits": "\\p{Nd}+",
    "one_sign": "(.)\\1{2,}",
    "date": "\\d{2,4}年(?:\\d{1,2}月(?:\\d{1,2}日)?)?|\\d{1,2}月\\d{1,2}日|\\d{2,4}[/-]\\d{1,2}(?:[/-]\\d{1,2})?",
    "time": "\\d{1,2}:\\d{2}(?::\\d{2})?|\\d{1,2}時(?:\\d{1,2}分)?",
    "money": "[¥￥]\\s?[\\d,]+|[\\d,]+円",
    "counter": "第\\d+[回話]",
    "short_ascii": "[A-Za-z0-9]{1,2}",
}
PLACES = "(?i)https?://|www\\.|\\.com|\\.jp"


def term_noise(term: Column) -> Column:
    """The name of the first structural rule that a term falls under, null for none; null and one-letter terms are ``too_short``."""
    rules = F.when(term.isNull() | (F.length(term) <= 1), "too_short")
    for name, shape in STRUCTURAL.items():
        rules = rules.when(term.rlike(f"^(?:{shape})$"), name)
    return rules.when(term.rlike(PLACES), "address")


def first_entries(df: DataFrame, keys: Sequence[str], source: str, order: Sequence[str], target: str, context: str, top: int) -> DataFrame:
    """Entries with a source of two letters or more, the first of each spelling whatever its case, at most ``top`` a key.

    A missing target becomes the source; a missing context a general one. ``rank`` counts from 1 in ``order``.
    """
    s = F.trim(F.coalesce(F.col(source), F.lit("")))
    rows = df.withColumn("source_", s).filter("length(source_) > 1")
    first = rows.groupBy(*keys, F.lower("source_").alias("_low")).agg(F.min_by(F.struct("source_", F.trim(F.coalesce(F.col(target), F.lit(""))).alias("t"), F.trim(F.coalesce(F.col(context), F.lit(""))).alias("c")), F.struct(*order)).alias("r"), F.min(F.struct(*order)).alias("o"))
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy("o"))).filter(F.col("rank") <= top)
    return ranked.select(*keys, "rank", F.col("r.source_").alias("source"), F.when(F.length("r.t") > 0, F.col("r.t")).otherwise(F.col("r.source_")).alias("target"), F.when(F.length("r.c") > 0, F.col("r.c")).otherwise("show-specific term").alias("context"))


def within_budget(df: DataFrame, keys: Sequence[str], term: str, order: Sequence[str], most_chars: int) -> DataFrame:
    """The terms in ``order`` up to the first that would take the joined list (two characters between) over ``most_chars``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    used = F.sum(F.length(term) + 2).over(w.rowsBetween(Window.unboundedPreceding, 0)) - 2
    return df.withColumn("used_chars", used).filter(F.col("used_chars") <= most_chars)


def keep_longest(df: DataFrame, keys: Sequence[str], term: str, grams: int = 2) -> DataFrame:
    """Distinct terms that no longer term of the key contains.

    Containment is transitive, so this is what greedy keeping, longest first, leaves. A term meets only terms that share
    its rarest pair of letters, so no key compares all with all.
    """
    one = df.select(*keys, F.col(term).alias("_t")).filter(F.length("_t") >= 1).distinct()
    pairs = lambda t: F.when(F.length(t) < grams, F.array(t)).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(t) - grams + 1), lambda i: F.substr(t, i, F.lit(grams)))))
    singles = F.array_distinct(F.filter(F.split("_t", ""), lambda x: F.length(x) > 0))
    spread = one.select(*keys, "_t", F.explode(F.array_distinct(F.concat(pairs(F.col("_t")), singles))).alias("_g"))
    often = spread.groupBy(*keys, "_g").agg(F.count(F.lit(1)).alias("_n"))
    own = one.select(*keys, "_t", F.explode(pairs(F.col("_t"))).alias("_g")).join(often, [*keys, "_g"])
    rare = own.groupBy(*keys, "_t").agg(F.min_by("_g", F.struct("_n", "_g")).alias("_g"))
    longer = spread.select(*keys, F.col("_t").alias("_l"), "_g")
    held = rare.join(longer, [*keys, "_g"]).filter((F.col("_t") != F.col("_l")) & F.contains("_l", "_t")).select(*keys, "_t").distinct()
    return one.join(held, [*keys, "_t"], "left_anti").withColumnRenamed("_t", term)


#: Parts that a key's texts are dealt to, so that a hot key isn't one task. Its terms stand in every part.
PARTS = 4


def contained_terms(texts: DataFrame, terms: DataFrame, keys: Sequence[str], text: str, term: str) -> DataFrame:
    """Pairs of ``texts`` rows and the ``terms`` (distinct, of two characters or more) of the same keys that their text holds.

    A term meets only texts that hold its rarest pair of letters, by the terms of the key, so no key compares all with
    all. Null and empty texts and shorter terms match nothing. Texts and terms are shuffled once, as they are: a task
    holds the terms of one key while its texts pass by, and no list of pairs of letters is joined or broadcast.
    """
    known = lambda df: df.dropna(subset=list(keys))
    own = known(terms.select(*keys, term)).filter(F.length(term) > 1).distinct()
    rows = known(texts).filter(F.length(text) > 1).withColumn("_side", F.lit(1)).withColumn("_part", F.pmod(F.xxhash64(text), F.lit(PARTS)).cast("int"))
    every = own.withColumn("_side", F.lit(0)).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
    both = rows.unionByName(every, allowMissingColumns=True).repartition(*keys, "_part").sortWithinPartitions(*keys, "_part", "_side")
    columns, on = texts.columns, [*keys, "_part"]

    def run(batches):
        import pyarrow as pa

        at, words, rare = None, [], None
        for batch in batches:
            took, found = [], []
            lists = [batch.column(c).to_pylist() for c in (*on, "_side", text, term)]
            for i, (*key, side, x, w) in enumerate(zip(*lists)):
                if key != at:
                    at, words, rare = key, [], None
                if not side:
                    words.append(w)
                elif words:
                    rare = rare or _by_rarest_pair(words)
                    for g in rare.keys() & {x[j : j + 2] for j in range(len(x) - 1)}:
                        held = [w for w in rare[g] if w in x]
                        took += [i] * len(held)
                        found += held
                    if len(found) > 20_000:
                        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(took)) for c in columns), pa.array(found)], [*columns, term])
                        took, found = [], []
            if found:
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(took)) for c in columns), pa.array(found)], [*columns, term])

    return both.mapInArrow(run, texts.withColumn(term, F.lit("")).schema)


def _by_rarest_pair(words: Sequence[str]) -> dict[str, list[str]]:
    """Words under the pair of letters in them that the fewest of the words hold, the first of equals."""
    pairs = [{w[i : i + 2] for i in range(len(w) - 1)} for w in words]
    often = Counter(g for own in pairs for g in own)
    rare: dict[str, list[str]] = {}
    for w, own in zip(words, pairs):
        rare.setdefault(min(own, key=lambda g: (often[g], g)), []).append(w)
    return rare


def span_score(count: Column, term: Column, safe: bool) -> Column:
    """A hundred times the weight of a term in a span: two a sighting, less for length; ``safe`` favours what looks like a name."""
    from ..functions import predicates as p

    score = 200 * count - 3 * F.greatest(F.lit(0), F.length(term) - 12)
    if not safe:
        return score - F.when(p.is_sentence_like(term), 50).otherwise(0)
    latin = term.rlike("[A-Za-z]") & ~term.rlike("^[A-Za-z0-9 ]+$")
    return score + F.when(p.is_entity_like(term), 200).otherwise(0) + F.when(term.rlike("[ァ-ヶ・]"), 50).otherwise(0) + F.when(F.contains(term, F.lit(" ")), 50).otherwise(0) + F.when(latin, 25).otherwise(0)


def span_terms(counts: DataFrame, keys: Sequence[str], term: str, count: str, limit: int, safe: bool) -> DataFrame:
    """``keys, rank, term, count``: a span's ``limit`` best terms; ties go to the more frequent, then the shorter, then the later one."""
    from ..functions.predicates import is_prompt_safe

    rows = counts.filter(is_prompt_safe(F.col(term))) if safe else counts
    score = span_score(F.col(count), F.col(term), safe)
    w = Window.partitionBy(*keys).orderBy(score.desc(), F.col(count).desc(), F.length(term), F.col(term).desc())
    return rows.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit).select(*keys, "rank", term, count)
