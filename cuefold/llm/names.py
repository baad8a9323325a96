"""Spelled names linked to the persons they mean: a prefix-filtered q-gram join, verified by soft weighted tokens.

Every person has forms: whole names in each script and order, family names, family names with an initial, and short
forms of the first two kana of both names. Names in normal form meet forms in an equi-join on the rare q-grams of both
(the prefix filter), which loses no pair that shares enough of them. What meets is verified token by token: each token's
similarity by edit distance, weighted by how rare the token is among the persons. Persons, forms and names are tables;
none of them is sent to every task.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import hot_join
from ..session import cut
from .sentences import _INVISIBLE, _PLAIN

#: Teams that may be sent to every task; where there are more, names meet them in a join.
MOST_TEAMS = 20_000
_AGE = re.compile(r"\(\s*\d{1,3}\s*(?:歳|才|years?)?\s*\)")
# Forms of address.
_ADDRESS = re.compile(r"(?:氏|さん|様|くん|君|ちゃん|選手|-?san)$|^(?:mr|mrs|ms|dr|prof)\b\.? ?", re.I)
_HIRA = {c: c - 0x60 for c in range(0x30A1, 0x30F7)}
_KANA = re.compile(r"[ぁ-ゟー]+")
_HAN = re.compile(r"[㐀-鿿々]+")

# Han characters that stand for katakana of the same shape beside katakana.
_SHAPES = dict(zip("一卜夕八力二口工", "ートタハカニロエ"))
_SHAPED = re.compile("(?<=[ァ-ヺー゙゚])[一卜夕八力二口工]|[一卜夕八力二口工](?=[ァ-ヺー゙゚])")


def _reshape(x: str) -> str:
    while (y := _SHAPED.sub(lambda m: _SHAPES[m[0]], x)) != x:
        x = y
    return x


def plain_name(name: str) -> str:
    """A name of one width, without invisible code points and age."""
    return _AGE.sub(" ", unicodedata.normalize("NFKC", _INVISIBLE.sub("", name).translate(_PLAIN)).strip())


def team_forms(team: str) -> set[str]:
    form = unicodedata.normalize("NFKC", team)
    return {form, _reshape(form)} - {""}


def _without(x: str, teams: Iterable[str], lengths: list[int]) -> str:
    """``x`` with a space for every team in it, the longest at each place. ``lengths`` descend."""
    out, i, n = [], 0, len(x)
    while i < n:
        for k in lengths:
            if x[i : i + k] in teams and i + k <= n:
                out.append(" ")
                i += k
                break
        else:
            out.append(x[i])
            i += 1
    return "".join(out)


def normal_name(name: str, teams: Iterable[str] = frozenset()) -> list[str]:
    """The words of a name, of one width, case and kana, without age, team and forms of address."""
    lengths = sorted({len(t) for t in teams}, reverse=True)
    return _words(plain_name(name), teams, lengths)


def _words(x: str, teams: Iterable[str], lengths: list[int]) -> list[str]:
    plain = _without(x, teams, lengths) if lengths else x
    if plain == x:
        plain = unicodedata.normalize("NFC", _reshape(x))
        plain = _without(plain, teams, lengths) if lengths else plain
    x = re.sub(r"\([^()]*\)", " ", plain).strip(" ・,")
    x = _ADDRESS.sub("", x).strip(" ・,")
    words = [w for w in re.split(r"[\s・,.·]+", x.lower().translate(_HIRA)) if w]
    # a lone kana behind a name in Han characters is a slip of the hand or of the reader
    if len(words) == 1 and len(words[0]) > 2 and _HAN.fullmatch(words[0][:-1]) and _KANA.fullmatch(words[0][-1]):
        words = [words[0][:-1]]
    return words


def queries_of(words: list[str]) -> list[tuple[str, ...]]:
    """What is looked up for a name: its words in Latin letters, else all as one, also in turned order."""
    whole = "".join(words)
    if not words:
        return []
    if whole.isascii():
        return [tuple(words)]
    return [(whole,), ("".join(words[::-1]),)] if len(words) > 1 else [(whole,)]


def distance(a: str, b: str) -> list[list[int]]:
    """Edit distances of all prefixes of ``a`` and ``b``; a swap of neighbours counts once."""
    d = [[*range(len(b) + 1)]]
    for i, x in enumerate(a, 1):
        row, up = [i], d[-1]
        for j, y in enumerate(b, 1):
            v = min(up[j] + 1, row[-1] + 1, up[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                v = min(v, d[i - 2][j - 2] + 1)
            row.append(v)
        d.append(row)
    return d


def grams(words: Iterable[str]) -> set[str]:
    """Padded q-grams of words: of three letters in Latin script, else of two and the single characters."""
    out = set()
    for w in words:
        n, padded = (3 if w.isascii() else 2), f"^{w}$"
        out |= {padded[i : i + n] for i in range(max(1, len(padded) - n + 1))}
        if n == 2:
            out |= set(w)
    return out


def _digests(words: Iterable[str]) -> list[int]:
    return [xxhash.xxh32_intdigest(g.encode()) - (1 << 31) for g in sorted(grams(words))]


def _signature(digests: Iterable[int]) -> int:
    """64 bits, one set for each digest; what one has and another hasn't bounds from above what they share."""
    bits = 0
    for d in digests:
        bits |= 1 << (d & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def forms_of(name: str | None, reading: str | None, romaji: str | None, tail: str, head: str) -> tuple[set[tuple], set[str], set[str]]:
    """A person's forms ``(kind, words, parts)``, and the spellings of the family and of the given name."""
    sur, giv = (reading.translate(_HIRA).split() + ["", ""])[:2] if reading else ("", "")
    g_rom, s_rom = (romaji.lower().split() + ["", ""])[:2] if romaji else ("", "")
    name = name or ""
    s_han, g_han = (name[: len(name) - len(tail)], tail) if tail else (head, name[len(head) :]) if head else (name, "")
    out: set[tuple] = set()
    for a, b in {(s_han, g_han), (sur, giv), (s_han, giv), (sur, g_han)}:
        if a and b:
            out |= {("full", (a + b,), (a, b)), ("full", (b + a,), (b, a))}
    if s_rom and g_rom:
        out |= {("full", (s_rom, g_rom), (s_rom, g_rom)), ("full", (s_rom, g_rom), (g_rom, s_rom)), ("initial", (s_rom, g_rom[0]), (s_rom, g_rom[0]))}
    family, given = {s_han, sur, s_rom} - {""}, {g_han, giv, g_rom} - {""}
    out |= {("family", (s,), (s,)) for s in family}
    if len(sur) > 1 and len(giv) > 1:
        out.add(("short", (sur[:2] + giv[:2],), (sur[:2], giv[:2])))
    return out, family, given


def shared_end(lo: str | None, hi: str | None, least: int) -> int:
    """How many first characters all names of a group share, from its least and greatest; at most ``least - 1``."""
    k = 0
    while lo is not None and k < min(len(lo), len(hi), least - 1) and lo[k] == hi[k]:
        k += 1
    return k


def soft(tokens: list[tuple[float, float]]) -> float:
    """Similarities of tokens ``(weight, similarity)`` as one; rare tokens weigh more."""
    return sum(w * s for w, s in tokens) / sum(w for w, _ in tokens)


def verify(words: tuple[str, ...], kind: str, parts: tuple[str, ...], weights: tuple[float, ...], known: set[str], families: set[str]) -> float:
    """How well ``words`` are a form, in (0, 1]; 0 if they aren't.

    ``known`` and ``families``: those beginnings and ends of the words that are some person's own name. A slip can turn
    one name into another, which is believed only of a person at hand.
    """
    whole = "".join(words)
    if kind == "short":
        return 0.8 if whole == "".join(parts) else 0.0
    if kind == "initial":
        if [w for w in words if len(w) == 1] != [parts[1]]:
            return 0.0
        rest = "".join(w for w in words if len(w) > 1)
        s = _alike(rest, parts[0])
        return 0.9 * soft([(weights[0], s), (weights[1], 1.0)]) if s >= 0.7 and (s == 1 or rest not in families) else 0.0
    if kind == "family":
        if len(words) > 1 and any(len(w) == 1 for w in words):
            return 0.0
        if whole == parts[0]:
            return 0.85
        if len(whole) <= 4 or whole in families or abs(len(whole) - len(parts[0])) * 4 > max(len(whole), len(parts[0])):
            return 0.0
        s = soft([(weights[0], _alike(whole, parts[0]))])
        return 0.8 * s if s >= 0.75 else 0.0
    a, b = parts
    if whole == a + b:
        return 1.0
    if abs(len(whole) - len(a) - len(b)) > 3 or (len(words) > 1 and any(len(w) == 1 and w.isascii() for w in words) and len(words) == 2 and len(whole) < len(a) + len(b) - 3):
        return 0.0
    han = _HAN.fullmatch(a) or _HAN.fullmatch(b)
    if han and sum((Counter(whole) - Counter(a + b)).values()) > 2:  # more strange characters than slips allowed
        return 0.0
    head = distance(whole, a)
    tail = distance(whole[::-1], b[::-1])
    n = len(whole)
    cost, k = min((head[k][len(a)] + tail[n - k][len(b)], abs(k - len(a)), k) for k in range(n + 1))[::2]
    x, y = whole[:k], whole[k:]
    da, db = head[k][len(a)], tail[n - k][len(b)]
    if (da and x != a and x in known) or (db and y != b and y in known):
        return 0.62 if cost == 1 else 0.0
    sa, sb = 1 - da / max(len(a), len(x), 1), 1 - db / max(len(b), len(y), 1)
    score = soft([(weights[0], sa), (weights[1], sb)])
    if cost == 2 and n > 4 and distance(whole, a + b)[-1][-1] == 1:  # neighbours swapped over the parts' border
        return 1 - 1 / n
    if han:  # few characters: one slip, or one in each part
        if cost > 2 or (cost == 2 and (da != 1 or db != 1)) or (da and len(a) == 1 and db):
            return 0.0
        return max(score, 0.72) if cost == 1 else max(score, 0.6) if cost else 1.0
    return score if min(sa, sb) >= 0.5 and score >= 0.7 else 0.0


def _alike(a: str, b: str) -> float:
    return 1 - distance(a, b)[-1][-1] / max(len(a), len(b), 1)


def _each(f: Callable[[dict], Iterable[dict]], schema: pa.Schema) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function on Arrow batches from one that gives new rows for each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_pylist([new for row in b.to_pylist() for new in f(row)], schema=schema)

    return run


def _ddl(schema: pa.Schema) -> str:
    kinds = {pa.string(): "string", pa.int64(): "long", pa.int32(): "int", pa.float64(): "double"}
    return ", ".join(f"{f.name} {f'array<{kinds[f.type.value_type]}>' if pa.types.is_list(f.type) else kinds[f.type]}" for f in schema)


_TEXTS = pa.list_(pa.string())
_FORMS = pa.schema([("person_id", pa.int64()), ("kind", pa.string()), ("words", _TEXTS), ("parts", _TEXTS), ("grams", pa.list_(pa.int32())), ("bits", pa.int64())])
_QUERIES = pa.schema([("key", pa.string()), ("q", _TEXTS), ("grams", pa.list_(pa.int32())), ("bits", pa.int64()), ("edges", _TEXTS)])


def person_forms(persons: DataFrame) -> DataFrame:
    """``person_id, kind, words, parts, grams`` of every form; kinds ``known0`` and ``known1`` hold spellings of family and given names.

    Where a name in Han characters divides is told by persons of the same reading: what those of one given name share at
    the end, else what those of one family name share at the start.
    """
    spaces = "[\\s　 ]+"
    own = persons.withColumn("_r", F.split(F.trim(F.regexp_replace("reading", spaces, " ")), " ")).withColumn("_two", (F.size("_r") == 2) & (F.length("name") > 0))
    own = own.withColumn("_given", F.when(F.col("_two"), F.col("_r")[1])).withColumn("_family", F.when(F.col("_two"), F.col("_r")[0]))
    ends = lambda by, value, to: own.filter("_two").groupBy(by).agg(F.min(value).alias(f"{to}lo"), F.max(value).alias(f"{to}hi"), F.min(F.length("name")).alias(f"{to}least"))
    whole = own.join(ends("_given", F.reverse("name"), "g"), "_given", "left").join(ends("_family", F.col("name"), "f"), "_family", "left")

    def forms(r: dict) -> Iterator[dict]:
        name, tail, head = r["name"] or "", "", ""
        if r["glo"] is not None:
            k = shared_end(r["glo"], r["ghi"], r["gleast"]) if r["glo"] != r["ghi"] else 2 if len(name) > 3 else 0
            tail = name[len(name) - k :]
        if r["flo"] is not None and r["flo"] != r["fhi"]:
            head = name[: shared_end(r["flo"], r["fhi"], r["fleast"])]
        own, family, given = forms_of(r["name"], r["reading"], r["romaji"], tail, head)
        for kind, words, parts in own:
            digests = _digests(words)
            yield {"person_id": r["person_id"], "kind": kind, "words": words, "parts": parts, "grams": digests, "bits": _signature(digests)}
        for kind, names in (("known0", family), ("known1", given)):
            for x in names:
                yield {"person_id": r["person_id"], "kind": kind, "words": [], "parts": [x], "grams": [], "bits": 0}

    columns = ["person_id", "name", "reading", "romaji", "glo", "ghi", "gleast", "flo", "fhi", "fleast"]
    return whole.select(*columns).mapInArrow(_each(forms, _FORMS), _ddl(_FORMS))


def normal_names(names: DataFrame, persons: DataFrame, most_teams: int = MOST_TEAMS) -> DataFrame:
    """``name, key`` of distinct names: the words in normal form, with spaces between; names of nothing are left out.

    At most ``most_teams`` teams go to every task; more of them meet the names' substrings of a team's length in a join.
    """
    forms = F.pandas_udf(lambda s: s.map(lambda t: sorted(team_forms(t))), "array<string>")
    teams = persons.select("team").filter("length(team) > 0").distinct().select(F.explode(forms("team")).alias("team")).distinct()
    schema = pa.schema([("name", pa.string()), ("key", pa.string())])
    if len(few := [r.team for r in teams.limit(most_teams + 1).collect()]) <= most_teams:
        known, lengths = frozenset(few), sorted({len(t) for t in few}, reverse=True)

        def normal(r: dict) -> Iterator[dict]:
            if words := _words(plain_name(r["name"]), known, lengths):
                yield {"name": r["name"], "key": " ".join(words)}

        return names.mapInArrow(_each(normal, schema), _ddl(schema))
    lengths = [r.k for r in teams.select(F.length("team").alias("k")).distinct().collect()]  # as many as the longest team has letters
    piece = pa.schema([("name", pa.string()), ("team", pa.string())])

    def pieces(r: dict) -> Iterator[dict]:
        x = plain_name(r["name"])
        for y in {x, unicodedata.normalize("NFC", _reshape(x))}:
            for k in lengths:
                for i in range(len(y) - k + 1):
                    yield {"name": r["name"], "team": y[i : i + k]}

    held = hot_join(names.mapInArrow(_each(pieces, piece), _ddl(piece)), teams, ["team"], ["name"], "left_semi").groupBy("name").agg(F.collect_set("team").alias("teams"))

    def normal_with(r: dict) -> Iterator[dict]:
        own = frozenset(r["teams"] or ())
        if words := _words(plain_name(r["name"]), own, sorted({len(t) for t in own}, reverse=True)):
            yield {"name": r["name"], "key": " ".join(words)}

    return names.join(held, "name", "left").mapInArrow(_each(normal_with, schema), _ddl(schema))


def matches(keys: DataFrame, rows: DataFrame, count: int, tasks: int, least: float = 0.3) -> DataFrame:
    """``key, fid, score`` of names in normal form (``key``, distinct) and the forms of ``rows`` that they are, by :func:`person_forms`.

    A name and a form meet if they share ``least`` of their q-grams' union. ``count`` persons weigh the tokens; ``tasks``
    share the work. Names that are longer than the longest form allows can't be one and are left out first.
    """
    known = rows.filter("kind LIKE 'known%'").groupBy(F.col("parts")[0].alias("part")).agg(F.count(F.when(F.col("kind") == "known0", 1)).alias("n0"), F.count(F.when(F.col("kind") == "known1", 1)).alias("n1"))
    weight = known.select("part", F.log(1 + F.lit(float(max(2, count))) / F.when(F.col("n1") > 0, F.col("n1")).otherwise(F.col("n0"))).alias("w"))
    forms = rows.filter("kind NOT LIKE 'known%'").dropDuplicates(["fid"]).select("fid", "kind", "words", "parts", "grams", "bits")
    for i, w in enumerate(("wa", "wb")):
        forms = forms.withColumn("part", F.get("parts", F.lit(i))).join(weight.withColumnRenamed("w", w), "part", "left").drop("part")
    forms = cut(forms.fillna(1.0, ["wa", "wb"]))
    longest = forms.agg(F.max(F.length(F.array_join("words", ""))).alias("n")).first().n or 0

    def query(r: dict) -> Iterator[dict]:
        words = r["key"].split(" ")
        whole = "".join(words)
        if 3 * len(whole) > 4 * longest + 12:
            return
        for q in queries_of(words):
            w = "".join(q)
            edges = {w[:k] for k in range(1, len(w) + 1)} | {w[k:] for k in range(len(w))} | {"".join(x for x in q if len(x) > 1)}
            digests = _digests(q)
            yield {"key": r["key"], "q": q, "grams": digests, "bits": _signature(digests), "edges": sorted(edges - {""})}

    asked = cut(keys.mapInArrow(_each(query, _QUERIES), _ddl(_QUERIES)).withColumn("qid", F.xxhash64("key", "q")))
    edges = asked.select("qid", F.explode("edges").alias("part")).join(known, "part").groupBy("qid").agg(F.collect_set("part").alias("known"), F.collect_set(F.when(F.col("n0") > 0, F.col("part"))).alias("families"))
    often = forms.select(F.explode("grams").alias("g")).groupBy("g").agg(F.count(F.lit(1)).alias("n"))

    def prefixes(df: DataFrame, key: str, rare: str) -> DataFrame:
        """``key``, its bits, all q-grams and, of them, the rarest, one of which any partner must hold."""
        spread = df.select(key, "bits", F.explode("grams").alias("g")).join(often, "g", "left")
        own = spread.groupBy(key, F.col("bits").alias(f"{rare}_bits")).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "g"))).alias("o"))
        return own.select(key, f"{rare}_bits", F.transform("o", lambda x: x["g"]).alias(f"{rare}_all")).withColumn(rare, F.slice(f"{rare}_all", 1, F.size(f"{rare}_all") - F.ceil(least * F.size(f"{rare}_all")).cast("int") + 1))

    left = cut(prefixes(asked, "qid", "a").withColumn("g", F.explode("a")))
    right = prefixes(forms, "fid", "b").withColumn("g", F.explode("b"))
    near = hot_join(left, right, ["g"], ["qid"], least=2_000, tasks=tasks)
    x, y = F.size("a_all"), F.size("b_all")
    shared = least / (1 + least) * (x + y) - 1e-9
    near = near.filter((x - F.bit_count(F.col("a_bits").bitwiseAND(F.bitwise_not("b_bits"))) >= shared) & (y - F.bit_count(F.col("b_bits").bitwiseAND(F.bitwise_not("a_bits"))) >= shared))
    near = near.filter(F.size(F.array_intersect("a_all", "b_all")) >= shared).filter(F.col("g") == F.array_intersect("a", "b")[0]).select("qid", "fid")  # once, at the first they share
    full = near.join(asked.select("qid", "key", "q"), "qid").join(edges, "qid", "left").join(forms.select("fid", "kind", "parts", "wa", "wb"), "fid")
    schema = pa.schema([("key", pa.string()), ("fid", pa.int64()), ("score", pa.float64())])

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, fid, q, kind, parts, wa, wb, own, families in zip(*(c.to_pylist() for c in b.columns)):
                if s := verify(tuple(q), kind, tuple(parts), (wa, wb), set(own or ()), set(families or ())):
                    out.append((key, fid, s))
            cols = list(zip(*out)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    judged = full.select("key", "fid", "q", "kind", "parts", "wa", "wb", "known", "families").repartition(tasks, "key", "fid").mapInArrow(judge, _ddl(schema))
    return judged.groupBy("key", "fid").agg(F.max("score").alias("score"))


def link_names(items: DataFrame, keys: list[str], context: str, name: str, persons: DataFrame, cast: DataFrame, alone: float = 0.85, among: float = 0.6, margin: float = 0.01, most_teams: int = MOST_TEAMS) -> DataFrame:
    """``keys, person_id`` of each item that means a person.

    items: one name a row, in a ``context`` (an episode). persons: ``person_id, name, reading, romaji, team``. cast:
    ``context, person_id``, whom a context is known to hold. The best candidate of the cast wins at a score of ``among``
    or more; without one, the best of all persons at ``alone`` or more; two persons within ``margin`` mean nobody. Null and
    empty names and names of nobody give no row; repeated names are looked up once. Other columns are ignored. Building
    the result runs jobs: forms and names are materialised in the checkpoint folder.
    """
    ks = [f"_k{i}" for i in range(len(keys))]
    source = items.select(*[F.col(k).alias(n) for k, n in zip(keys, ks)], F.col(context).alias("ctx"), F.col(name).alias("name")).filter("length(name) > 0").withColumn("ctx", F.coalesce(F.col("ctx").cast("string"), F.lit("\0")))
    people = persons.select(F.col("person_id").cast("long").alias("person_id"), "name", "reading", "romaji", "team").filter("person_id IS NOT NULL").distinct()
    rows = cut(person_forms(people).withColumn("fid", F.xxhash64("kind", "words", "parts")))
    members = rows.filter("kind NOT LIKE 'known%'").select("fid", "person_id").distinct()
    said = cut(source.select("ctx", "name").distinct())
    # names are few bytes and much work: spread them over all cores, whatever a count of bytes would say
    spread = 4 * items.sparkSession.sparkContext.defaultParallelism
    normal = cut(normal_names(said.select("name").distinct().repartition(spread), people, most_teams))
    found = cut(matches(normal.select("key").distinct(), rows, people.count(), spread))
    top = found.groupBy("key").agg(F.max("score").alias("top"))
    meant = members.groupBy("fid").agg(F.min("person_id").alias("lo"), F.max("person_id").alias("hi"))
    sole = found.join(meant, "fid").join(top, "key").filter((F.col("top") >= alone) & (F.col("score") >= F.col("top") - margin))
    sole = sole.groupBy("key").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).filter("lo = hi").select("key", F.col("lo").alias("sole"))
    asked = cut(hot_join(said, normal, ["name"], ["ctx"]))
    known = cast.select(F.col(context).cast("string").alias("ctx"), F.col("person_id").cast("long").alias("person_id")).dropna().distinct()
    forms = known.join(members, "person_id")
    pairs = asked.select("ctx", "key").distinct().join(found.filter(F.col("score") >= among), "key")
    here = pairs.join(forms, ["ctx", "fid"]).groupBy("ctx", "key", "person_id").agg(F.max("score").alias("score"))
    best = here.groupBy("ctx", "key").agg(F.max("score").alias("top"))
    close = here.join(best, ["ctx", "key"]).filter(F.col("score") >= F.col("top") - margin).groupBy("ctx", "key").agg(F.min("person_id").alias("lo"), F.max("person_id").alias("hi"))
    decided = asked.join(close, ["ctx", "key"], "left").join(sole, "key", "left")
    person = F.when(F.col("lo").isNull(), F.col("sole")).when(F.col("lo") == F.col("hi"), F.col("lo"))
    decided = decided.select("ctx", "name", person.alias("person_id")).filter("person_id IS NOT NULL")
    return hot_join(source, decided, ["ctx", "name"], ks).select(*[F.col(n).alias(k) for k, n in zip(keys, ks)], "person_id")
