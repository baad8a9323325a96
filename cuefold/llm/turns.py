"""Clean speaker turns from transcripts: labels found and normalised, their variants joined to speakers, turns collapsed."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import carry_forward, previous, running_sum
from ..operators.skew import hot_join
from ..session import cut
from .sentences import _FINAL, _clean

# Words that are no speech by themselves.
FILLERS = "えーと えーっと えっと えっとー えと うーん うーんと うんと んー んーと えー ええと あー あの あのー あのう その そのー まあ まー ま ん uh um er erm hmm hm mm ah uhm umm"
_FILLER_ONLY = re.compile(r"(?:[^\w]|_|" + "|".join(f"(?<![a-z]){w}(?![a-z])" if w.isascii() else w for w in sorted(FILLERS.split(), key=len, reverse=True)) + ")*", re.I)
_STAMP = r"[\[(<（［]?\d?\d:\d\d:\d\d(?:[.,]\d+)?[\])>）］]?"
_BEFORE = r"[\s>\])】〕）*♪~—–-]"
_SIGNS = r"\s:：<>\[\]【】〔〕()（）「」『』“”。！？!?、,"
_NAME = rf"(?![{_SIGNS}_])\w[^{_SIGNS}]*"
_PART = re.compile(
    rf"(?P<stamp>{_STAMP})"
    r"|<v(?:\.\S+)?\s+(?P<voice>[^<>\n]+)>"
    r"|(?P<note><[^<>\n]+>|〈[^〉\n]+〉|\*[^*\n]+\*)"
    r"|[\[【〔(（](?P<round>[^\[\]【】〔〕()（）\n]+)[\]】〕)）]"
    rf"|(?:^|(?<={_BEFORE}))(?:[-–—>]+\s*)*(?P<dash>speaker[ _]?\d+|{_NAME}(?: {_NAME})?)(?<!\.)[^\S\n]+[-–—]+\s"
    rf"|(?:^|(?<={_BEFORE}))(?:[-–—>]+\s*)*(?P<colon>speaker \d+|{_NAME}(?: {_NAME})?)\s?[:：]",
    re.I | re.M,
)
_NUMBER = re.compile(r"(?:speaker|spk|s)[ _]?0*(\d+)", re.I)
# Forms of address after or before a name.
_ADDRESS = re.compile(r"(?:氏|さん|様|くん|君|ちゃん|-san)$|^(?:mr|mrs|ms|dr|prof)\.? ", re.I)


def normal_label(label: str) -> str:
    """A label as it is compared: one width and case, no spaces or forms of address; speaker numbers as ``#n``."""
    label = unicodedata.normalize("NFKC", label).strip(" -–—>・")
    if m := _NUMBER.fullmatch(label):
        return f"#{m[1]}"
    return re.sub(r"[\s・.,_]+", "", _ADDRESS.sub("", label)).casefold()


def is_speech(text: str) -> bool:
    """Whether anything but fillers, marks and signs is there."""
    return _FILLER_ONLY.fullmatch(text) is None


_FILLERS = re.compile("(?:(?<=[\\s、,。.…!?！？])|^)(?:" + "|".join(f"{w}(?![\\w'-])" if w.isascii() else f"{w}(?=[、…,。.\\s]|$)" for w in sorted(FILLERS.split(), key=len, reverse=True)) + r")[、,…。.]*\s*", re.I)


def clean_speech(said: str) -> str:
    """Speech in one line, without fillers that stand by themselves, signs of music and dashes before it."""
    return re.sub(r"\s+", " ", _FILLERS.sub("", re.sub(r"[♪♫♬~>]+|(?:^|(?<=\s))[-–—]+(?=\s|\w)", " ", said).strip())).strip()


def utterances(text: str) -> list[tuple[str | None, bool, bool, str]]:
    """``(label, firm, speech, said)`` of the parts of a text, in order.

    ``label``: normalised, null for what comes before any. ``firm``: a bracket, so a label that means no speaker is an
    annotation; else it is speech. ``speech``: whether more than fillers follows the label. ``said``: that speech as it stands.
    """
    t = _clean(text)[0]
    out: list[tuple[str | None, bool, bool, str]] = []
    label, firm, said, at = None, True, [], 0
    for m in _PART.finditer(t):
        kind = m.lastgroup
        inner = m.group(kind)
        if kind == "round" and (inner.rstrip()[-1:] in _FINAL or not inner.strip()):
            continue  # a sentence in brackets
        said.append(t[at : m.start()])
        at = m.end()
        if kind in ("stamp", "note"):
            continue
        own = normal_label(inner)
        if not own or own.isdigit():
            if kind in ("colon", "dash"):
                said.append(inner)
            continue
        whole = " ".join(said)
        out.append((label, firm, is_speech(whole), whole))
        label, firm, said = own, kind == "round", []
        if kind in ("colon", "dash") and " " in inner and not _NUMBER.fullmatch(inner):
            own = normal_label(inner.split(" ")[-1])  # of two words the last alone may be the label
            label = f"{label}|{own}" if own and not own.isdigit() else label
    said.append(t[at:])
    whole = " ".join(said)
    out.append((label, firm, is_speech(whole), whole))
    return [x for x in out if x[0] is not None or x[2]]


class _Union:
    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        self.up[self.root(a)] = self.root(b)


def cluster(labels: list[str], least: float = 0.86) -> list[list[str]]:
    """Spellings of one transcript that are variants of each other, by union-find.

    Spellings meet in what they share: the whole, the last name, the initial with the last name, in either order. A last
    name that two whole names share joins neither. Of one initial, spellings of over three characters are joined if they
    are ``least`` alike; numbers are only joined if equal.
    """
    union = _Union()
    meet: dict[str, dict[str, str]] = {}
    alike: dict[str, list[str]] = {}
    for label in sorted(labels):
        union.root(label)
        whole, _, last = label.partition("|")
        for key in {whole} | ({last, whole[0] + last, last + whole[0]} if last else set()):
            meet.setdefault(key, {}).setdefault(whole if last else "", label)
        if len(whole) > 3 and whole[0] != "#":
            alike.setdefault(whole[0], []).append(label)
    for own in meet.values():
        if len(own.keys() - {""}) < 2:  # else two whole names share it
            first, *others = own.values()
            for x in others:
                union.join(x, first)
    for own in alike.values():
        for i, x in enumerate(own):
            a = x.partition("|")[0]
            for y in own[:i]:
                b = y.partition("|")[0]
                if union.root(x) != union.root(y) and 2 * min(len(a), len(b)) >= least * (len(a) + len(b)) and SequenceMatcher(None, a, b).ratio() >= least:
                    union.join(x, y)
    out: dict[str, list[str]] = {}
    for label in sorted(labels):
        out.setdefault(union.root(label), []).append(label)
    return list(out.values())


def link_labels(labels: list[str], cast: list[dict], least: float = 0.86, spoken: set[str] | None = None) -> dict[str, str]:
    """The speaker id, after all merges, that each label of one transcript means; labels that mean none are left out.

    A spelling fits a speaker by its number, by a name equal to its own or to its first or last part, by initials with
    the family name, or, if it fits nobody so, by the most similar name of the same initial if that is at least ``least``
    alike and no other speaker's comes near. A spelling that fits two speakers alike fits none. Variants are clustered
    with each other first (:func:`cluster`); where all that fit in a cluster fit one speaker, the others mean them too.
    A transcript without a cast has its clusters for speakers, each with its longest spelling for an id; only clusters
    with a number or one of the labels ``spoken`` count, as brackets may hold annotations.
    """
    groups = cluster(labels, least)
    if not cast:
        ids = {x: "label:" + min(own, key=lambda y: (-len(y.partition("|")[0]), y)).partition("|")[0] for own in groups for x in own if any(y[0] == "#" or spoken is None or y in spoken for y in own)}
        return ids
    direct = _fits(labels, cast, least)
    out: dict[str, str] = {}
    for own in groups:
        meant = {direct[x] for x in own if x in direct}
        for x in own:
            if x in direct or len(meant) == 1:
                out[x] = direct.get(x) or next(iter(meant))
    return out


def _fits(labels: list[str], cast: list[dict], least: float) -> dict[str, str]:
    """The speaker that each label fits by itself."""
    merged = {c["spk_id"]: c["merged_into"] for c in cast}

    def settled(spk: str) -> str:
        seen = set()
        while merged.get(spk) and spk not in seen:
            seen.add(spk)
            spk = merged[spk]
        return spk

    forms: dict[str, set[str]] = {}
    fulls: list[tuple[str, str]] = []
    for c in cast:
        spk = settled(c["spk_id"])
        if m := re.search(r"(\d+)$", c["spk_id"]):
            forms.setdefault(f"#{int(m[1])}", set()).add(spk)
        forms.setdefault(normal_label(c["spk_id"]), set()).add(spk)
        for name in {c["name"], c["romaji"]} - {None, ""}:
            parts, whole = [normal_label(p) for p in name.split()], normal_label(name)
            own = {whole, *parts, "".join(parts[::-1])}
            if len(parts) > 1:
                own |= {parts[0][:1] + parts[-1], parts[-1] + parts[0][:1]}
            fulls += [(p, spk) for p in {whole, parts[-1]} if len(p) > 3]
            if len(parts) == 1 and not name.isascii():  # names written without a space start with the family name
                own |= {whole[:i] for i in range(1, len(whole))}
            for f in own - {""}:
                forms.setdefault(f, set()).add(spk)
    out: dict[str, str] = {}
    for label in labels:
        whole_label, _, last = label.partition("|")
        fit = forms.get(whole_label) or forms.get(last) or set()
        if len(fit) > 1:  # a whole name wins over a part of another
            whole = {settled(c["spk_id"]) for c in cast if whole_label in (normal_label(c["name"] or ""), normal_label(c["romaji"] or ""))}
            fit = whole or fit
        if not fit and not last and len(label) > 3:
            near = sorted(((SequenceMatcher(None, label, f).ratio(), spk) for f, spk in fulls if f[0] == label[0]), reverse=True)
            other = next((r for r, spk in near if spk != near[0][1]), 0.0)
            if near and near[0][0] >= least and near[0][0] - other >= 0.05:
                fit = {near[0][1]}
        if len(fit) == 1:
            out[label] = next(iter(fit))
    return out


def _lines(rows: DataFrame, speakers: DataFrame, group: str, transcript: str, key: str, start_ms: str, text: str, loaded: str, block_ms: int, with_text: bool) -> DataFrame:
    """``_g, _t, ms, k, no, who, turn_no`` (and ``said``) of every utterance that is speech."""
    g, tr = "_g", "_t"
    source = rows.select(F.col(group).alias(g), F.col(transcript).alias(tr), F.col(key).cast("string").alias("k"), F.col(start_ms).cast("long").alias("ms"), F.col(loaded).cast("timestamp").alias("at"), F.col(text).alias("x")).filter("k IS NOT NULL AND ms IS NOT NULL AND x IS NOT NULL")
    part = pa.struct([("label", pa.string()), ("firm", pa.bool_()), ("speech", pa.bool_())] + ([("said", pa.string())] if with_text else []))
    names = ("label", "firm", "speech", "said")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = [[dict(zip(names, (*u[:3], clean_speech(u[3])) if with_text else u[:3])) for u in utterances(x)] for x in b.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(5)), pa.array(said, pa.list_(part))], names=[g, tr, "k", "ms", "at", "said"])

    parsed = source.mapInArrow(parse, f"{g} string, {tr} string, k string, ms long, at timestamp, said array<struct<label:string,firm:boolean,speech:boolean" + (",said:string>>" if with_text else ">>"))
    once = parsed.groupBy(g, tr, "k").agg(F.max_by(F.struct("ms", "said"), F.struct("at", "ms")).alias("r"))
    parts = cut(once.select(g, tr, "k", "r.ms", F.posexplode("r.said").alias("no", "u")).select(g, tr, "k", "ms", "no", "u.*"))
    cast = speakers.select(F.col(transcript).alias(tr), "spk_id", "name", "romaji", "merged_into").filter("spk_id IS NOT NULL").groupBy(tr).agg(F.collect_set(F.struct("spk_id", "name", "romaji", "merged_into")).alias("cast"))
    labels = parts.filter("label IS NOT NULL").groupBy(tr).agg(F.collect_set("label").alias("labels"), F.collect_set(F.when(~F.col("firm"), F.col("label"))).alias("spoken"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for t, own, spoken, who in zip(*(b.column(i).to_pylist() for i in range(4))):
                out += [(t, x, spk) for x, spk in link_labels(sorted(own), sorted(who or (), key=lambda c: c["spk_id"]), spoken=set(spoken)).items()]
            cols = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cols], names=[tr, "label", "spk"])

    means = labels.join(cast, tr, "left").select(tr, "labels", "spoken", "cast").mapInArrow(link, f"{tr} string, label string, spk string")
    block = F.floor(F.col("ms") / block_ms).alias("block")
    said = ["said"] if with_text else []
    named = hot_join(parts, means, [tr, "label"], ["k", "no"], "left").select(g, tr, block, "ms", "k", "no", "spk", *said, (F.col("speech") | (~F.col("firm") & F.col("label").isNotNull() & F.col("spk").isNull())).alias("speech"))
    keys, order = [g, tr], ["ms", "k", "no"]
    spoken = cut(carry_forward(named, keys, "block", order, "spk", "who").filter("speech AND who IS NOT NULL").select(*keys, "block", *order, "who", *said))
    changed = previous(spoken, keys, "block", order, "who", "before").withColumn("new", F.when(F.col("before") == F.col("who"), 0).otherwise(1))
    return running_sum(changed, keys, "block", order, "new", "turn_no")


def speaker_turns(rows: DataFrame, speakers: DataFrame, group: str, transcript: str, key: str, start_ms: str, text: str, loaded: str, block_ms: int = 600_000) -> DataFrame:
    """Turns ``group, transcript, turn_no, spk_id, first_ms, last_ms`` of transcripts.

    rows: one part of a transcript each, ordered by ``start_ms``, then ``key``; of rows with equal ``group``,
    ``transcript`` and ``key`` the one loaded last counts. Rows without a key, a start or a text are left out. speakers:
    ``transcript, spk_id, name, romaji, merged_into``; repeated rows are harmless, merges may chain, a cycle ends where it
    began. A transcript without speakers has turns of its labels' clusters. In one with speakers, what stands before a
    colon and means none of them is speech. Speech without a label belongs to the speaker before it; before any speaker
    it belongs to nobody and is left out. Distinct label spellings are gathered per transcript; rows never are. Building
    the result runs jobs and materialises the utterances.
    """
    turns = _lines(rows, speakers, group, transcript, key, start_ms, text, loaded, block_ms, False).groupBy("_g", "_t", "turn_no")
    return turns.agg(F.first("who").alias("spk_id"), F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms")).select(
        F.col("_g").alias(group), F.col("_t").alias(transcript), F.col("turn_no").cast("int").alias("turn_no"), "spk_id", "first_ms", "last_ms"
    )


def speaker_lines(rows: DataFrame, speakers: DataFrame, group: str, transcript: str, key: str, start_ms: str, text: str, loaded: str, block_ms: int = 600_000) -> DataFrame:
    """The clean transcript: ``group, transcript, turn_no, spk_id, ms, key, part_no, said`` of every utterance, as :func:`speaker_turns`.

    ``said`` is the speech in one line, without labels, stamps, annotations and fillers. A turn's text is its lines in
    order of ``ms, key, part_no``; it isn't gathered in one row, as a speaker may hold a whole transcript.
    """
    lines = _lines(rows, speakers, group, transcript, key, start_ms, text, loaded, block_ms, True)
    return lines.select(F.col("_g").alias(group), F.col("_t").alias(transcript), F.col("turn_no").cast("int").alias("turn_no"), F.col("who").alias("spk_id"), "ms", F.col("k").alias("key"), F.col("no").alias("part_no"), "said")
