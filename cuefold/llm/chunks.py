"""Texts over a size limit in pieces: a hierarchy of separators, greedily packed, with overlap between pieces."""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Levels from the widest unit to the narrowest. A cut lies at the end of each match.
LEVELS = {
    "section": regex.compile(r"(?:\r?\n[^\S\n]*){2,}|\f"),
    "paragraph": regex.compile(r"\n|\u2029"),
    "sentence": regex.compile(r"(?:[!?。！？．…।॥؟۔]+|\.+(?=[\p{Pe}\p{Pf}\"']*(?:\s|$)))[\p{Pe}\p{Pf}\"']*\s*"),
    "word": regex.compile(r"\s+"),
    "mark": regex.compile(r"[\p{P}\p{S}\p{Z}\s]+"),
    "edge": regex.compile(r"[\p{P}\p{S}\p{Z}\s]|[^\p{P}\p{S}\p{Z}\s]+"),
}
_CLUSTER = regex.compile(r"\X")


def _units(text: str, size: int, limit: int) -> tuple[list[tuple[int, int, str]], bool]:
    """Units ``(start, end, level)`` that cover ``text``; whether one had to be cut between characters.

    A unit has at most ``size`` code points where a separator allows, else at most ``limit``.
    """
    names, out, forced = [*LEVELS], [], False
    todo = [(0, len(text), 0, "text")]
    while todo:
        a, b, level, name = todo.pop()
        if b - a <= size or (level == len(names) and b - a <= limit):
            if b > a:
                out.append((a, b, name))
        elif level < len(names):
            cuts = [m.end() for m in LEVELS[names[level]].finditer(text, a, b)]
            ends = sorted({*cuts, b} - {a})
            parts = list(zip([a, *ends], ends))
            todo += [(x, y, level + 1, names[level] if len(parts) > 1 else name) for x, y in reversed(parts)]
        else:
            forced, at = True, a
            while b - at > size:
                end = _whole(text, at, at + size)
                out.append((at, end, "character"))
                at = end
            out.append((at, b, "character"))
    return out, forced


def _whole(text: str, start: int, end: int) -> int:
    """``end``, moved back so that no cluster of a letter and its marks is cut, if one fits before it."""
    if end < len(text):
        for m in _CLUSTER.finditer(text, max(start, end - 40)):
            if m.end() > end:
                return m.start() if m.start() > start else end
            if m.end() == end:
                return end
    return end


def pieces(text: str, limit: int, overlap: int) -> tuple[list[tuple[int, int, int]], bool]:
    """``(start, own, end)`` of each piece, and whether the text was cut between characters.

    A piece is ``text[start:end]``, at most ``limit`` code points; ``text[start:own]``, at most ``overlap``, repeats the
    end of the piece before, from a word's start where one lies in reach. The own parts cover the text without gaps.
    """
    units, forced = _units(text, max(1, limit - overlap), limit)
    starts = [0] + [m.end() for m in LEVELS["mark"].finditer(text)] if len(units) > 1 else [0]
    out: list[tuple[int, int, int]] = []
    start = own = end = 0
    for a, b, _ in units:
        if end > own and b - start > limit:
            out.append((start, own, end))
            low = max(own, a - min(overlap, limit - (b - a)))
            i = bisect.bisect_left(starts, low)
            start = starts[i] if i < len(starts) and starts[i] < a else _whole(text, 0, low) if low < a else a
            start, own = max(start, low), a
        end = b
    if end > own:
        out.append((start, own, end))
    return out, forced


def split_oversized(df: DataFrame, keys: list[str], text: str, limit: int = 120, overlap: int = 20, start_ms: str | None = None, end_ms: str | None = None, all_rows: bool = False) -> DataFrame:
    """Pieces of the texts of more than ``limit`` code points, with their share of the row's time.

    Returns ``keys, piece_no (from 1), n_pieces, from_pos, to_pos, own_pos, text, start_ms, end_ms, forced``. Positions
    count code points, ``from_pos`` exclusive of what comes before it; the piece is ``text[from_pos:to_pos]`` and starts
    to be new at ``own_pos``. Times divide ``start_ms`` to ``end_ms`` by the new code points; they are null where a bound
    is null or the end doesn't lie after the start. ``forced`` tells of the whole text whether any cut fell between
    characters. Null and empty texts give no row; shorter texts one row with ``all_rows``, else none.
    """
    times = [F.col(c).cast("long") if c else F.lit(None).cast("long") for c in (start_ms, end_ms)]
    source = df.select(*keys, F.col(text).alias("_t"), times[0].alias("_s"), times[1].alias("_e")).filter(F.length("_t") > (0 if all_rows else limit))
    k = len(keys)
    ddl = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keys).schema])
    ddl += ", piece_no int, n_pieces int, from_pos int, to_pos int, own_pos int, text string, start_ms long, end_ms long, forced boolean"
    names = [*keys, "piece_no", "n_pieces", "from_pos", "to_pos", "own_pos", "text", "start_ms", "end_ms", "forced"]
    types = [pa.int32()] * 5 + [pa.string(), pa.int64(), pa.int64(), pa.bool_()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            index, rows = [], []
            for i, (t, s, e) in enumerate(zip(*(b.column(k + j).to_pylist() for j in range(3)))):
                own, forced = pieces(t, limit, overlap)
                span = e - s if s is not None and e is not None and e > s else None
                at = lambda p, s=s, span=span, n=len(t): None if span is None else s + span * p // n
                for no, (x, new, y) in enumerate(own, 1):
                    index.append(i)
                    rows.append((no, len(own), x, y, new, t[x:y], at(new), at(y), forced))
            cols = list(zip(*rows)) if rows else [()] * len(types)
            take = pa.array(index, pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(i).take(take) for i in range(k)] + [pa.array(c, ty) for c, ty in zip(cols, types)], names=names)

    return source.mapInArrow(cut, ddl)
