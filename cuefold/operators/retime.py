"""Times of cues changed by what stands around them. Cues are ``(start, end, text)`` in order, in whole milliseconds."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd

from .matching import merge_short, rising
from .segment import reflow, reflow_rows

Cue = tuple[int, int, str]
# Questions and set-ups are told by their end or by these words.
_ASKS = re.compile(r"[?？]$|何|どう|なんで|どこ|誰|かい|って")


def letters(text: str) -> int:
    return len(text) - text.count(" ") - text.count("\n") - text.count("\t")


def shrink_sparse(cues: Sequence[Cue], most_ms: int = 7_000, cps: int = 14) -> list[Cue]:
    """Cues longer than ``most_ms`` and than their text needs at ``cps``, cut to the longer of the two around their middle.

    A cue doesn't reach into its neighbours: into the left one's new end, the right one's old start.
    """
    out: list[Cue] = []
    for i, (s, e, text) in enumerate(cues):
        size = max(most_ms, letters(text) * 1000 // cps)
        if e - s > size:
            low, high = out[-1][1] if out else 0, cues[i + 1][0] if i + 1 < len(cues) else None
            a = max(low, (s + e - size) // 2)
            z = a + size if high is None else min(high, a + size)
            s, e = max(low, z - size), z
        out.append((s, e, text))
    return out


def grow_short(cues: Sequence[Cue], least_ms: int = 1_000, most_ms: int = 7_000, cps: int = 14, edges: tuple[int, int] = (0, 0)) -> list[Cue]:
    """Cues shorter than their text needs, grown into the silence around them, from the left end to the right.

    What is wanting is taken half from the left and the rest from the right; what one side lacks the other gives. Silence
    that an earlier cue took is gone. The outer ends grow into ``edges``, none where a track begins and ends.
    """
    out = [list(c) for c in cues]
    for i, c in enumerate(out):
        need = max(least_ms, min(most_ms, letters(c[2]) * 1000 // cps)) - (c[1] - c[0])
        if need <= 0:
            continue
        room = [c[0] - out[i - 1][1] if i else edges[0], out[i + 1][0] - c[1] if i + 1 < len(out) else edges[1]]
        room = [max(0, r) for r in room]
        left = min(room[0], need // 2)
        right = min(room[1], need - left)
        left += min(room[0] - left, need - left - right)
        c[0] -= left
        c[1] += right
    return [tuple(c) for c in out]


def attach_points(cues: Sequence[Cue], points: Sequence[tuple[int, str]], within: int = 50) -> list[Cue]:
    """Texts without duration added to the nearest cue, those within ``within`` of a cluster's first as one.

    Distance is to the end of the cue that starts before and the start of the one after; of equals a question goes to the
    next, the rest to the one before. A text that lies before the cue's start goes in front. Starts are those before any text is added.
    """
    if not cues:
        return []
    starts, out = [c[0] for c in cues], [list(c) for c in cues]
    groups: list[tuple[int, list[str]]] = []
    for at, text in sorted((p for p in points if p[1].strip()), key=lambda p: p[0]):
        if groups and at - groups[-1][0] <= within:
            groups[-1][1].append(text.strip())
        else:
            groups.append((at, [text.strip()]))
    for at, texts in groups:
        text = "\n".join(texts)
        k = bisect_left(starts, at)
        near = [(abs(at - out[j][1]) if j < k else abs(out[j][0] - at), (j < k) == bool(_ASKS.search(text)), j) for j in (k - 1, k) if 0 <= j < len(out)]
        j = min(near)[2]
        whole = [text, out[j][2]] if at < out[j][0] else [out[j][2], text]
        out[j] = [min(out[j][0], at), max(out[j][1], at), "\n".join(x for x in whole if x)]
    return [tuple(c) for c in out]


def few_lines(cues: Sequence[Cue], most: int = 2) -> list[Cue]:
    """The first ``most`` lines of each cue; what is over is dropped."""
    return [(s, e, "\n".join(t.split("\n")[:most])) for s, e, t in cues]


def halve_long(cues: Sequence[Cue], most_ms: int = 7_000, most_chars: int = 45, least_ms: int = 300) -> list[Cue]:
    """Cues over a limit cut at a line break, the halves as equal in letters as can be, a sentence's end preferred by 10.

    Time divides by letters; a cut that leaves a half under ``least_ms`` isn't made. Halves over a limit are cut again.
    """
    out: list[Cue] = []
    todo = list(cues)[::-1]
    while todo:
        s, e, text = todo.pop()
        lines = text.split("\n")
        cuts = []
        if (e - s > most_ms or letters(text) > most_chars) and len(lines) > 1:
            total = max(1, letters(text))
            for i in range(1, len(lines)):
                a = letters("".join(lines[:i]))
                at = s + (e - s) * a // total
                if at - s >= least_ms and e - at >= least_ms:
                    cuts.append((abs(total - 2 * a) - 10 * bool(re.search(r"[。！？!?.…]$", lines[i - 1])), i, at))
        if cuts:
            _, i, at = min(cuts)
            todo += [(at, e, "\n".join(lines[i:])), (s, at, "\n".join(lines[:i]))]
        else:
            out.append((s, e, text))
    return out


def reflow_cues(most_ms: int = 7_000, most_chars: int = 45, most_lines: int = 2, least_ms: int = 1_000, cps: int = 14) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Packed cues (``s, e, text``, those without duration too) in their final times.

    Short ones merge, long ones are halved, sparse ones shrink, hurried ones grow, texts without duration are attached,
    lines over the limit go, no cue starts before the one before it ends, and what is under half a second joins a neighbour.
    """
    from .repair import merge_micro

    def run(p: pd.DataFrame) -> pd.DataFrame:
        rows = [(s, e, (t or "").strip()) for s, e, t in zip(p["s"].tolist(), p["e"].tolist(), p["text"])]
        cues = [r for r in rows if r[1] > r[0] and r[2]]
        cues = merge_short(cues, least_ms, most_ms, most_chars)
        cues = shrink_sparse(halve_long(cues, most_ms, most_chars), most_ms, cps)
        cues = attach_points(grow_short(cues, least_ms, most_ms, cps), [(r[0], r[2]) for r in rows if r[1] <= r[0]])
        cues = few_lines(cues, most_lines)
        cues = [(*t, c[2]) for t, c in zip(rising([c[:2] for c in cues]), cues)]
        cues = merge_micro(cues, 500, most_ms, most_chars, most_lines)
        spans = rising([c[:2] for c in cues])
        return pd.DataFrame([(i, s, e, c[2]) for i, ((s, e), c) in enumerate(zip(spans, cues), 1)], columns=["cue", "start_ms", "end_ms", "text"])

    return run


def reflow_words(pause: int = 300, most_ms: int = 10_000, least_ms: int = 300, cps: int = 14, most_cps: int = 20) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Words (``s, e, word``) as finished cues: grouped at pauses, with words without duration, grown, and merged where too fast.

    With columns ``first`` and ``last``, the whole track's bounds, the rows may be a part of it that stands 20 s from the
    next: its outer cues grow as if the neighbours were there.
    """
    def run(p: pd.DataFrame) -> pd.DataFrame:
        grouped = reflow(pause, most_ms, least_ms)(p)
        cues = list(zip(grouped["start_ms"].tolist(), grouped["end_ms"].tolist(), grouped["text"]))
        points = p[p["e"] <= p["s"]]
        cues = attach_points(cues, list(zip(points["s"].tolist(), points["word"].fillna(""))))
        edges = (most_ms * int(p["s"].min() > p["first"].iloc[0]), most_ms * int(p["e"].max() < p["last"].iloc[0])) if "first" in p and len(p) else (0, 0)
        cues = _unhurried(cues, pause, most_ms, least_ms, cps, most_cps, edges)
        return pd.DataFrame([(i, s, e, t) for i, (s, e, t) in enumerate(cues, 1)], columns=["cue", "start_ms", "end_ms", "text"])

    return run


def _unhurried(cues: list[Cue], pause: int, most_ms: int, least_ms: int, cps: int, most_cps: int, edges: tuple[int, int]) -> list[Cue]:
    from .repair import merge_hurried

    before = None
    while cues != before:  # growing makes cues slower, merging makes them fewer
        before = cues
        cues = merge_hurried(grow_short(cues, least_ms, most_ms, cps, edges), pause, least_ms, most_ms, most_cps)
    return cues


_SPACE = re.compile("[ \t\n\x0b\f\r]+")


def split_words(text: str) -> list[str]:
    """The words of a text, each with a space after it, or its characters where no spaces part them."""
    parts = _SPACE.sub(" ", text).split(" ")
    return list("".join(parts)) if len(parts) * 12 < len(text) else [w + " " for w in parts if w]


def timed_words(cues: Sequence[tuple[int, int, int, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and words of cues ``(seq, s, e, text)``, timed evenly, in order of start, ``seq`` and place; those with duration."""
    known: dict[str, str] = {}  # a word is kept once
    words, counts = [], []
    for *_, text in cues:
        own = split_words(text)
        counts.append(len(own))
        words += map(known.setdefault, own, own)
    n = np.array(counts, np.int64)
    seq, s, e = (np.repeat(np.array([c[k] for c in cues], np.int64), n) for k in range(3))
    i = np.arange(len(words)) - np.repeat(np.cumsum(n) - n, n)
    n = np.repeat(n, n)
    a, z = s + (e - s) * i // n, s + (e - s) * (i + 1) // n
    order = np.lexsort((i, seq, a))
    order = order[z[order] > a[order]]
    return a[order], z[order], np.array(words, object)[order]


def reflow_tracks(rows: Iterable[tuple], pause: int = 300, most_ms: int = 10_000, least_ms: int = 300, cps: int = 14, most_cps: int = 20, apart_ms: int = 20_000, block_ms: int = 600_000) -> Iterator[tuple]:
    """The words of cues as finished cues: ``key, block, cues`` from ``key, seq, s, e, text`` in order of key, start and ``seq``.

    What :func:`reflow_words` makes of a track's words in blocks, those of whole sessions that begin within ``block_ms``; a
    session ends before words over ``apart_ms`` later, so what is held is the cues up to the next such pause and the words of a block.
    """
    at, first, top, held, block, parts = None, None, None, [], None, []

    def finish(last):
        a, z, w = (np.concatenate(x) for x in zip(*parts))
        edges = (most_ms * int(a[0] > first), most_ms * int(last is None or z.max() < last))
        cues = [c[1:4] for c in reflow_rows(a, z, w, pause, most_ms, least_ms)]
        return at, block, _unhurried(cues, pause, most_ms, least_ms, cps, most_cps, edges)

    def work(more):
        # all that is held ends over ``apart_ms`` before the next cue of the track
        nonlocal first, block, parts
        a, z, w = timed_words(held)
        last = None if more else z.max()
        first = a[0] if first is None else first
        new = np.flatnonzero(np.append(True, a[1:] - z[:-1] > apart_ms))
        for i, j in zip(new.tolist(), [*new[1:].tolist(), len(a)]):
            b = int(a[i]) // block_ms
            if parts and b != block:
                yield finish(last)
                parts = []
            block = b
            parts.append((a[i:j], z[i:j], w[i:j]))
        if not more:
            yield finish(last)

    for key, seq, s, e, text in rows:
        if held and (key != at or s - top > apart_ms):
            yield from work(key == at)
            held = []
        if key != at or top is None:
            at, first, top, parts = key, None, e, []
        held.append((seq, s, e, text))
        top = max(top, e)
    if held:
        yield from work(False)
