"""Matches between two ordered sequences, where each choice depends on those before it. One episode's rows at a time."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence
from difflib import SequenceMatcher

import numpy as np


def greedy_overlap(a: Sequence[tuple[int, int]], b: Sequence[tuple[int, int]]) -> list[tuple[int | None, int | None]]:
    """Each interval of ``a``, in order, with the unused one of ``b`` that it overlaps longest, the first of equals.

    Unmatched ones come with None; those of ``b`` follow at the end, so every interval occurs once.
    """
    order = sorted(range(len(b)), key=lambda k: b[k][0])
    starts = [b[k][0] for k in order]
    longest = max((z - y for y, z in b), default=0)
    used: set[int] = set()
    out: list[tuple[int | None, int | None]] = []
    for i, (s, e) in enumerate(a):
        # what may overlap starts before the end, and not further before the start than the longest lasts
        near = order[bisect_left(starts, s - longest) : bisect_left(starts, e)]
        size, j = max(((min(e, b[k][1]) - max(s, b[k][0]), -k) for k in near if k not in used), default=(0, 0))
        out.append((i, -j if size > 0 else None))
        if size > 0:
            used.add(-j)
    return out + [(None, k) for k in range(len(b)) if k not in used]


def match_lines(a: Sequence[str], b: Sequence[str], least: float = 0.5) -> list[tuple[int | None, int | None, str]]:
    """Lines of two versions matched in order, each once: equal ones, then containing ones, then similar ones.

    A pass only matches lines between the matches of the passes before it, so order holds; what is left over is matched
    once more whatever the order (``moved``). The rest is ``dropped`` or ``added``.
    """
    pairs: dict[int, tuple[int, str]] = {}

    def fits(kind: str, x: str, y: str) -> float:
        if kind == "equal":
            return float(x == y)
        if kind == "contains":
            return float(bool(x and y) and (x in y or y in x))
        r = SequenceMatcher(None, x, y).ratio()
        return r if r >= least else 0.0

    for kind in ("equal", "contains", "similar"):
        fixed = [(-1, -1), *sorted((i, j) for i, (j, _) in pairs.items()), (len(a), len(b))]
        for (i0, j0), (i1, j1) in zip(fixed, fixed[1:]):
            rows, cols = range(i0 + 1, i1), range(j0 + 1, j1)
            if not rows or not cols:
                continue
            # the heaviest chain of fitting pairs that keeps order
            w = np.array([[fits(kind, a[i], b[j]) for j in cols] for i in rows])
            best = np.zeros((len(rows) + 1, len(cols) + 1))
            for i in range(len(rows) - 1, -1, -1):
                for j in range(len(cols) - 1, -1, -1):
                    best[i, j] = max(best[i + 1, j], best[i, j + 1], w[i, j] + best[i + 1, j + 1] if w[i, j] else 0)
            i = j = 0
            while i < len(rows) and j < len(cols):
                if w[i, j] and best[i, j] == w[i, j] + best[i + 1, j + 1]:
                    pairs[rows[i]] = (cols[j], kind)
                    i, j = i + 1, j + 1
                elif best[i, j] == best[i + 1, j]:
                    i += 1
                else:
                    j += 1
    free = [j for j in range(len(b)) if j not in {j for j, _ in pairs.values()}]
    for i in range(len(a)):
        if i not in pairs and free:
            r, j = max((fits("similar", a[i], b[j]) or fits("contains", a[i], b[j]), -j) for j in free)
            if r:
                pairs[i] = (-j, "moved")
                free.remove(-j)
    return [(i, pairs[i][0], pairs[i][1]) if i in pairs else (i, None, "dropped") for i in range(len(a))] + [(None, j, "added") for j in free]


def rising(spans: Sequence[tuple[int, int]], least: int = 1) -> list[tuple[int, int]]:
    """Spans pushed forward so that none starts before the one before it ends; each keeps at least ``least``."""
    out, at = [], None
    for s, e in spans:
        s = s if at is None else max(s, at)
        e = max(e, s + least)
        out.append((s, e))
        at = e
    return out


def frame_spans(frames: Sequence[tuple[int, Sequence[str]]], share: float = 0.4, most_gap: int = 2, core: int = 8) -> list[dict]:
    """Frames ``(number, terms)`` that show the same board as spans: first and last frame, and the terms' counts.

    A frame joins the span before it if at most ``most_gap`` numbers lie between and its terms overlap the last frame's or
    the span's core by ``share`` of the smaller set, or one holds the other. The core: terms seen twice, else the
    ``core`` most seen. Frames without terms join nothing and start nothing.
    """
    out: list[dict] = []
    for number, terms in sorted(frames, key=lambda f: f[0]):
        own = set(terms)
        if not own:
            continue
        if out and number - out[-1]["last"] <= most_gap + 1:
            span = out[-1]
            often = {t for t, c in span["counts"].items() if c > 1} or {t for t, _ in sorted(span["counts"].items(), key=lambda x: (-x[1], -len(x[0]), x[0]))[:core]}
            if any(o and (len(own & o) >= share * min(len(own), len(o))) for o in (span["seen"], often)):
                span["last"], span["seen"] = number, own
                span["counts"].update(terms)
                continue
        out.append({"first": number, "last": number, "seen": own, "counts": Counter(terms)})
    return [{"first": s["first"], "last": s["last"], "counts": dict(s["counts"])} for s in out]


def weak_groups(weak: Sequence[int], count: int, gap: int = 2, context: int = 2) -> list[tuple[int, int]]:
    """Places of weak rows in groups (at most ``gap`` apart), widened by ``context`` on both sides, as first and last place."""
    out: list[list[int]] = []
    for i in sorted(weak):
        if out and i - out[-1][1] <= gap:
            out[-1][1] = i
        else:
            out.append([i, i])
    return [(max(0, a - context), min(count - 1, z + context)) for a, z in out]


def pick_apart(rows: Sequence[tuple[int, int]], count: int, apart_ms: int = 5_000) -> list[int]:
    """Places of the ``count`` best ``(start_ms, score)`` that lie ``apart_ms`` from each other, in order of time; ties go to the earlier."""
    taken: list[int] = []
    for i in sorted(range(len(rows)), key=lambda i: (-rows[i][1], rows[i][0], i)):
        if len(taken) == count:
            break
        if rows[i][1] > 0 and all(abs(rows[i][0] - rows[j][0]) >= apart_ms for j in taken):
            taken.append(i)
    return sorted(taken, key=lambda i: (rows[i][0], i))


def two_pass(x: np.ndarray, ms: np.ndarray, long_ms: int = 2_000, join: float = 0.7, least: int = 3, assign: float = 0.75) -> np.ndarray:
    """Clusters of vectors: long ones by average linkage, the rest by the nearest centre, -1 where none is near.

    Clusters under ``least`` are dissolved; numbers go by size, of equals by the first member.
    """
    from .segment import average_linkage

    out = np.full(len(x), -1)
    long = np.flatnonzero(ms >= long_ms)
    if len(long) < 2:
        return out
    lab = average_linkage(x[long], join)
    size = Counter(lab.tolist())
    order = sorted((k for k in size if size[k] >= least), key=lambda k: (-size[k], lab.tolist().index(k)))
    for new, k in enumerate(order):
        out[long[lab == k]] = new
    if not order:
        return out
    centres = np.stack([x[out == k].mean(axis=0) for k in range(len(order))])
    unit = lambda v: v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    rest = np.flatnonzero(out < 0)
    far = 1 - unit(x[rest]) @ unit(centres).T
    out[rest] = np.where(far.min(axis=1) <= assign, far.argmin(axis=1), -1) if len(rest) else out[rest]
    return out


def merge_short(cues: Sequence[tuple], least_ms: int = 1_000, most_ms: int = 7_000, most_chars: int = 45, most_lines: int = 2, least_chars: int = 3) -> list[tuple]:
    """Cues under ``least_ms`` or ``least_chars`` joined to the neighbour that makes the shorter whole, until none can be.

    A cue is ``(start, end, text)``, with a fourth field where it may start a turn; none is joined over the start of a turn.
    The one before must make a whole shorter by 0.1 s. The whole keeps to ``most_ms``, ``most_chars`` (spaces and breaks don't
    count) and ``most_lines``; texts join by a line break. The first short cue is joined first; as a join changes nothing
    but its own neighbours, the search goes on one cue before it.
    """
    own = [tuple(c) for c in cues]
    size = lambda t: len(t) - sum(map(t.count, " \n\t"))
    i = 0
    while i < len(own):
        options = []
        if own[i][1] - own[i][0] < least_ms or size(own[i][2]) < least_chars:
            for at, more in ((i - 1, 100), (i, 0)):
                if 0 <= at and at + 1 < len(own) and not (len(own[at + 1]) > 3 and own[at + 1][3]):
                    a, b = own[at], own[at + 1]
                    s, e, text = min(a[0], b[0]), max(a[1], b[1]), f"{a[2]}\n{b[2]}"
                    if e - s <= most_ms and size(text) <= most_chars and text.count("\n") < most_lines:
                        options.append((e - s + more, at, (s, e, text, *a[3:])))
        if options:
            _, at, whole = min(options, key=lambda o: o[0])
            own[at : at + 2] = [whole]
            i = max(0, at - 1)
        else:
            i += 1
    return own
