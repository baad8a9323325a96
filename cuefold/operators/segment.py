"""Segmentation whose next step depends on the last: one group of rows at a time, in whole milliseconds.

Each function takes rows sorted in order and returns new ones; :func:`by_group` runs one over the groups of a table. A
group is one episode's track, about a thousand rows. Times are integers, so equal inputs cut alike on every machine.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame


def by_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], f: Callable[[pd.DataFrame], pd.DataFrame], columns: str) -> DataFrame:
    """``f`` over each group's rows in ``order``; its result (``columns``) with the ``keys`` before it."""
    ddl = ", ".join([f"`{x.name}` {x.dataType.simpleString()}" for x in df.select(*keys).schema] + [columns])

    def one(key, pdf: pd.DataFrame) -> pd.DataFrame:
        out = f(pdf.sort_values(list(order), kind="stable").reset_index(drop=True))
        for k, v in reversed(list(zip(keys, key))):
            out.insert(0, k, v)
        return out

    return df.groupBy(*keys).applyInPandas(one, ddl)


def batches(most_cues: int = 12, most_ms: int = 45_000) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Cues in batches of at most ``most_cues`` that span at most ``most_ms``; a longer cue is a batch of its own."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        s, e = p["s"].to_numpy(), p["e"].to_numpy()
        rows, a = [], 0
        while a < len(p):
            z = a + 1
            while z < min(len(p), a + most_cues) and (most_ms <= 0 or e[z] - s[a] <= most_ms):
                z += 1
            rows.append((len(rows), a + 1, z, int(s[a]), int(e[z - 1])))
            a = z
        return pd.DataFrame(rows, columns=["batch", "first_cue", "last_cue", "start_ms", "end_ms"])

    return run


BATCH_COLUMNS = "batch int, first_cue int, last_cue int, start_ms long, end_ms long"


def pack_speech(target: int = 18_000, most: int = 25_000, most_gap: int = 1_500, least: int = 10_000, rest: int = 300) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Speech segments packed to chunks of about ``target``.

    A chunk of ``least`` or more ends before a gap over ``most_gap``, before what would take it over ``most``, and, once it
    has ``target``, at the first gap over ``rest``. A segment over ``most`` stands alone, in equal parts.
    """

    def run(p: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple[int, int]] = []
        open_: list[int] | None = None
        for s, e in zip(p["s"].tolist(), p["e"].tolist()):
            if e - s > most:
                out += [tuple(open_)] if open_ else []
                open_, n = None, (e - s) // target + 1
                cuts = [s + (e - s) * i // n for i in range(n + 1)]
                out += zip(cuts, cuts[1:])
                continue
            if open_:
                size, gap = open_[1] - open_[0], s - open_[1]
                full = gap > most_gap or e - open_[0] > most or (size >= target and gap > rest)
                if size < least or not full:
                    open_[1] = e
                    continue
                out.append(tuple(open_))
            open_ = [s, e]
        out += [tuple(open_)] if open_ else []
        return pd.DataFrame([(i, int(a), int(b)) for i, (a, b) in enumerate(out)], columns=["chunk", "start_ms", "end_ms"])

    return run


SPAN_COLUMNS = "chunk int, start_ms long, end_ms long"


def cover(total: int, target: int = 60_000, most: int = 90_000, gap: int = 2_000, short_gap: int = 750) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Chunks that cover 0 to ``total`` (or the last end, if later), cut in the middle of silences.

    Of the silences of ``gap`` or more before ``most`` and within 40 % of ``target`` from it the nearest is taken, the
    first of equals. Without one the last silence of ``short_gap`` or more but under ``gap``; without that the cut is
    forced at ``most``. A rest of up to 1.3 targets stays whole if it fits into ``most``.
    """

    def run(p: pd.DataFrame) -> pd.DataFrame:
        end = max(total, int(p["e"].max()) if len(p) else 0)
        s, e = p["s"].to_numpy(), p["e"].to_numpy()
        size, mid = s[1:] - e[:-1], (s[1:] + e[:-1]) // 2
        out, at = [], 0
        while at < end:
            want, limit = at + target, at + most
            if want * 10 >= end * 10 - target * 3:
                cut = end if end - at <= most else limit
            else:
                reach = (mid > at) & (mid <= limit)
                far = np.abs(mid - want)
                good = np.flatnonzero(reach & (size >= gap) & (far * 10 <= target * 4))
                if len(good):
                    cut = int(mid[good[np.argmin(far[good])]])
                else:
                    fair = np.flatnonzero(reach & (size >= min(short_gap, gap)) & (size < gap))
                    cut = int(mid[fair].max()) if len(fair) else limit
            cut = min(cut, end)
            out.append((len(out), at, cut))
            at = cut
        return pd.DataFrame(out, columns=["chunk", "start_ms", "end_ms"])

    return run


def reflow_rows(s: np.ndarray, e: np.ndarray, words: Sequence[str], pause: int = 300, most: int = 10_000, least: int = 300) -> list[tuple[int, int, int, str, int]]:
    """Cues of words with duration, as :func:`reflow` says: ``cue, start_ms, end_ms, text, words``."""
    breaks = [0, *(np.flatnonzero(s[1:] - e[:-1] >= pause) + 1).tolist(), len(s)]
    groups = [[a, b] for a, b in zip(breaks, breaks[1:]) if b > a]
    merged: list[list[int]] = []
    carry: int | None = None
    for i, (a, b) in enumerate(groups):
        a = carry if carry is not None else a
        carry = None
        if e[b - 1] - s[a] < least and i + 1 < len(groups) and s[b] - e[b - 1] < 2 * pause:
            carry = a
        else:
            merged.append([a, b])
    out = []
    todo = merged[::-1]
    while todo:
        a, b = todo.pop()
        if e[b - 1] - s[a] <= most or b - a == 1:
            text = "".join(words[a:b]).strip()
            if text:
                out.append((len(out) + 1, int(s[a]), int(e[b - 1]), text, b - a))
            continue
        inner = s[a + 1 : b] - e[a : b - 1]
        k = int(inner.argmax())
        if inner[k] >= 10:
            cut = a + 1 + k
        else:
            over = np.flatnonzero(e[a:b] - s[a] > most)
            cut = a + max(1, int(over[0]))
        todo += [[cut, b], [a, cut]]
    return out


def reflow(pause: int = 300, most: int = 10_000, least: int = 300) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Words (``s, e, word``) as cues at natural pauses.

    Words without duration are left out. A pause of ``pause`` or more ends a group; a group under ``least`` joins the next
    if less than two pauses lie between; a group over ``most`` is halved at its longest inner gap, the first of equals, or,
    where no gap has 10 ms, cut before the word that would take it over ``most``.
    """

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p[p["e"] > p["s"]].reset_index(drop=True)
        out = reflow_rows(p["s"].to_numpy(), p["e"].to_numpy(), [w or "" for w in p["word"]], pause, most, least)
        return pd.DataFrame(out, columns=["cue", "start_ms", "end_ms", "text", "words"])

    return run


CUE_COLUMNS = "cue int, start_ms long, end_ms long, text string, words int"


def pack_lines(most_ms: int = 7_000, most_chars: int = 45, most_lines: int = 2) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Timed lines (``s, e, text, turn``) as cues of at most ``most_lines``.

    A cue ends before a line that starts a turn, would take it over ``most_ms`` or ``most_chars``, or comes after a gap of
    over half of ``most_ms``. Lines that start a turn are shown with a dash. A cue starts where the one before it ends, if
    it started before. Blank lines and lines without duration are left out.
    """

    def run(p: pd.DataFrame) -> pd.DataFrame:
        p = p[(p["e"] > p["s"]) & p["text"].fillna("").str.strip().ne("")]
        cues: list[list] = []
        for s, e, text, turn in zip(p["s"].tolist(), p["e"].tolist(), p["text"].str.strip(), p["turn"].eq(True)):
            shown = f"- {text}" if turn else text
            if cues:
                a, b, lines, chars = cues[-1]
                if not (turn or e - a > most_ms or chars + len(text) > most_chars or len(lines) >= most_lines or 2 * (s - b) > most_ms):
                    cues[-1] = [a, e, [*lines, shown], chars + len(text)]
                    continue
            cues.append([s, e, [shown], len(text)])
        out, before = [], None
        for i, (s, e, lines, _) in enumerate(cues, 1):
            s = s if before is None else max(s, before)
            before = e
            out.append((i, int(s), int(e), "\n".join(lines), len(lines)))
        return pd.DataFrame(out, columns=["cue", "start_ms", "end_ms", "text", "words"])

    return run


def near_first(within: int = 50) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Rows (``s``) in clusters of at most ``within`` from the cluster's first; the clusters' size and span."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        out: list[list[int]] = []
        for s in p["s"].tolist():
            if out and s - out[-1][1] <= within:
                out[-1][2], out[-1][3] = s, out[-1][3] + 1
            else:
                out.append([len(out), s, s, 1])
        return pd.DataFrame(out, columns=["cluster", "first_ms", "last_ms", "size"])

    return run


CLUSTER_COLUMNS = "cluster int, first_ms long, last_ms long, size int"


def merge_same(most_gap: int = 1_000, most: int = 30_000) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Neighbours (``s, e, who``) of one speaker as one, up to a gap of ``most_gap`` and a length of ``most``."""

    def run(p: pd.DataFrame) -> pd.DataFrame:
        out: list[list] = []
        for s, e, who in zip(p["s"].tolist(), p["e"].tolist(), p["who"]):
            if out and out[-1][2] == who and s - out[-1][1] <= most_gap and e - out[-1][0] <= most:
                out[-1][1], out[-1][3] = max(e, out[-1][1]), out[-1][3] + 1
            else:
                out.append([s, e, who, 1])
        return pd.DataFrame(out, columns=["start_ms", "end_ms", "who", "parts"])

    return run


MERGED_COLUMNS = "start_ms long, end_ms long, who string, parts int"


def average_linkage(x: np.ndarray, limit: float) -> np.ndarray:
    """Cluster numbers by average linkage of cosine distances; clusters at a distance under ``limit`` are joined, the closest first."""
    n = len(x)
    if not n:
        return np.zeros(0, int)
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
    d = 1 - unit @ unit.T
    np.fill_diagonal(d, np.inf)
    size, label, alive = np.ones(n), np.arange(n), np.ones(n, bool)
    while alive.sum() > 1:
        i, j = np.unravel_index(np.argmin(np.where(alive[:, None] & alive[None, :], d, np.inf)), d.shape)
        if d[i, j] >= limit:
            break
        i, j = min(i, j), max(i, j)
        row = (d[i] * size[i] + d[j] * size[j]) / (size[i] + size[j])
        d[i], d[:, i] = row, row
        d[i, i] = np.inf
        size[i] += size[j]
        alive[j] = False
        label[label == j] = i
    return label
