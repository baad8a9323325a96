"""Cues repaired by the words they were made of: matched to words, joined, divided and widened; regions rebuilt.

One episode's track at a time. Times are whole milliseconds. Words are ``(start, end, text)`` in order; a cue is
``[start, end, text, first word, last word]``.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Sequence

from .retime import letters

Word = tuple[int, int, str]
# What ends a sentence, what parts one, letters of Japanese, and what matching leaves out.
_END = re.compile(r"[。！？!?」』）】]$")
_COMMA = re.compile(r"[、,]$")
_LETTER = re.compile(r"[ぁ-んァ-ン一-龯ー]")
_LOOSE = re.compile(r"\s+")


def _form(text: str) -> str:
    return _LOOSE.sub("", text or "")


def match_words(cues: Sequence[tuple[int, int, str]], words: Sequence[Word], near: int = 120, before_ms: int = 1_000, after_ms: int = 800) -> list[tuple[int, int, str] | None]:
    """For each cue the span of words it says, ``(first, last, how)``, or None; blank cues have none.

    ``near``: the same letters, starting within ``near`` words of where the last cue ended; else ``window``: the same
    letters in a window of time around the cue; else ``time``: the words that overlap it. Of several the one nearest in
    time is taken, a little worse if it lies behind; of equals the first. All words stand in one string, so that a cue's
    letters are found by search and not word by word.
    """
    forms = [_form(w[2]) for w in words]
    whole, at, word_at = "".join(forms), 0, {}
    ends: dict[int, int] = {}
    for i, f in enumerate(forms):
        if f:
            word_at[at] = i
            at += len(f)
            ends[at] = i
    begins, firsts = list(word_at), list(word_at.values())  # both rise
    starts_ms = [w[0] for w in words]
    out: list[tuple[int, int, str] | None] = []
    pos = 0

    def spots(target: str, low: int, high: int) -> list[tuple[int, int]]:
        """Spans of whole words that say ``target`` and begin with a word from ``low`` to ``high``."""
        found = []
        k, z = bisect_left(firsts, low), bisect_left(firsts, high + 1)
        if k >= z:
            return []
        stop = begins[z - 1] + len(target)
        o = whole.find(target, begins[k], stop)
        while o >= 0:
            if o in word_at and o + len(target) in ends:
                found.append((word_at[o], ends[o + len(target)]))
            o = whole.find(target, o + 1, stop)
        return found

    for s, e, text in cues:
        target = _form(text)
        if not target:
            out.append(None)
            continue
        off = lambda x: abs(words[x[0]][0] - s) + abs(words[x[1]][1] - e)  # noqa: B023, E731
        best, how = min(((off(x) + (250 if x[0] < pos else 0), x) for x in spots(target, pos - near, pos + near)), default=None), "near"
        if best is None:
            low, high = bisect_left(starts_ms, s - before_ms), bisect_left(starts_ms, e + after_ms + 1) - 1
            while low and words[low - 1][1] >= s - before_ms:
                low -= 1
            best, how = min(((off(x), x) for x in spots(target, low, high)), default=None), "window"
        if best is None:
            own = [i for i in range(pos, bisect_left(starts_ms, e + after_ms + 1)) if min(words[i][1], e) > max(words[i][0], s) or s - 300 <= words[i][0] <= e + 300]
            best, how = (0, (own[0], own[-1])) if own else None, "time"
        out.append((*best[1], how) if best else None)
        if best:
            pos = best[1][1] + 1
    return out


def _ends(text: str) -> bool:
    return bool(_END.search(text.replace("\n", "")))


def _runs_on(left: str, right: str) -> bool:
    a, b = left.replace("\n", ""), right.replace("\n", "")
    return bool(a and b and not _ends(a) and _LETTER.search(a[-1]) and _LETTER.search(b[0]))


def is_fragment(cues: Sequence, i: int) -> bool:
    t = cues[i][2].replace("\n", "")
    if not t:
        return False
    if len(t) <= 2 or (len(t) <= 4 and not _ends(t)):
        return True
    if i + 1 < len(cues) and _runs_on(t, cues[i + 1][2]) and (len(t) <= 10 or letters(cues[i + 1][2]) <= 10):
        return True
    return bool(i and len(t) <= 10 and _runs_on(cues[i - 1][2], t))


def is_short(cues: Sequence, i: int) -> bool:
    return cues[i][1] - cues[i][0] < 800 or letters(cues[i][2]) <= 4 or is_fragment(cues, i)


def is_long(cue: Sequence) -> bool:
    return cue[1] - cue[0] > 6_500 or letters(cue[2]) > 42


def _of_words(words: Sequence[Word], a: int, z: int) -> list:
    return [words[a][0], words[z][1], "".join(w[2] for w in words[a : z + 1]), a, z]


def split_places(cue: Sequence, words: Sequence[Word], most: int = 5) -> list[int]:
    """Words after which a long cue may be cut, the best first: after marks, at pauses, with parts of 6 to 28 letters."""
    ranked = []
    for k in range(cue[3], cue[4]):
        a, b = _of_words(words, cue[3], k), _of_words(words, k + 1, cue[4])
        sizes = letters(a[2]), letters(b[2])
        if min(a[1] - a[0], b[1] - b[0]) < 300 or min(sizes) < 4:
            continue
        gap = max(0, words[k + 1][0] - words[k][1])
        score = 3 * bool(_END.search(words[k][2])) + (2 if gap >= 180 else gap >= 100) + all(6 <= n <= 28 for n in sizes)
        if score:
            ranked.append((-score, -gap, k))
    return [k for _, _, k in sorted(ranked)[:most]]


def _joinable(cues: Sequence, a: int, z: int) -> bool:
    return cues[z][1] - cues[a][0] <= 6_500 and sum(letters(c[2]) for c in cues[a : z + 1]) <= 48 and all(cues[i + 1][0] - cues[i][1] <= 600 for i in range(a, z))


def options(cues: Sequence, words: Sequence[Word], i: int) -> list[tuple[int, str, int, int, list]]:
    """What may be done about cue ``i``: ``(rank, name, first, last, new cues)``; the least rank is the plain choice.

    A long one is split; a short one joins its run of short ones, the next or the one before, or, if its sentence is
    whole, grows into the silence around it. ``keep`` is always there.
    """
    c = cues[i]
    out = [(999, "keep", i, i, [list(c)])]
    if is_long(c):
        return out + [(n, f"split_{n}", i, i, [_of_words(words, c[3], k), _of_words(words, k + 1, c[4])]) for n, k in enumerate(split_places(c, words), 1)]
    run = i
    while run + 1 < len(cues) and run - i < 3 and is_short(cues, run + 1):
        run += 1
    for rank, name, a, z in ((4, "merge_left", i - 1, i), (2, "merge_right", i, i + 1), (1, "merge_chain", i, run)):
        if 0 <= a < z < len(cues) and _joinable(cues, a, z):
            out.append((rank, name, a, z, [_of_words(words, cues[a][3], cues[z][4])]))
    if _ends(c[2]):
        room = max(0, c[0] - cues[i - 1][1]) if i else 0, max(0, cues[i + 1][0] - c[1]) if i + 1 < len(cues) else 0
        for rank, name, left in ((5, "extend_right", 0), (6, "extend_both", 200)):
            s, e = c[0] - min(left, room[0]), c[1] + min(600, room[1])
            if e - s >= max(1_200, c[1] - c[0] + 200):
                out.append((rank, name, i, i, [[s, e, *c[2:]]]))
    return out


def repair(cues: Sequence[Sequence], words: Sequence[Word], passes: int = 2, choose=min) -> tuple[list[list], list[tuple[int, str]]]:
    """The cues after all repairs, and what was done, ``(pass, name)``.

    Goes through the cues, does what ``choose`` picks of the options about a long or short one, and goes on one cue before
    it. A neighbourhood of five cues that was seen in a pass is left alone, so that no two repairs undo each other for ever.
    A pass that changes nothing is the last.
    """
    own, done = [list(c) for c in cues], []
    for number in range(1, passes + 1):
        seen, i, changed = set(), 0, False
        while i < len(own):
            if not (is_long(own[i]) or is_short(own, i)):
                i += 1
                continue
            state = (i, tuple(map(tuple, own[max(0, i - 2) : i + 3])))
            can = options(own, words, i)
            if state in seen or len(can) == 1:
                i += 1
                continue
            seen.add(state)
            _, name, a, z, new = choose(can)
            own[a : z + 1] = new
            done.append((number, name))
            changed |= name != "keep"
            i = i + 1 if name == "keep" else max(0, a - 1)
        if not changed:
            break
    return own, done


def rebuild(cues: Sequence[tuple[int, int, str]], texts: Sequence[str]) -> list[tuple[int, int, str]]:
    """A region's cues with new borders: ``texts`` that say the same letters, at times by the count of letters.

    Within a cue time runs evenly. Other letters, no texts or an empty one raise an error.
    """
    forms = [_form(t) for t in texts]
    if not texts or not all(forms) or "".join(forms) != "".join(_form(c[2]) for c in cues):
        raise ValueError("the new cues don't say what the region says")
    sizes = [len(_form(c[2])) for c in cues]

    def at(offset: int) -> int:
        for (s, e, _), n in zip(cues, sizes):
            if n and offset <= n:
                return s + max(0, e - s) * offset // n
            offset -= n
        return cues[-1][1]

    out, said = [], 0
    for k, (text, form) in enumerate(zip(texts, forms)):
        s = cues[0][0] if k == 0 else at(said)
        said += len(form)
        out.append((s, cues[-1][1] if k == len(texts) - 1 else at(said), text.rstrip()))
    return out


def rescue(rows: Sequence[tuple[int, int, str]], weak: set[int], words: Sequence[Word]) -> list[tuple[int, int, str]]:
    """Rows whose times are weak, with those of the second alignment's words that say them, counted by characters.

    Words are used up in the rows' order, also by those that aren't weak. A row without a word of any duration keeps its times.
    """
    out, k = [], 0
    for i, (s, e, text) in enumerate(rows):
        need, first = len(text.replace("\n", "")), k
        while k < len(words) and need > 0:
            need -= len(words[k][2].replace("\n", ""))
            k += 1
        timed = [w for w in words[first:k] if w[1] > w[0]]
        if i in weak and timed and timed[-1][1] > timed[0][0]:
            s, e = timed[0][0], timed[-1][1]
        out.append((s, e, text))
    return out


def split_long(s: int, e: int, words: Sequence[Word], most_ms: int = 10_000) -> list[tuple[int, int, str]]:
    """A segment in parts of at most ``most_ms``: each cut lies before the last word that starts within it; two words can't be cut apart from less than one each."""
    out, todo = [], [(s, e, list(words))]
    while todo:
        s, e, own = todo.pop()
        if e - s <= most_ms or len(own) < 2:
            out.append((s, e, "".join(w[2] for w in own).strip()))
            continue
        k = 1
        while k + 1 < len(own) and own[k + 1][0] <= s + most_ms and own[k][0] <= s + most_ms:
            k += 1
        todo += [(own[k][0], e, own[k:]), (s, own[k - 1][1], own[:k])]
    return out


def split_line(cue: tuple[int, int, str], words: Sequence[Word], most_ms: int = 7_000, most_chars: int = 45) -> list[tuple[int, int, str]]:
    """A cue of one line over a limit, cut once after the mark nearest to its middle word: a sentence's, else a comma."""
    if (cue[1] - cue[0] <= most_ms and letters(cue[2]) <= most_chars) or "\n" in cue[2] or len(words) < 2:
        return [cue]
    for mark in (_END, _COMMA):
        places = [k for k, w in enumerate(words[:-1]) if mark.search(w[2])]
        if places:
            k = min(places, key=lambda p: abs(2 * p - len(words)))
            return [tuple(_of_words(words, 0, k)[:3]), tuple(_of_words(words, k + 1, len(words) - 1)[:3])]
    return [cue]


def cap_lead(start: int, end: int, anchor: tuple[int, int], low: int, high: int | None, most_ms: int = 200) -> tuple[int, int]:
    """A cue's time that starts at most ``most_ms`` before its speech and, if there is room, doesn't end before it."""
    top = (lambda x: x) if high is None else (lambda x: min(high, x))
    least = max(low, anchor[0] - most_ms)
    if start < least:
        start, end = least, top(end + least - start)
    if end < anchor[1]:
        end = top(anchor[1])
        start = min(start, end) if end < anchor[1] else start
    return start, end


def merge_hurried(cues: Sequence[tuple[int, int, str]], pause: int = 300, least_ms: int = 300, most_ms: int = 10_000, most_cps: int = 20) -> list[tuple[int, int, str]]:
    """Cues too short or too fast joined to a neighbour within two pauses, until none can be.

    Of both neighbours the one whose whole isn't too fast, then is slowest, then is nearest to 1.8 s; of equals the one before.
    """
    own = [tuple(c) for c in cues]
    fast = lambda c: letters(c[2]) * 1000 / max(1, c[1] - c[0])
    i = 0
    while i < len(own):
        if own[i][1] - own[i][0] >= least_ms and fast(own[i]) <= most_cps:
            i += 1
            continue
        can = []
        for a in (i - 1, i):
            if 0 <= a and a + 1 < len(own) and own[a + 1][0] - own[a][1] <= 2 * pause:
                x, y = own[a], own[a + 1]
                both = (min(x[0], y[0]), max(x[1], y[1]), f"{x[2]}\n{y[2]}".strip())
                if both[1] - both[0] <= most_ms:
                    can.append(((fast(both) > most_cps, fast(both), abs(both[1] - both[0] - 1_800)), a, both))
        if can:
            _, a, both = min(can, key=lambda x: x[0])
            own[a : a + 2] = [both]
            i = max(0, a - 1)  # what lies before is settled, but for the neighbour of the new cue
        else:
            i += 1
    return own


def rewrap(texts: Sequence[str], most: int = 2) -> str | None:
    """Lines as at most ``most``: two are as equal as can be, the first of equals; None if that can't be done."""
    texts = list(texts)
    if len(texts) <= most:
        return "\n".join(texts)
    if most != 2:
        return None
    cuts = []
    for k in range(1, len(texts)):
        a, b = " ".join(texts[:k]).strip(), " ".join(texts[k:]).strip()
        if a and b:
            cuts.append((abs(len(a) - len(b)) + abs(sum(map(len, texts)) - len(a) - len(b)), k, f"{a}\n{b}"))
    return min(cuts)[2] if cuts else None


def merge_micro(cues: Sequence[tuple[int, int, str]], least_ms: int = 500, most_ms: int = 7_000, most_chars: int = 45, most_lines: int = 2) -> list[tuple[int, int, str]]:
    """Cues under ``least_ms`` joined to the neighbour that makes a whole nearest to 1.8 s, of equals the one before, lines wrapped anew."""
    own = [tuple(c) for c in cues]
    i = 0
    while i < len(own):
        can = []
        if own[i][1] - own[i][0] < least_ms:
            for a in (i - 1, i):
                if 0 <= a and a + 1 < len(own):
                    x, y = own[a], own[a + 1]
                    text = rewrap([*x[2].split("\n"), *y[2].split("\n")], most_lines)
                    s, e = min(x[0], y[0]), max(x[1], y[1])
                    if text is not None and e - s <= most_ms and letters(text) <= most_chars:
                        can.append((abs(e - s - 1_800), a, (s, e, text)))
        if can:
            _, a, both = min(can, key=lambda x: x[:2])
            own[a : a + 2] = [both]
            i = max(0, a - 1)
        else:
            i += 1
    return own


# What ends a sentence and what goes on, before a silence.
_CLOSED = re.compile(r"(?:[。？！?!よねかなさぞわだ]|ます|です|ません|ました|でした|った|ない|ある|いる|れる)$")
_OPEN = re.compile(r"(?:[はがをにでとへもの]|けど|から|ので|のに|ても|ながら|たり|って|[てで]|[、,])$")


def boundary_score(text: str) -> int:
    """2 where a text ends a sentence, 0 where it goes on, 1 where neither shows."""
    t = text.rstrip()
    return 2 if _CLOSED.search(t) else 0 if _OPEN.search(t) else 1


def sentence_cuts(gaps: Sequence[tuple[int, int]], speech: Sequence[tuple[int, int, str]], total: int, target: int = 240_000, least: int = 60_000, most: int = 300_000, hard: int = 360_000) -> list[tuple[int, int]]:
    """Chunks that cover 0 to ``total``, cut in the middle of silences that follow the end of a sentence.

    From the end of the last silence the silences of ``least`` to ``most`` on are looked at: the best end of a sentence in
    the ten seconds before wins, of equals the one nearest to ``target``. Where none is, the rest stays, and what is over
    ``hard`` is cut at the last silence that leaves a rest under it, else at the nearest to the target, else at ``hard``.
    """
    ends = sorted((e, s, t) for s, e, t in speech if t and t.strip())
    keys = [x[0] for x in ends]
    mids = [((a + z) // 2, a, z) for a, z in sorted(gaps)]

    def said_before(a: int) -> str:
        k = bisect_left(keys, a + 1) - 1
        return ends[k][2].strip() if k >= 0 and ends[k][1] >= a - 10_000 else ""

    cuts, last = [], 0
    while total - last > most:
        can = [(-boundary_score(said_before(a)), abs(m - last - target), m, z) for m, a, z in mids if last + least < m <= last + most]
        if not can:
            break
        _, _, cut, last = min(can)
        cuts.append(cut)
    out, at = [], 0
    for end in [*cuts, total]:
        while end - at > hard:
            near = [m for m, _, _ in mids if at < m <= at + hard]
            fit = [m for m in near if end - m <= hard]
            cut = max(fit) if fit else min(near, key=lambda m: abs(m - at - target)) if near else at + hard
            out.append((at, cut))
            at = cut
        if end > at:
            out.append((at, end))
            at = end
    return out


def warp(anchors: Sequence[tuple[int, int]], t: float) -> float:
    """A time mapped along the straight lines between anchors, held beyond the first and last."""
    xs = [a for a, _ in anchors]
    k = bisect_left(xs, t)
    if k == 0:
        return anchors[0][1]
    if k == len(anchors):
        return anchors[-1][1]
    (x0, y0), (x1, y1) = anchors[k - 1], anchors[k]
    return y0 + (y1 - y0) * (t - x0) / (x1 - x0)


def text_anchors(a: Sequence[tuple[int, int, str]], b: Sequence[tuple[int, int, str]], band: int = 18, least_chars: int = 6, least: float = 0.74) -> list[tuple[int, int]]:
    """Middles of cues of two tracks that say the same, rising in both, with both starts and both ends.

    A cue of ``least_chars`` looks ``band`` places around its share of the other track. Texts must be ``least`` alike; 0.85
    of that and 0.15 of the nearness in time (an eighth of the length counts as far) decide. Twice the middle is kept, as whole numbers.
    """
    from difflib import SequenceMatcher

    drop = re.compile(r"[\s　、。！？?!…,.，「」『』（）()【】\[\]・:：\-ー/]+")
    x, y = ([drop.sub("", c[2] or "") for c in side] for side in (a, b))
    if not a or not b:
        return []
    ta, tb = max(1, a[-1][1]), max(1, b[-1][1])
    mid = lambda c: c[0] + c[1]
    out, last = [(0, 0)], -1
    for i, text in enumerate(x):
        if len(text) < least_chars:
            continue
        near = round(i / max(1, len(a) - 1) * max(0, len(b) - 1))
        best = (0.0, None)
        for j in range(max(last + 1, near - band), min(len(b) - 1, near + band) + 1):
            if len(y[j]) < least_chars or 2 * min(len(text), len(y[j])) < least * (len(text) + len(y[j])):
                continue
            r = SequenceMatcher(None, text, y[j]).ratio()
            if r >= least:
                score = 0.85 * r + 0.15 * (1 - min(8 * abs(mid(a[i]) / ta - mid(b[j]) / tb) / 2, 1))
                best = max(best, (score, j), key=lambda s: s[0])
        j = best[1]
        if j is not None and mid(a[i]) > out[-1][0] and mid(b[j]) > out[-1][1]:
            out.append((mid(a[i]), mid(b[j])))
            last = j
    return [*out, (2 * a[-1][1], 2 * b[-1][1])]


def draft(target: Sequence[tuple[int, int, str]], reference: Sequence[tuple[int, int, str]], anchors: Sequence[tuple[int, int]]) -> list[tuple[int, list[int], bool]]:
    """For each target cue the reference cues that fall on it, and whether none did and the nearest stands in.

    ``anchors`` as of :func:`text_anchors` from target to reference. A reference cue falls on the target cue that holds
    its mapped middle, else on that before or after with the nearer middle.
    """
    back = [(y, x) for x, y in anchors]
    mapped = [warp(back, r[0] + r[1]) for r in reference]
    starts = [2 * t[0] for t in target]
    own: list[list[int]] = [[] for _ in target]
    for j, m in enumerate(mapped):
        k = max(0, bisect_left(starts, m + 1e-9) - 1)
        if m >= 2 * target[k][1] and k + 1 < len(target) and abs(m - sum(target[k][:2])) > abs(m - sum(target[k + 1][:2])):
            k += 1
        own[k].append(j)
    order = sorted(range(len(mapped)), key=lambda j: (mapped[j], j))
    at = [mapped[j] for j in order]
    out = []
    for k, got in enumerate(own):
        if got or not at:
            out.append((k, got, False))
            continue
        m = sum(target[k][:2])
        p = bisect_left(at, m)
        out.append((k, [min((order[q] for q in (p - 1, p) if 0 <= q < len(at)), key=lambda j: (abs(mapped[j] - m), j))], True))
    return out


def retimed(reference: Sequence[tuple[int, int, str]], anchors: Sequence[tuple[int, int]], end: int) -> list[tuple[int, int, str]]:
    """Reference cues at the target's times: mapped, never before the cue before them ends, 10 ms at least, none over ``end``."""
    back, out, before = [(y, x) for x, y in anchors], [], 0
    for s, e, text in reference:
        a = max(int(warp(back, 2 * s)) // 2, before)
        before = min(max(int(warp(back, 2 * e)) // 2, a + 10), end)
        out.append((a, before, text))
    return out
