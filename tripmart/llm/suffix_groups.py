"""Suffix arrays by linear grouping, and repeated windows of short texts found with them."""

from __future__ import annotations

import numpy as np


def suffix_array(s: list[int]) -> list[int]:
    """Suffix array of a string of numbers whose last one is smaller than all others.

    First pass: suffixes are grouped by their first symbol. Groups are taken in descending
    order; each suffix of the group points to the nearest one before it in a lower group. Those
    pointed at leave their group upwards, further the more pointers they get, so that in the end
    a group holds the suffixes with one and the same longest Lyndon prefix.
    Second pass: from the smallest suffix on, the suffix before each placed one, and along the
    pointers those before that, take the next free place of their groups.
    """
    n = len(s)
    order = sorted(range(n), key=s.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    start = 0
    for at, i in enumerate(order):
        if s[i] != s[order[start]]:
            start = at
        place[i] = at
        group[i] = start
        size[start] += 1
    before = [-1] * n
    pointers = [0] * n
    end = n
    while end > 0:
        first = group[order[end - 1]]
        found: list[int] = []
        for i in sorted(order[first:end]) if end - first > 1 else order[first:end]:
            j = i - 1
            while j >= 0 and group[j] >= first:
                j = before[j]
            before[i] = j
            if j >= 0:
                if not pointers[j]:
                    found.append(j)
                pointers[j] += 1
        end = first
        if not found:
            continue
        by_count: dict[int, list[int]] = {}
        for j in found:
            by_count.setdefault(pointers[j], []).append(j)
            pointers[j] = 0
        for count in sorted(by_count, reverse=True):
            moved: dict[int, int] = {}
            for j in by_count[count]:
                g = group[j]
                size[g] -= 1
                last = g + size[g]
                other, at = order[last], place[j]
                order[at], place[other] = other, at
                order[last], place[j] = j, last
                moved[g] = moved.get(g, 0) + 1
            for j in by_count[count]:
                g = group[j]
                if size[g]:
                    group[j] = g + size[g]
            for g, k in moved.items():
                size[g + size[g]] = k
    out, free, placed = [0] * n, list(range(n)), [False] * n
    out[0] = n - 1
    placed[n - 1] = True
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = before[j]
    return out


GRAM = 8
SPACING = 16
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _common(buffer: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Length of the common prefix at two places each, up to a limit."""
    words = np.ndarray((len(buffer) - 7,), "<u8", buffer.data, 0, (1,))
    out, left, step = limit.copy(), np.arange(len(a)), 0
    while len(left):
        left = left[limit[left] > step]
        apart = words[a[left] + step] ^ words[b[left] + step]
        stop = apart != 0
        low = apart[stop] & (~apart[stop] + np.uint64(1))
        out[left[stop]] = np.minimum(step + (np.bitwise_count(low - np.uint64(1)).astype(np.int64) >> 3), limit[left[stop]])
        left, step = left[~stop], step + 8
    return out


def repeated_windows(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For every text, which of its windows of ``length`` bytes occur at another place of the
    texts: an array of booleans, one for each start.

    Places whose next ``GRAM`` bytes hash to a multiple of ``SPACING`` cut the texts into symbols.
    A symbol reaches ``GRAM`` bytes into the next, so none is the beginning of another and the order
    of suffixes of symbols is that of their bytes. The suffix array over symbols, with common
    prefixes in bytes, covers the windows that start at a cut. A window that starts ``d`` bytes before
    one is told by these bytes and by the suffixes that share ``length - d`` bytes with the cut's.
    """
    starts = np.cumsum([0] + [len(t) + 1 for t in texts])
    buffer = np.frombuffer(b"\0".join(texts) + bytes(length + 16), np.uint8)
    total = int(starts[-1])
    marked = np.zeros(total, bool)
    windows = np.ndarray((total,), "<u8", buffer.data, 0, (1,))
    cut = (((windows + np.uint64(1)) * MULTIPLIER) >> np.uint64(64 - SPACING.bit_length() + 1)) == 0
    text_of = np.repeat(np.arange(len(texts)), np.diff(starts))
    end_of = starts[1:][text_of] - 1
    places = np.arange(total)
    cut &= places + GRAM <= end_of
    anchor = np.nonzero(cut)[0]
    # Windows without a cut near their start are compared as they are.
    valid = places + length <= end_of
    nearest = np.full(total, total)
    nearest[anchor] = anchor
    nearest = np.minimum.accumulate(nearest[::-1])[::-1]
    far = valid & (nearest - places > length // 2)
    if far.any():
        data, seen = buffer.tobytes(), {}
        for p in np.nonzero(far)[0].tolist():
            seen.setdefault(data[p : p + length], []).append(p)
        for same in seen.values():
            if len(same) > 1:
                marked[same] = True
    if len(anchor):
        data = buffer.tobytes()
        ends = end_of[anchor]
        follow = np.append(anchor[1:], total)
        last = (follow >= ends) | (np.append(text_of[anchor[1:]], -1) != text_of[anchor])
        stop = np.where(last, ends, follow + GRAM)
        symbols = [data[a:b] for a, b in zip(anchor.tolist(), stop.tolist())]
        number = {x: i for i, x in enumerate(sorted(set(symbols)), start=2)}
        string, at = [], []
        for i, (x, closes) in enumerate(zip(symbols, last.tolist())):
            at.append(len(string))
            string.append(number[x])
            if closes:
                string.append(1)
        string.append(0)
        back = np.full(len(string), -1)
        back[at] = np.arange(len(anchor))
        order = back[np.array(suffix_array(string))]
        order = order[order >= 0]
        near = anchor[order]
        room = np.minimum(ends[order], length + near) - near
        common = np.concatenate([[0], _common(buffer, near[:-1], near[1:], np.minimum(room[:-1], room[1:]))])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        # Bytes free before each cut: back to the cut before it or the start of the text.
        lead = anchor - np.maximum(np.concatenate([[-1], anchor[:-1]]) + 1, starts[text_of[anchor]])
        left = np.zeros(len(anchor), np.uint64)
        active = np.arange(len(anchor))
        for d in range(0, int(min(lead.max(), length // 2)) + 1):
            if d:
                active = active[lead[active] >= d]
                left[active] = (left[active] + buffer[anchor[active] - d] + np.uint64(1)) * MULTIPLIER
                left[active] ^= left[active] >> np.uint64(31)
            use = active[anchor[active] - d + length <= ends[active]]
            if len(use):
                group = np.cumsum(common < length - d)[rank[use]]
                key = (group.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ left[use]
                _, place, count = np.unique(key, return_inverse=True, return_counts=True)
                marked[anchor[use] - d] = count[place] > 1
    return [marked[a : max(a, b - length)] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
