"""Suffix arrays by linear grouping: no suffix is ever renamed or sorted recursively."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order; `symbols` are numbers above 0, and an end is understood.

    Suffixes are first grouped by symbol. Groups are then taken from the greatest down: every member
    points to the nearest earlier suffix of a smaller group, and suffixes pointed to equally often
    leave their own group together for a new one just above it, so that in the end a group holds
    the suffixes of one Lyndon prefix, in the order of these prefixes. Going through the array
    from the end's own suffix on, each placed suffix then hands the first free place of their
    groups to the suffixes on the chain of pointers before it.
    """
    text = np.append(symbols, 0)
    n = len(text)
    order = np.argsort(text, kind="stable")
    ranked = text[order]
    heads = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    group = np.empty(n, np.int64)
    group[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, n)))
    at = np.empty(n, np.int64)
    at[order] = np.arange(n)
    slots, place, group = order.tolist(), at.tolist(), group.tolist()
    start, end = heads.tolist(), np.append(heads[1:], n).tolist()
    smaller = [-1] * n

    top = n
    while top:
        low = start[group[slots[top - 1]]]
        pointed: dict[int, int] = {}
        for i in sorted(slots[low:top]) if top - low > 1 else slots[low:top]:
            p = i - 1
            while p >= 0 and start[group[p]] >= low:
                p = smaller[p]
            smaller[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        top = low
        by_count: dict[int, list[int]] = {}
        for p, count in pointed.items():
            by_count.setdefault(count, []).append(p)
        for count in sorted(by_count, reverse=True):
            raised: dict[int, int] = {}
            for p in by_count[count]:
                old = group[p]
                new = raised.get(old)
                if new is None:
                    raised[old] = new = len(start)
                    start.append(end[old])
                    end.append(end[old])
                # the last place of the old group becomes the first of the new one
                last = end[old] - 1
                other, mine = slots[last], place[p]
                slots[mine], place[other] = other, mine
                slots[last], place[p] = p, last
                end[old] = start[new] = last
                group[p] = new

    out = [n - 1] * n
    placed = [False] * n
    placed[n - 1] = True
    for k in range(n):
        p = out[k] - 1
        while p >= 0 and not placed[p]:
            free = start[group[p]]
            start[group[p]] = free + 1
            out[free] = p
            placed[p] = True
            p = smaller[p]
    return np.array(out[1:], np.int64)
