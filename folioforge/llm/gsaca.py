"""Suffix sorting by linear grouping (after U. Baier, "Linear-time suffix sorting", CPM 2016).

Phase one sorts suffixes into groups by their Lyndon prefixes. Groups are processed in descending order:
each suffix of the group gets a pointer to the previous suffix of a smaller group, and the suffixes so pointed
at move to new groups right after their old ones, those with more pointers further up. Phase two walks the
groups in ascending order and emits each group's suffixes by the same pointers. Nothing is renamed
and nothing recurses.
"""

from __future__ import annotations


def suffix_array(text: list[int]) -> list[int]:
    """Starts of the suffixes of ``text`` (positive integers) in ascending order."""
    t = [*text, 0]
    n = len(t)
    order = sorted(range(n), key=t.__getitem__)
    place = [0] * n  # of each suffix in ``order``
    group = [0] * n  # start of each suffix's group in ``order``
    size = [0] * n  # of the group that starts here
    start = 0
    last = t[order[0]]
    for k, s in enumerate(order):
        place[s] = k
        c = t[s]
        if c != last:
            size[start] = k - start
            start, last = k, c
        group[s] = start
    size[start] = n - start
    before = [-1] * n  # previous suffix of a smaller group
    end = n
    while end:
        start = group[order[end - 1]]
        if end - start == 1:  # one suffix: one pointer, one move
            i = order[start]
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[i] = p
            if p >= 0:
                g = group[p]
                m = size[g] - 1
                if m:
                    to, at = g + m, place[p]
                    other = order[to]
                    order[at], place[other] = other, at
                    order[to], place[p] = p, to
                    size[g], size[to] = m, 1
                    group[p] = to
            end = start
            continue
        own = order[start:end]
        own.sort()
        pointed: dict[int, int] = {}
        for i in own:
            p = i - 1
            while p >= 0 and group[p] >= start:
                p = before[p]
            before[i] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + 1
        levels: dict[int, dict[int, list[int]]] = {}
        for p, times in pointed.items():
            levels.setdefault(times, {}).setdefault(group[p], []).append(p)
        for times in sorted(levels, reverse=True) if len(levels) > 1 else levels:
            for g, moved in levels[times].items():
                m = size[g] - len(moved)
                if not m:
                    continue  # the entire group moves: it stays as it is
                to = g + m
                size[g], size[to] = m, len(moved)
                for k, p in enumerate(moved, to):
                    other, at = order[k], place[p]
                    order[at], place[other] = other, at
                    order[k], place[p] = p, k
                for p in moved:
                    group[p] = to
        end = start
    front = group[:]  # by group start: the next free place; read through the group's start only
    for k in range(n):
        front[k] = k
    out = [0] * n
    done = bytearray(n)
    out[0] = n - 1
    done[n - 1] = 1
    for k in range(n):
        s = out[k] - 1
        while s >= 0 and not done[s]:
            g = group[s]
            at = front[g]
            out[at] = s
            front[g] = at + 1
            done[s] = 1
            s = before[s]
    return out[1:]
