"""Suffix order by linear grouping: first groups of equal Lyndon prefixes, then the order within them.

The Lyndon prefix of a suffix runs up to the next smaller suffix. Phase one puts the suffixes into groups by it without
comparing strings: it begins with groups by first byte and goes through them from the highest down. Each member points to
its previous smaller suffix, the nearest one to its left in a lower group; such a suffix's prefix continues with the prefix of the
group at hand, so all that are pointed to equally often move together to a new group right above their own.

Phase two goes through the order from the least suffix up. Each suffix that is reached places the one before it, and along
the pointers all whose Lyndon prefix ends there, at the next free place of their group. Nothing is sorted or renamed again.
"""

from __future__ import annotations


def _groups(text: bytes) -> tuple[list[int], list[int]]:
    """First place of each suffix's group in the order, and each suffix's previous smaller suffix (-1: none)."""
    n = len(text)
    order = sorted(range(n), key=text.__getitem__)
    place = [0] * n
    group = [0] * n
    size: dict[int, int] = {}
    first = 0
    for k, suffix in enumerate(order):
        if k and text[suffix] != text[order[k - 1]]:
            first = k
        place[suffix] = k
        group[suffix] = first
        size[first] = k - first + 1
    before = [-1] * n
    end = n
    while end:
        now = group[order[end - 1]]
        pointed: dict[int, int] = {}
        for suffix in sorted(order[now:end]) if end - now > 1 else order[now:end]:
            smaller = suffix - 1
            while smaller >= 0 and group[smaller] >= now:
                smaller = before[smaller]
            before[suffix] = smaller
            if smaller >= 0:
                pointed[smaller] = pointed.get(smaller, 0) + 1
        end = now
        moving: dict[tuple[int, int], list[int]] = {}
        for suffix, times in pointed.items():
            moving.setdefault((-times, group[suffix]), []).append(suffix)
        for _, own in sorted(moving) if len(moving) > 1 else moving:
            # those pointed to most often move first, so that they come to stand highest
            move = moving[_, own]
            if len(move) == size[own]:
                continue
            to = own + size[own]
            for suffix in move:
                to -= 1
                other, hole = order[to], place[suffix]
                order[hole], place[other] = other, hole
                order[to], place[suffix] = suffix, to
            size[own] -= len(move)
            size[to] = len(move)
            for suffix in move:
                group[suffix] = to
    return group, before


def suffix_order(text: bytes) -> list[int]:
    """Starts of all suffixes in ascending order; a suffix comes before those that it begins."""
    n = len(text)
    group, before = _groups(text)
    free = list(range(n))  # next free place of the group that begins here
    order = [0] * n
    done = bytearray(n)
    at, last = -1, n
    while at < n:
        suffix = last - 1
        while suffix >= 0 and not done[suffix]:
            to = free[group[suffix]]
            free[group[suffix]] = to + 1
            order[to] = suffix
            done[suffix] = 1
            suffix = before[suffix]
        at += 1
        if at < n:
            last = order[at]
    return order
