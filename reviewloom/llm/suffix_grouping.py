"""Suffix array of an integer sequence by grouping, in linear time.

Suffixes with the same Lyndon prefix (the longest Lyndon word they begin with) form a group. Groups are processed in descending order. The
members of a group tell their previous smaller suffixes, found along pointers that earlier groups left, that their Lyndon prefixes go on with this one;
those suffixes move up, behind the rest of their own groups, the further the more often the prefix follows. Then the groups are emitted in
ascending order: a suffix is its Lyndon prefix and the next smaller suffix, so each emitted suffix puts the ones before it, along the same pointers, at
the next free places of their groups. Nothing is renamed and no shorter sequence is sorted.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Start positions of the suffixes in order; the empty suffix is left out. A suffix that is a prefix of another comes first."""
    n = len(symbols)
    if not n:
        return np.zeros(0, np.int64)
    by_symbol = np.argsort(symbols, kind="stable")
    sorted_symbols = symbols[by_symbol]
    begins = np.concatenate([[True], sorted_symbols[1:] != sorted_symbols[:-1]])
    group_begin = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    of = np.empty(n, np.int64)
    of[by_symbol] = group_begin
    before, group_of, members = _grouped(n, of.tolist(), by_symbol.tolist(), group_begin)
    return np.array(_emitted(n, before, group_of), np.int64)


def _grouped(n: int, of: list[int], order: list[int], group_begin: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Previous smaller suffix and group (its first place) of each suffix."""
    size = [0] * n
    for begin, count in zip(*np.unique(group_begin, return_counts=True), strict=True):
        size[begin] = int(count)
    place = [0] * n
    for k, i in enumerate(order):
        place[i] = k
    before = [-1] * n
    end = n
    while end:
        group = of[order[end - 1]]
        members = order[group:end]
        end = group
        if len(members) > 1:
            members.sort()
        follows: list[int] = []
        for i in members:
            p = i - 1
            while p >= 0 and of[p] >= group:
                p = before[p]
            before[i] = p
            if p >= 0:
                follows.append(p)
        if not follows:
            continue
        if len(follows) == 1:
            moves = {of[follows[0]]: [(1, follows)]}
        else:
            times = Counter(follows)
            by_group: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
            for p, count in times.items():
                by_group[of[p]][count].append(p)
            moves = {old: sorted(parts.items(), reverse=True) for old, parts in by_group.items()}
        for old, parts in moves.items():
            rest = size[old]
            for _, moved in parts:
                if len(moved) == rest:
                    # the whole group goes on alike and stays where it is
                    size[old] = rest
                    rest = 0
                    for p in moved:
                        of[p] = old
                    break
                for p in moved:
                    rest -= 1
                    other, at = order[rest + old], place[p]
                    order[at], order[rest + old] = other, p
                    place[other], place[p] = at, rest + old
                first = old + rest
                for p in moved:
                    of[p] = first
                size[first] = len(moved)
            if rest:
                size[old] = rest
    return before, of, order


def _emitted(n: int, before: list[int], of: list[int]) -> list[int]:
    out = [-1] * n
    free = list(range(n))
    placed = [False] * n

    def put(j: int) -> None:
        while j >= 0 and not placed[j]:
            group = of[j]
            at = free[group]
            out[at] = j
            free[group] = at + 1
            placed[j] = True
            j = before[j]

    put(n - 1)
    for r in range(n):
        put(out[r] - 1)
    return out
