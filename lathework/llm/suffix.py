"""Suffix arrays by Larsson-Sadakane refinement and longest common prefixes after Kasai, as array passes."""

from __future__ import annotations

import numpy as np


def pack(text: np.ndarray) -> tuple[np.ndarray, int]:
    """First sort keys of a text of bytes: the next 7 bytes of each suffix, each one more than its value, 0 past the end."""
    n = len(text)
    wide = np.zeros(n + 7, np.uint64)
    wide[:n] = text
    wide[:n] += np.uint64(1)
    key = np.zeros(n, np.uint64)
    for k in range(7):
        key = key * np.uint64(257) + wide[k : k + n]
    return key, 7


def suffix_array(key: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in order, from the order ``key`` by their first ``depth`` symbols.

    Each round doubles the depth and sorts again only the groups that are still equal, until none is left.
    """
    n = len(key)
    order = np.argsort(key, kind="stable")
    if n < 2:
        return order
    new = np.append(True, key[order][1:] != key[order][:-1])
    group = np.flatnonzero(new)[np.cumsum(new) - 1]
    rank = np.empty(n, np.int64)
    rank[order] = group
    size = np.diff(np.append(np.flatnonzero(new), n))
    open_ = np.flatnonzero(np.repeat(size > 1, size))
    while len(open_):
        s = order[open_]
        nxt = s + depth
        second = np.where(nxt < n, rank[np.minimum(nxt, n - 1)] + 1, 0)
        both = (rank[s] << 32) | second
        by = np.argsort(both, kind="stable")
        s, both = s[by], both[by]
        order[open_] = s
        new = np.append(True, both[1:] != both[:-1])
        at = np.flatnonzero(new)
        rank[s] = open_[at][np.cumsum(new) - 1]
        size = np.diff(np.append(at, len(s)))
        open_ = open_[np.repeat(size > 1, size)]
        depth *= 2
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix of each suffix in ``order`` with the one before it.

    After Kasai, the prefix at text position i + 1 is at least that at i less one. Only positions whose preceding
    symbols differ are compared, all at once and seven bytes a step; the rest follow by a running maximum.
    """
    n = len(text)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    here = np.arange(n)
    prior = np.where((here > 0) & (before > 0), text[here - 1] != text[before - 1], True)
    length = np.zeros(n, np.int64)
    todo = np.flatnonzero(prior & (before >= 0))
    key, step = pack(text)
    for key, step in ((key, step), (text, 1)):
        left = todo
        while len(left):
            a, b = left + length[left], before[left] + length[left]
            same = np.maximum(a, b) < n
            same[same] = key[a[same]] == key[b[same]]
            left = left[same]
            length[left] += step
    held = np.maximum.accumulate(np.where(prior, length + here, 0)) - here
    return np.where(before >= 0, np.maximum(held, 0), 0)[order]
