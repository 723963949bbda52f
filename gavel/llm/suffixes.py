"""Suffix arrays and common prefixes in numpy, for one shard at a time."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray, span: int = 1) -> np.ndarray:
    """The suffixes of a sequence in order, by Larsson-Sadakane refinement.

    `symbols[i]` may stand for the `span` symbols from i on (bytes packed into one number, say).  Suffixes start in
    groups of equal first entry.  Each round sorts only the groups that still hold two or more suffixes, by the
    group of the suffix h places on, and doubles h, until no group is left: common prefixes need the true order.  A suffix
    that is the start of another comes first."""
    n = len(symbols)
    if n == 0:
        return np.zeros(0, np.int64)
    order = np.argsort(symbols, kind="stable")
    head = np.empty(n, bool)
    head[0] = True
    head[1:] = symbols[order[1:]] != symbols[order[:-1]]
    starts = np.flatnonzero(head)
    sizes = np.diff(np.append(starts, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, sizes)
    slots = np.flatnonzero(np.repeat(sizes > 1, sizes))  # places whose group is not single
    h, end = span, 0 if span == 1 else n + 1
    while len(slots) and h < n:
        at = order[slots]
        ahead = at + h
        key = rank[at] * (n + 2) + np.where(ahead < n, rank[np.minimum(ahead, n - 1)] + 1, end)
        picked = np.argsort(key, kind="stable")
        at, key = at[picked], key[picked]
        order[slots] = at
        head = np.empty(len(at), bool)
        head[0] = True
        head[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(head)
        sizes = np.diff(np.append(first, len(at)))
        rank[at] = np.repeat(slots[first], sizes)
        slots = slots[np.repeat(sizes > 1, sizes)]
        h *= 2
    return order


def packed_words(data: np.ndarray, fill: int = 0xFF) -> np.ndarray:
    """For each place of a byte array the eight bytes from it on, as one big-endian number."""
    long = np.concatenate([data, np.full(8, fill, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out |= long[k : k + len(data)] << np.uint64(56 - 8 * k)
    return out


def common_prefixes(words: np.ndarray, order: np.ndarray, most: int, stride: int = 16) -> np.ndarray:
    """Kasai's common prefixes: out[j] symbols are shared by the suffixes in places j - 1 and j, counted up to `most`.

    A suffix shares at most one symbol less with its left neighbour than the suffix before it in the text does.  So every
    `stride`-th text position is compared from its start, and the positions in between start from that bound.
    `words` are the packed words of the text."""
    n = len(order)
    before = np.empty(n, np.int64)
    before[order[1:]] = order[:-1]
    before[order[0]] = -1
    shared = np.zeros(n, np.int64)

    def extend(at: np.ndarray, size: np.ndarray) -> None:
        live = np.flatnonzero(before[at] >= 0)
        at, size = at[live], size[live]
        while len(at):
            a, b = at + size, before[at] + size
            inside = (a < n) & (b < n)
            x = np.where(inside, words[np.minimum(a, n - 1)] ^ words[np.minimum(b, n - 1)], np.uint64(1 << 63))
            size = np.where(inside & (x == 0), size + 8, size)
            done = ~inside | (x != 0) | (size >= most)
            tail = np.zeros(len(at), np.int64)
            ended = inside & (x != 0)
            if ended.any():  # equal leading bytes of the first words that differ
                y = x[ended]
                lead = np.zeros(len(y), np.int64)
                for k in range(1, 8):
                    lead += (y >> np.uint64(64 - 8 * k)) == 0
                tail[ended] = lead
            shared[at[done]] = np.minimum(size + tail, most)[done]
            at, size = at[~done], size[~done]

    coarse = np.arange(0, n, stride)
    extend(coarse, np.zeros(len(coarse), np.int64))
    fine = np.flatnonzero(np.arange(n) % stride)
    extend(fine, np.maximum(0, shared[fine - fine % stride] - fine % stride))
    return shared[order]


def find_prefixes(words: np.ndarray, rows: np.ndarray, sought: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of strings of `size` bytes (a multiple of 8): the range [low, high) of `rows` that start with each.

    `rows` are text positions in suffix order over `words`; the strings start at `at` in another text's words."""
    low = np.searchsorted(words[rows], sought[at], side="left")
    high = np.searchsorted(words[rows], sought[at], side="right")
    for step in range(8, size, 8):
        live = np.flatnonzero(low < high)
        if not len(live):
            break
        value = sought[at[live] + step]
        low[live], high[live] = (
            _bound(words, rows, step, value, low[live], high[live], right) for right in (False, True)
        )
    return low, high


def _bound(words, rows, step, value, low, high, right):
    low, high = low.copy(), high.copy()
    while True:
        live = np.flatnonzero(low < high)
        if not len(live):
            return low
        middle = (low[live] + high[live]) // 2
        seen = words[rows[middle] + step]
        go = seen <= value[live] if right else seen < value[live]
        low[live] = np.where(go, middle + 1, low[live])
        high[live] = np.where(go, high[live], middle)
