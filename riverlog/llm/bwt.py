"""Merging Burrows-Wheeler transforms by interleave refinement.

The interleave says, for each place of the merged transform, which shard it comes from. It starts with all of the first shard,
then all of the second; each pass sorts it stably by the symbols read through it, which orders suffixes by one more symbol.
A place's common prefix with the place before is the pass in which the two first parted. Nothing is sorted anew, but each
pass goes over all symbols, and repeats of n symbols take n passes.
"""

from __future__ import annotations

import numpy as np


def bwt(texts: list[bytes]) -> np.ndarray:
    """The transform of a collection; symbol 0 ends a text, bytes are 1 to 256, ends sort by the text's place."""
    data = np.concatenate([np.concatenate([np.frombuffer(t, np.uint8).astype(np.int64) + 1, [0]]) for t in texts])
    ends = np.flatnonzero(data == 0)
    rank = data + len(texts)
    rank[ends] = np.arange(len(texts))
    n, step = len(data), 1
    while True:
        rest = np.searchsorted(ends, np.arange(n)) == np.searchsorted(ends, np.minimum(np.arange(n) + step, n - 1))
        after = np.where(rest & (np.arange(n) + step < n), rank[np.minimum(np.arange(n) + step, n - 1)] + 1, 0)
        order = np.lexsort((after, rank))
        new = np.cumsum(np.concatenate([[0], (np.diff(rank[order]) != 0) | (np.diff(after[order]) != 0)]))
        rank = np.empty(n, np.int64)
        rank[order] = new
        if new[-1] == n - 1:
            break
        step *= 2
    before = np.where(order > 0, data[order - 1], 0)
    return before


def merge(x: np.ndarray, y: np.ndarray, depth: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(merged transform, interleave, common prefixes up to depth) of two transforms."""
    inter = np.concatenate([np.zeros(len(x), np.int8), np.ones(len(y), np.int8)])
    common = np.full(len(inter), -1, np.int64)
    common[0] = 0
    both = (x, y)
    parted = np.zeros(len(inter), bool)
    parted[0] = True
    k = 0
    while depth is None or k <= depth:
        symbols = np.empty(len(inter), np.int64)
        for s in (0, 1):
            symbols[inter == s] = both[s]
        # Ends of texts are all different: each keeps its own place.
        block = np.cumsum(parted)
        order = np.argsort(np.where(symbols == 0, inter, symbols + 1), kind="stable")  # ends go by text, the first shard's first
        new = inter[order]
        sorted_symbols, sorted_block = symbols[order], block[order]
        start = np.concatenate([[True], (np.diff(sorted_symbols) != 0) | (np.diff(sorted_block) != 0)]) | (sorted_symbols == 0)
        fresh = start & (common < 0)
        common[fresh] = k
        done = (new == inter).all() and not fresh.any()
        inter, parted = new, start | parted
        k += 1
        if done:
            break
    out = np.empty(len(inter), np.int64)
    for s in (0, 1):
        out[inter == s] = both[s]
    return out, inter, common
