"""Byte-pair merges over many short sequences at once, in flat numpy arrays.

Each round finds, in every sequence, the pair of lowest rank (a segmented minimum), merges all of
its places from the left at the same time, and compacts the arrays. A sequence without a pair
leaves. ``checked`` is for vocabularies whose ranks belong to the merged piece: there a merge can
make a pair that ranks no later than the one being merged, so the sequence's further merges of
that round wait.
"""

from __future__ import annotations

import numpy as np

NONE = np.iinfo(np.int64).max


class PairTable:
    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray, merged: np.ndarray):
        self.size = int(max(left.max(), right.max(), merged.max())) + 1
        keys = left.astype(np.int64) * self.size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.merged = keys[order], rank[order].astype(np.int64), merged[order].astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair, -1 where there is none. Symbols outside the table's are in no pair."""
        key = np.where((np.minimum(left, right) < 0) | (np.maximum(left, right) >= self.size), -1, left * self.size + right)
        slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[slot] == key, slot, -1)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        slot = self.find(left, right)
        return np.where(slot >= 0, self.rank[slot], NONE)


def _slots(pairs: PairTable, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The slot of the pair that begins at each place, -1 at the end of a sequence."""
    after = np.minimum(at + 1, len(symbols) - 1)
    return np.where((after > at) & (owner[after] == owner[at]), pairs.find(symbols[at], symbols[after]), -1)


def _waits(pairs: PairTable, symbols: np.ndarray, owner: np.ndarray, at: np.ndarray, merged: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Which of the chosen merges come after one that made a pair of no later rank."""
    last = len(symbols) - 1
    chained = np.zeros(len(at), bool)
    chained[1:] = (at[1:] == at[:-1] + 2) & (owner[at[1:]] == owner[at[:-1]])
    left = symbols[np.maximum(at - 1, 0)]
    left[1:] = np.where(chained[1:], merged[:-1], left[1:])
    left = np.where((at > 0) & (owner[np.maximum(at - 1, 0)] == owner[at]), left, -1)
    after = np.minimum(at + 2, last)
    right = np.where((at + 2 <= last) & (owner[after] == owner[at]), symbols[after], -1)
    made = np.minimum(pairs.ranks(left, merged), pairs.ranks(merged, right)) <= best
    earlier = np.cumsum(made) - made
    first = np.ones(len(at), bool)
    first[1:] = owner[at[1:]] != owner[at[:-1]]
    return earlier > np.maximum.accumulate(np.where(first, earlier, 0))


def merge_rounds(symbols: np.ndarray, lengths: np.ndarray, pairs: PairTable, checked: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The symbols left of each sequence, one after the other, and how many each has."""
    symbols, owner = symbols.astype(np.int64), np.repeat(np.arange(len(lengths)), lengths)
    ended: list[tuple[np.ndarray, np.ndarray]] = []
    slot = _slots(pairs, symbols, owner, np.arange(len(symbols)))
    while len(symbols):
        rank = np.where(slot >= 0, pairs.rank[slot], NONE)
        heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        best = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.append(heads, len(symbols))))
        over = best == NONE
        if over.any():
            ended.append((symbols[over], owner[over]))
            symbols, owner, slot, rank, best = (x[~over] for x in (symbols, owner, slot, rank, best))
            if not len(symbols):
                break
        at = np.flatnonzero(rank == best)
        fresh = np.ones(len(at), bool)
        fresh[1:] = at[1:] != at[:-1] + 1
        place = np.arange(len(at))
        at = at[(place - np.maximum.accumulate(np.where(fresh, place, 0))) % 2 == 0]
        merged = pairs.merged[slot[at]]
        if checked:
            go = ~_waits(pairs, symbols, owner, at, merged, best[at])
            at, merged = at[go], merged[go]
        symbols[at] = merged
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        symbols, owner, slot = symbols[keep], owner[keep], slot[keep]
        now = at - np.arange(len(at))
        for changed in (now, np.maximum(now - 1, 0)):
            slot[changed] = _slots(pairs, symbols, owner, changed)
    if not ended:
        return np.zeros(0, np.int64), np.zeros(len(lengths), np.int64)
    symbols, owner = (np.concatenate(x) for x in zip(*ended, strict=True))
    return symbols[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(lengths))
