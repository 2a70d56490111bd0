"""Merge rounds over ragged arrays of symbols, for words of any length.

All runs of symbols lie in one flat array. In each round every run merges its pair of lowest rank, found by
binary search over the sorted pair keys; runs without a pair leave the array. Two things make the number of
rounds of a run depend on the different pairs in it, not on its length:

- A run ends wherever no pair of the table can ever reach across, so text without blanks falls into pieces.
- All places of the lowest rank merge in one round, from left to right, if no pair with one of its
  products has that rank or a lower one; then nothing that comes up could go before them. Else only
  the leftmost place does, as one at a time would.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np

NEVER = np.int32(1 << 30)
#: Symbols of a block; a longer run is a block of its own.
_BLOCK = 1 << 18


@dataclass
class Pairs:
    symbols: int
    key: np.ndarray  # left * symbols + right, ascending
    rank: np.ndarray  # of each pair, lower merges first; one more at the end for no pair
    merged: np.ndarray  # the symbol that each pair becomes
    together: np.ndarray  # whether all places of the pair's rank may merge at once
    crossed: np.ndarray  # left * symbols + right of the first symbols between which some pair merges

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair, or that of no pair; symbols below 0 merge with nothing."""
        if not len(self.key):
            return np.zeros(len(left), np.int32)
        key = left.astype(np.int64) * self.symbols + right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        hit = (self.key[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, at, len(self.key)).astype(np.int32)

    def crosses(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether any pair can ever merge across the border between two first symbols."""
        if not len(self.crossed):
            return np.zeros(len(left), bool)
        key = left.astype(np.int64) * self.symbols + right
        at = np.minimum(np.searchsorted(self.crossed, key), len(self.crossed) - 1)
        return (self.crossed[at] == key) & (left >= 0) & (right >= 0)


def pair_table(
    symbols: int, rows: Sequence[tuple[int, int, int, int]], begin: np.ndarray, end: np.ndarray
) -> Pairs:
    """A table of (left, right, rank, product); begin and end hold the first and last single symbol of each."""
    left, right, rank, merged = np.array(sorted(rows), np.int64).reshape(-1, 4).T
    lowest = np.full(symbols, NEVER, np.int64)  # of the pairs that a symbol is in
    np.minimum.at(lowest, left, rank)
    np.minimum.at(lowest, right, rank)
    following = np.full(int(rank.max(initial=0)) + 1, NEVER, np.int64)
    np.minimum.at(following, rank, lowest[merged])
    return Pairs(
        symbols,
        left * symbols + right,
        np.append(rank, NEVER).astype(np.int32),
        np.append(merged, -1).astype(np.int32),
        np.append(following[rank] > rank, False),
        np.unique(end[left].astype(np.int64) * symbols + begin[right]),
    )


def _blocks(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of runs that hold about a block of symbols."""
    first = 0
    while first < len(bounds) - 1:
        last = int(np.searchsorted(bounds, bounds[first] + _BLOCK, "right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


def _merge_block(symbols: np.ndarray, run: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    done: list[tuple[np.ndarray, np.ndarray]] = []
    none = np.int32(len(pairs.key))
    pair = np.append(pairs.find(symbols[:-1], symbols[1:]), none)
    pair[:-1][run[1:] != run[:-1]] = none
    while len(run):
        rank = pairs.rank[pair]
        starts = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]]))
        sizes = np.diff(np.append(starts, len(run)))
        lowest = np.minimum.reduceat(rank, starts)
        if (lowest == NEVER).any():
            more = np.repeat(lowest < NEVER, sizes)
            done.append((run[~more], symbols[~more]))
            run, symbols, pair, rank = run[more], symbols[more], pair[more], rank[more]
            sizes, lowest = sizes[lowest < NEVER], lowest[lowest < NEVER]
            if not len(run):
                break
        at = np.flatnonzero(rank == np.repeat(lowest, sizes))
        # places in a row overlap: every other one of them merges, the first one to begin with
        order = np.arange(len(at))
        heads = np.concatenate([[True], at[1:] != at[:-1] + 1])
        chosen = (order - np.maximum.accumulate(np.where(heads, order, 0))) % 2 == 0
        leftmost = np.concatenate([[True], run[at][1:] != run[at][:-1]])
        at = at[chosen & (leftmost | pairs.together[pair[at]])]
        symbols[at] = pairs.merged[pair[at]]
        keep = np.ones(len(run), bool)
        keep[at + 1] = False
        run, symbols, pair = run[keep], symbols[keep], pair[keep]
        at = at - np.arange(len(at))
        changed = np.concatenate([at, at[at > 0] - 1])
        inside = changed + 1 < len(run)
        after = np.where(inside, changed + 1, changed)
        inside &= run[after] == run[changed]
        pair[changed] = np.where(inside, pairs.find(symbols[changed], symbols[after]), none)
    if not done:
        return run, symbols
    run, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
    order = np.argsort(run, kind="stable")
    return run[order], symbols[order]


def merge(symbols: np.ndarray, sizes: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """The symbols left of all words, one word after the other, and how many each has."""
    word = np.repeat(np.arange(len(sizes)), sizes)
    head = np.ones(len(symbols), bool)
    head[1:] = (word[1:] != word[:-1]) | ~pairs.crosses(symbols[:-1], symbols[1:])
    bounds = np.append(np.flatnonzero(head), len(symbols))
    word_of = word[bounds[:-1]]
    counts, left = np.zeros(len(sizes), np.int64), [symbols[:0].astype(np.int32)]
    for first, last in _blocks(bounds):
        part = symbols[bounds[first] : bounds[last]].astype(np.int32)
        run = np.repeat(np.arange(first, last), np.diff(bounds[first : last + 1]))
        run, part = _merge_block(part, run, pairs)
        counts += np.bincount(word_of[run], minlength=len(sizes))
        left.append(part)
    return np.concatenate(left), counts
