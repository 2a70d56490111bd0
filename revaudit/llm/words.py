"""Words of many texts as flat numpy arrays: bounds, document numbers and 64-bit hashes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_PIECE = 1 << 20
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * _STEP)


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as far as asked for."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = (
                np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base)]), dtype=np.uint64)
                for base in (_STEP, _BACK)
            )
        return self.up[:n], self.down[:n]


_powers = _Powers()


@dataclass
class Words:
    data: np.ndarray  # bytes of all texts, one after the other
    bounds: np.ndarray  # first byte of each text, and the end
    start: np.ndarray  # first byte of each word
    end: np.ndarray
    first: np.ndarray  # first word of each text, and the number of words
    hash: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        """The number of the text that each word is in."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the bounds of its rows; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the bytes of each span; spans are in order and don't overlap."""
    out = np.zeros(len(start), np.uint64)
    cuts = np.unique(np.searchsorted(start, np.arange(0, len(data) + _PIECE, _PIECE)))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        lo, hi = int(start[a]), int(end[b - 1])
        up, down = _powers.to(hi - lo + 1)
        total = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum(_BYTES[data[lo:hi]] * down[: hi - lo], out=total[1:])
        s = start[a:b] - lo
        out[a:b] = (total[end[a:b] - lo] - total[s]) * up[s]
    return mixed(out + (end - start).astype(np.uint64))


def split_words(column: pa.Array) -> Words:
    data, bounds = text_bytes(column)
    inside = ~_SPACE[data]
    edge = inside.copy()
    edge[1:] &= ~inside[:-1]
    begins = bounds[:-1][bounds[:-1] < len(data)]
    edge[begins] = inside[begins]
    start = np.flatnonzero(edge)
    edge = inside.copy()
    edge[:-1] &= ~inside[1:]
    lasts = bounds[1:][bounds[1:] > 0] - 1
    edge[lasts] = inside[lasts]
    end = np.flatnonzero(edge) + 1
    return Words(data, bounds, start, end, np.searchsorted(start, bounds), span_hashes(data, start, end))


def gram_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of the n words from each word on, and whether all of them are in one text.

    Both are as long as the list of words; where the second is false the first means nothing.
    """
    total = len(words.hash)
    whole = np.zeros(total, bool)
    out = np.zeros(total, np.uint64)
    if total >= n:
        text = words.text_of
        whole[: total - n + 1] = text[: total - n + 1] == text[n - 1 :]
        up, down = _powers.to(total + 1)
        sums = np.zeros(total + 1, np.uint64)
        np.cumsum(words.hash * down[:total], out=sums[1:])
        out[: total - n + 1] = mixed((sums[n:] - sums[: total - n + 1]) * up[: total - n + 1])
    return out, whole


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column out of flat values and the number of values of each row."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def shingles(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The text and hash of every run of n words; a shorter text with words is one shingle."""
    hashes, whole = gram_hashes(words, n)
    text = words.text_of
    at = np.flatnonzero(whole)
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if not len(short):
        return text[at], hashes[at]
    few = np.zeros(len(short), np.uint64)
    for k in range(n - 1):
        have = words.counts[short] > k
        few[have] = mixed(few[have] * _STEP + words.hash[words.first[short][have] + k] + np.uint64(1))
    return np.concatenate([text[at], short]), np.concatenate([hashes[at], few])


def digests(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each text's words in their order."""
    order = np.arange(len(words.hash), dtype=np.uint64) - words.first[:-1].astype(np.uint64)[words.text_of]
    out = []
    for salt in (1, 2):
        spread = mixed(words.hash ^ mixed(order + np.uint64(salt << 40)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread, dtype=np.uint64)])
        out.append((sums[words.first[1:]] - sums[words.first[:-1]]).view(np.int64))
    return out[0], out[1]


def salted(value: np.ndarray, text: np.ndarray) -> np.ndarray:
    """One key out of a hash and the number of its text."""
    return mixed(value ^ mixed(text.astype(np.uint64) + np.uint64(1)))
