"""Runs of letters, digits or signs of many texts, hashed, and what the classifiers make of them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from revaudit.llm.words import span_hashes, text_bytes

_SPACE, _LETTER, _DIGIT, _SIGN = 0, 1, 2, 3
_KIND = np.full(256, _SIGN, np.uint8)
_KIND[[9, 10, 11, 12, 13, 32]] = _SPACE
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[ord("a") : ord("z") + 1] = _LETTER
_KIND[ord("A") : ord("Z") + 1] = _LETTER
_KIND[0x80:] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


@dataclass
class Tokens:
    data: np.ndarray  # bytes of all texts, ASCII letters in lower case
    bounds: np.ndarray
    start: np.ndarray
    end: np.ndarray
    kind: np.ndarray  # 1 letters (and all beyond ASCII), 2 digits, 3 signs
    capital: np.ndarray  # starts with two capital ASCII letters
    text: np.ndarray  # the text each token is in
    hash: np.ndarray


def split_tokens(column: pa.Array) -> Tokens:
    """The longest runs of one kind of character; null texts have none."""
    data, bounds = text_bytes(column)
    kind = _KIND[data]
    change = np.ones(len(data), bool)
    change[1:] = kind[1:] != kind[:-1]
    change[bounds[:-1][bounds[:-1] < len(data)]] = True
    start = np.flatnonzero(change)
    end = np.append(start[1:], len(data)) if len(start) else start
    worded = kind[start] != _SPACE
    start, end = start[worded], end[worded]
    upper = (data >= ord("A")) & (data <= ord("Z"))
    capital = upper[start] & (end - start > 1) & upper[np.minimum(start + 1, max(len(data) - 1, 0))]
    lower = _LOWER[data]
    text = np.searchsorted(bounds, start, side="right") - 1
    return Tokens(lower, bounds, start, end, kind[start], capital, text, span_hashes(lower, start, end))
