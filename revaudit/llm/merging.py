"""Token counts by rank-synchronous merging of ragged arrays of symbols, and the vocabulary of a piece model.

Pre-tokens, the stretches of a text that no merge crosses, are held as one ragged array of symbols. In each
round every pre-token merges its pair of lowest rank, all at once (see `rounds`); the symbols that
survive are its tokens. Each distinct pre-token of a batch is merged once, however long it is.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revaudit.llm.common import slices
from revaudit.llm.rounds import Pairs, merge, pair_table
from revaudit.llm.words import text_bytes

MOST_TOKENS = 4096

_SPACE = "▁"

@dataclass
class Vocabulary:
    """Symbols are numbers: those of single characters first, then those of longer pieces."""

    character: np.ndarray  # code point to symbol, -1 for characters without one
    pairs: Pairs


def read_pieces(path: str) -> Vocabulary:
    """The merges of a sentencepiece model of the BPE kind with byte fallback, read by that library."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usable = [
        i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    pieces = {model.id_to_piece(i): model.get_score(i) for i in usable}
    if any(re.search(f"[^{_SPACE}]{_SPACE}", piece) for piece in pieces):
        raise ValueError("a piece of this model reaches across a word's beginning")
    if model.encode("\n ﬁ", out_type=str)[-1] != "ﬁ" and "ﬁ" in pieces:
        raise ValueError("this model rewrites texts before it splits them")
    names = sorted(pieces, key=lambda p: (len(p) > 1, p))
    number = {p: i for i, p in enumerate(names)}
    character = np.full(0x110000, -1, np.int32)
    for piece in names:
        if len(piece) == 1:
            character[ord(piece)] = number[piece]
    character[ord(" ")] = character[ord(_SPACE)]  # the model writes a space as this sign
    order = {score: i for i, score in enumerate(sorted(set(pieces.values()), reverse=True))}
    rows = [
        (number[p[:k]], number[p[k:]], order[pieces[p]], number[p])
        for p in names
        for k in range(1, len(p))
        if p[:k] in number and p[k:] in number
    ]
    begin, end = (character[[ord(p[k]) for p in names]] for k in (0, -1))
    return Vocabulary(character, pair_table(len(names), rows, begin, end))


def count_tokens(pretokens: pa.Array, vocabulary: Vocabulary) -> np.ndarray:
    """The number of tokens of each pre-token. Characters without a symbol count as their UTF-8 bytes."""
    data, bounds = text_bytes(pretokens)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    firsts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
    symbols = vocabulary.character[points]
    extra = np.where(symbols < 0, (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF), 0)
    _, left = merge(symbols, np.diff(firsts), vocabulary.pairs)
    return left + np.diff(np.concatenate([[0], np.cumsum(extra)])[firsts])


def pretokens(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Stretches of the texts that no merge crosses, and how many each text has.

    A text that isn't empty starts with one more space. A stretch is a word with the spaces before it, or
    a line feed.
    """
    data, bounds = text_bytes(pc.replace_substring(column, _SPACE, " "))
    some = np.flatnonzero(np.diff(bounds))
    data = np.insert(data, bounds[:-1][some], ord(" "))
    starts = bounds[:-1][some] + np.arange(len(some))
    space, feed = data == ord(" "), data == ord("\n")
    begin = feed.copy()
    begin[1:] |= feed[:-1] | (space[1:] & ~space[:-1])
    begin[starts] = True
    offsets = np.append(np.flatnonzero(begin), len(data))
    sizes = np.zeros(len(bounds) - 1, np.int64)
    sizes[some] = np.diff(np.searchsorted(offsets, np.append(starts, len(data))))
    whole = pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    )
    return whole, sizes


def _count_batches(shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch in batches:
            for part in slices(batch, most=16 << 20):
                text = part.column("text")
                split, sizes = pretokens(text)
                coded = split.dictionary_encode()
                each = count_tokens(coded.dictionary, vocabulary)
                total = np.concatenate([[0], np.cumsum(each[coded.indices.to_numpy()])])
                ends = np.cumsum(sizes)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pc.fill_null(pc.binary_length(text), 0).cast(pa.int64()),
                        pa.array(total[ends] - total[ends - sizes], pa.int64()),
                    ],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    return work


def token_counts(documents: DataFrame, model_path: str, most: int = MOST_TOKENS) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit, one row for each row of `documents` (doc_id, text).

    Null texts count as empty and have no tokens. doc_id passes through, null included; other columns are not
    read. An empty table gives an empty one. The vocabulary is read on the driver and broadcast: a few MB.
    """
    shared = documents.sparkSession.sparkContext.broadcast(read_pieces(model_path))
    kind = documents.schema["doc_id"].dataType.simpleString()
    counted = documents.select("doc_id", "text").mapInArrow(
        _count_batches(shared), f"doc_id {kind}, n_bytes long, n_tokens long"
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > most)
