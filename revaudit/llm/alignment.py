"""Alignment of two tokenizers' tokens by pointer jumping over flat arrays of byte ranges.

The tokens of all texts of a batch lie on one line of bytes, once cut by tokenizer A and once by B. Every
token points to the farthest token to the right that overlaps it: one of A to the token of B over its last
byte, one of B to the token of A over its last byte if that ends later, else to itself. Replacing all
pointers by their pointers' pointers doubles the reach of each round, so after a logarithm of the
longest chain all tokens of a group point to its last token of B, where tokens of both end together. Groups
never cross texts, since both tokenizers end there.

Links are counted over all texts. The counts that many texts need, at most KNOWN_PAIRS pairs, are broadcast;
the others, each with less than that share of all links, are joined by a shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revaudit.llm.bpe import _BLANK, _PLAIN, _plain_class, byte_letters, gather
from revaudit.llm.common import slices
from revaudit.llm.words import lists, text_bytes
from revaudit.operators.scratch import settle

#: Most pairs whose counts are broadcast: 17 bytes each.
KNOWN_PAIRS = 1 << 18

_SPACE = "▁"
_COUNTED = "n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>"


@dataclass
class Entries:
    """The bytes of each id's entry, one after the other."""

    data: np.ndarray
    first: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, entries: list[bytes]) -> Entries:
        size = np.array([len(e) for e in entries], np.int64)
        return cls(np.frombuffer(b"".join(entries), np.uint8), np.cumsum(size) - size, size)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a run of ids."""
        size = self.size[ids]
        ends = np.cumsum(size)
        at = np.repeat(self.first[ids] - (ends - size), size)
        return self.data[at + np.arange(len(at))]


class ByteLevel:
    """Tokenizer A: a byte-level file of the tokenizers library, which also encodes."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.encode_special_tokens = True
        self._library.no_truncation()
        self._library.no_padding()
        byte = {c: b for b, c in byte_letters().items()}
        names = [self._library.id_to_token(i) or "" for i in range(self._library.get_vocab_size())]
        self.entries = Entries.of(
            [bytes(byte[c] for c in n) if all(c in byte for c in n) else n.encode() for n in names]
        )

        letters, digits = _plain_class("L"), _plain_class("N")
        # Fixed value: the pattern by which byte-level files split texts, over the plain characters.
        self._words = re.compile(
            f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{digits}]+| ?[^{_BLANK}{letters}{digits}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
        )

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each behind a space, and how many each has.

        No merge crosses a word, so the library encodes each distinct word once. Texts with characters whose kind
        depends on a version of Unicode go to it whole.
        """
        pieces: list[str] = []
        sizes = np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            text = " " + text
            own = self._words.findall(text) if text.isascii() or _PLAIN.fullmatch(text) else [text]
            sizes[i] = len(own)
            pieces.extend(own)
        coded = pa.array(pieces, pa.large_string()).dictionary_encode()
        ids, counts = _flat(self._ids(coded.dictionary.to_pylist()))
        flat, each = gather(ids, counts, coded.indices.to_numpy())
        ends = np.concatenate([[0], np.cumsum(each)])[np.cumsum(np.append(0, sizes))]
        return flat, np.diff(ends)


class Pieces:
    """Tokenizer B: a model of the sentencepiece library, which also encodes and puts a space in front."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self._library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = []
        for i in range(self._library.get_piece_size()):
            piece = self._library.id_to_piece(i)
            pieces.append(bytes([int(piece[3:5], 16)]) if self._library.is_byte(i) else piece.replace(_SPACE, " ").encode())
        self.entries = Entries.of(pieces)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts and how many each has."""
        return _flat(self._library.encode(texts, num_threads=1))


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The group of each token of A and of B, named by its last token of B, and A's token that ends with each of B's.

    Ends ascend strictly and the last two are equal. The third array is -1 where no token of A ends there.
    """
    n = len(ends_a)
    over_b, over_a = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
    together = ends_a[over_a] == ends_b if n else np.zeros(0, bool)
    pointer = np.concatenate([n + over_b, np.where(together, n + np.arange(len(ends_b)), over_a)])
    while True:
        farther = pointer[pointer]
        if np.array_equal(farther, pointer):
            break
        pointer = farther
    return pointer[:n] - n, pointer[n:] - n, np.where(together, over_a, -1)


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.array([len(r) for r in rows], np.int64)
    return np.fromiter(chain.from_iterable(rows), np.int64, int(sizes.sum())), sizes


def _spelled(groups: np.ndarray, ids: np.ndarray, of_b: np.ndarray, doc: np.ndarray) -> pa.Array:
    """For each text with tokens its groups written as `a1,a2|b1;a3|b2`; tokens are in order of group and tokenizer."""
    last_of_run = np.ones(len(ids), bool)
    last_of_run[:-1] = (groups[1:] != groups[:-1]) | (of_b[1:] != of_b[:-1])
    last_of_doc = np.ones(len(ids), bool)
    last_of_doc[:-1] = doc[1:] != doc[:-1]
    sign = np.where(last_of_doc, 3, np.where(last_of_run, np.where(of_b, 2, 1), 0))
    none = pa.scalar("", pa.large_string())
    signs = pa.array([",", "|", ";", ""], pa.large_string()).take(pa.array(sign))
    parts = pc.binary_join_element_wise(pc.cast(pa.array(ids), pa.large_string()), signs, none)
    offsets = np.concatenate([[0], np.flatnonzero(last_of_doc) + 1])
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), parts), none)


def align(column: pa.Array, a: ByteLevel, b: Pieces) -> list[pa.Array]:
    """n_a, n_b, n_groups, groups_sha256, pairs and times of each text; pairs are A's id times 2^32 plus B's."""
    texts = column.to_pylist()
    rows = len(texts)
    some = [i for i, t in enumerate(texts) if t]
    given = [texts[i] for i in some]
    flats = [t.encode(given) for t in (a, b)] if given else [(np.zeros(0, np.int64),) * 2] * 2
    some = np.array(some, np.int64)

    # texts whose tokens do not spell them have none
    data, bounds = text_bytes(column)
    sizes = np.diff(bounds)[some] + 1
    firsts = bounds[:-1][some]
    fine = np.ones(len(some), bool)
    for (ids, counts), tokenizer in zip(flats, (a, b), strict=True):
        doc = np.repeat(np.arange(len(some)), counts)
        length = np.bincount(doc, tokenizer.entries.size[ids], minlength=len(some)).astype(np.int64)
        fine &= length == sizes
        ids, doc = ids[fine[doc]], doc[fine[doc]]
        spelled = tokenizer.entries.joined(ids)
        keep = np.flatnonzero(fine)
        ends = np.cumsum(sizes[keep])
        at = np.repeat(firsts[keep] - 1 - (ends - sizes[keep]), sizes[keep]) + np.arange(len(spelled))
        expected = data[np.maximum(at, 0)] if len(data) else np.zeros(0, np.uint8)
        expected[ends - sizes[keep]] = ord(" ")
        wrong = np.flatnonzero(spelled != expected)
        fine[keep[np.searchsorted(ends, wrong, side="right")]] = False
    (ids_a, doc_a), (ids_b, doc_b) = (
        (ids[fine[doc]], doc[fine[doc]]) for ids, doc in ((f[0], np.repeat(np.arange(len(some)), f[1])) for f in flats)
    )

    ends_a, ends_b = (np.cumsum(t.entries.size[ids]) for t, ids in ((a, ids_a), (b, ids_b)))
    group_a, group_b, partner = terminals(ends_a, ends_b)
    last = np.flatnonzero(partner >= 0)
    pair = (ids_a[partner[last]] << 32) | ids_b[last]
    known, code = np.unique(pair, return_inverse=True)
    held, times = np.unique((doc_b[last] << 32) | code, return_counts=True)
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    ids, doc = np.concatenate([ids_a, ids_b])[order], np.concatenate([doc_a, doc_b])[order]
    spelled = _spelled(np.concatenate([group_a, group_b])[order], ids, order >= len(ids_a), doc).to_pylist()

    def per_row(numbers: np.ndarray) -> np.ndarray:
        out = np.zeros(rows, np.int64)
        out[some] = np.bincount(numbers, minlength=len(some))
        return out

    digests = [""] * rows
    for i, text in zip(some[np.unique(doc)], spelled, strict=True):
        digests[i] = hashlib.sha256(text.encode()).hexdigest()
    kinds = per_row(held >> 32)
    return [
        pa.array(per_row(doc_a)),
        pa.array(per_row(doc_b)),
        pa.array(per_row(doc_b[last])),
        pa.array(digests, pa.string()),
        lists(known[held & 0xFFFFFFFF], kinds, pa.int64()),
        lists(times.astype(np.int32), kinds, pa.int32()),
    ]


@lru_cache(maxsize=1)
def _loaded(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    """Both tokenizers, read once by a worker for all its tasks."""
    return ByteLevel(path_a), Pieces(path_b)


def _align_batches(path_a: str, path_b: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        a, b = _loaded(path_a, path_b)
        names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"]
        for batch in batches:
            for part in slices(batch, most=2 << 20):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *align(part.column("text"), a, b)], names)

    return work


def groups(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups_sha256, pairs and times (the text's distinct links and how often it has each).

    One row for each row of `documents` (doc_id, text; others are not read). Null and empty texts and
    texts that the tokens of either tokenizer do not spell have no tokens: zeros, an empty digest and no links.
    doc_id passes through, null included; an empty table gives an empty one. Both files must be where tasks can
    read them.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(_align_batches(path_a, path_b), f"doc_id {kind}, {_COUNTED}")


def pair_counts(grouped: DataFrame) -> DataFrame:
    """pair, a, b, n, best: the links of each pair of ids over all texts, and whether no pair of that b has more.

    The highest counts are joined by a broadcast: one row for each id of B, so no more than its vocabulary has.
    """
    links = grouped.select(F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("x.pairs", "x.times")
    counts = links.groupBy(F.col("pairs").alias("pair")).agg(F.sum(F.col("times").cast("long")).alias("n"))
    counts = counts.select(
        "pair", F.shiftright("pair", 32).alias("a"), F.col("pair").bitwiseAND(0xFFFFFFFF).alias("b"), "n"
    )
    counts = settle(counts, "alignment-counts")
    highest = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(F.broadcast(highest), "b").select("pair", "a", "b", "n", (F.col("n") == F.col("most")).alias("best"))


def digests(documents: DataFrame, path_a: str, path_b: str, known_pairs: int = KNOWN_PAIRS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256: one row for each row of `documents`.

    A link is a token of A and one of B that end together; n_best counts those with the highest count of their
    id of B, ties included, and count_sum adds the counts of all. Other columns as in `groups`.
    """
    grouped = groups(documents, path_a, path_b).withColumn("row", F.monotonically_increasing_id())
    grouped = settle(grouped, "alignment-groups")
    counts = settle(pair_counts(grouped).select("pair", "n", "best"), "alignment-best")
    size = counts.agg(F.count("*").alias("pairs"), F.coalesce(F.sum("n"), F.lit(0)).alias("links")).first()
    # pairs with at least one known_pairs-th of all links: no more than known_pairs
    frequent = F.col("n") * F.lit(known_pairs) >= F.lit(size["links"]) if size["pairs"] > known_pairs else F.lit(True)

    links = grouped.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    links = links.select("row", F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("times"))

    def summed(counted: DataFrame) -> DataFrame:
        best = F.sum(F.when(F.col("best"), F.col("times")).otherwise(F.lit(0).cast("long")))
        return counted.groupBy("row").agg(best.alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))

    sums = summed(links.join(F.broadcast(counts.where(frequent)), "pair"))
    if size["pairs"] > known_pairs:
        rare = links.join(F.broadcast(counts.where(frequent).select("pair")), "pair", "left_anti")
        rest = summed(rare.join(counts.where(~frequent), "pair"))
        sums = sums.unionByName(rest).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    return grouped.join(sums, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"),
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
