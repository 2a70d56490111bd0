"""BPE encoding and decoding in batched merge rounds over one flat array of symbols.

The symbols of all distinct words of a batch lie in one array. In each round the ranks of all neighbouring
pairs are found by binary search over the sorted pair keys, and every word merges its pair of
lowest rank. Words without a pair to merge leave the array; words of all lengths go the same way (see `rounds`).

The tokenizer file must be a lower-casing byte-level BPE with word ends, without post-processing and
decoder; others are refused. Its special strings are tokens of their own wherever a text has them.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revaudit.llm.common import slices
from revaudit.llm.rounds import Pairs, merge, pair_table
from revaudit.llm.words import lists, text_bytes

#: Bytes of text that are encoded at once: their words, symbols and ids take tens of times as much.
_SLICE = 1 << 20
_BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Characters whose case, form and kind no version of Unicode has changed; others go to the file's own rules.
_PLAIN = re.compile("[\\x00-\\u024f\\u2010-\\u2027\\u2030-\\u205e]*")


def _plain_class(kind: str) -> str:
    """The plain characters of a Unicode category's first letter, as ranges of a character class."""
    plain = [c for c in map(chr, range(0x2060)) if _PLAIN.fullmatch(c) and unicodedata.category(c)[0] == kind]
    ranges: list[list[int]] = []
    for c in map(ord, plain):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(f"\\u{a:04x}-\\u{b:04x}" for a, b in ranges)


@dataclass
class Tokenizer:
    path: str
    words: str  # the pattern that finds words, in terms of \\s, \\p{L} and \\p{N}
    special: dict[str, int]
    first: np.ndarray  # byte to symbol inside a word
    last: np.ndarray  # byte to symbol at a word's end
    pairs: Pairs
    names: np.ndarray  # the string of each id


def byte_letters() -> dict[int, str]:
    """The character that byte-level tokenizers write for each byte: printable ones stand for themselves,
    the others follow from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def read_tokenizer(path: str) -> Tokenizer:
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model = spec["model"]
    split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    forms = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
    plain = (
        forms == ["NFC", "Replace", "Lowercase"]
        and [s["type"] for s in split] == ["Split", "ByteLevel"]
        and model.get("end_of_word_suffix")
        and spec["decoder"] is None
        and spec["post_processor"] is None
    )
    if not plain:
        raise ValueError("not a lower-casing byte-level BPE with word ends")
    vocabulary, end = model["vocab"], model["end_of_word_suffix"]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    names = np.empty(max([*vocabulary.values(), *special.values()]) + 1, object)
    for name, i in [*vocabulary.items(), *special.items()]:
        names[i] = name
    letters = byte_letters()
    rows = [(vocabulary[a], vocabulary[b], rank, vocabulary[a + b]) for rank, (a, b) in enumerate(model["merges"])]
    begin, last = np.full(len(names), -1), np.full(len(names), -1)
    for name, i in vocabulary.items():
        spelled = name.removesuffix(end)
        if spelled and set(spelled) <= set(letters.values()):
            closing = end if len(spelled) < len(name) else ""
            begin[i] = vocabulary[spelled[0] + (closing if len(spelled) == 1 else "")]
            last[i] = vocabulary[spelled[-1] + closing]
    return Tokenizer(
        path, split[0]["pattern"]["Regex"], special,
        np.array([vocabulary[letters[b]] for b in range(256)]), np.array([vocabulary[letters[b] + end] for b in range(256)]),
        pair_table(len(names), rows, begin, last), names,
    )


class Splitter:
    """Cuts texts into words as the tokenizer file says; special strings come out whole."""

    def __init__(self, tokenizer: Tokenizer) -> None:
        pattern = tokenizer.words
        for name, chars in ((r"\p{L}", _plain_class("L")), (r"\p{N}", _plain_class("N")), (r"\s", _BLANK)):
            pattern = pattern.replace(f"[{name}]", f"[{chars}]").replace(name, chars)
        self._words = re.compile(pattern)
        self._special = re.compile("(" + "|".join(map(re.escape, tokenizer.special)) + ")") if tokenizer.special else None
        self._path, self._rules = tokenizer.path, None
        self._bytes = {c: b for b, c in byte_letters().items()}

    def _by_file(self, text: str) -> list[str]:
        if self._rules is None:
            from tokenizers import Tokenizer as Library

            self._rules = Library.from_file(self._path)
        found = self._rules.pre_tokenizer.pre_tokenize_str(self._rules.normalizer.normalize_str(text))
        return [bytes(self._bytes[c] for c in word).decode() for word, _ in found]

    def _segment(self, text: str) -> list[str]:
        if text.isascii() or _PLAIN.fullmatch(text):
            return self._words.findall(text.lower())  # blanks are in no word
        return self._by_file(text)

    def split(self, text: str) -> tuple[list[str], list[int]]:
        """The words, and the places among them that are special strings."""
        if self._special is None or not self._special.search(text):
            return self._segment(text), []
        words: list[str] = []
        places = []
        for i, part in enumerate(self._special.split(text)):
            if i % 2:
                places.append(len(words))
                words.append(part)
            else:
                words.extend(self._segment(part))
        return words, places


def merge_words(words: pa.Array, t: Tokenizer) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words, one after the other, and how many each has. No word is empty."""
    data, bounds = text_bytes(words)
    symbols = t.first[data]
    symbols[bounds[1:] - 1] = t.last[data[bounds[1:] - 1]]
    return merge(symbols, np.diff(bounds), t.pairs)


def gather(ids: np.ndarray, counts: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words that the codes name, in the codes' order, and how many each has."""
    first, size = np.cumsum(counts) - counts, counts[codes]
    begin = np.repeat(first[codes] - (np.cumsum(size) - size), size)
    return ids[begin + np.arange(len(begin))], size


def _encode_batches(shared, texts_too: bool, kept: tuple[str, ...] = ("doc_id",)):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t: Tokenizer = shared.value
        splitter = Splitter(t)
        strings = name_strings(t)
        for batch in batches:
            for part in slices(batch, most=_SLICE):
                words: list[str] = []
                sizes, special = [], []
                for text in part.column("text").to_pylist():
                    own, places = splitter.split(text or "")
                    special.extend(len(words) + p for p in places)
                    words.extend(own)
                    sizes.append(len(own))
                if special:
                    held = [(p, t.special[words[p]]) for p in special]
                    for p, i in held:
                        words[p] = f"\x00{i}"  # no word: blanks and signs never stand beside digits
                coded = pa.array(words, pa.large_string()).dictionary_encode()
                ids, counts = merge_words(coded.dictionary, t)
                if special:
                    names = {w: i for i, w in enumerate(coded.dictionary.to_pylist()) if w[0] == "\x00"}
                    ends = np.cumsum(counts)
                    keep = np.ones(len(ids), bool)
                    for _, i in set((0, i) for _, i in held):
                        at = names[f"\x00{i}"]
                        keep[ends[at] - counts[at] + 1 : ends[at]] = False
                        ids[ends[at] - counts[at]] = i
                        counts[at] = 1
                    ids = ids[keep]
                flat, size = gather(ids, counts, coded.indices.to_numpy())
                ends = np.concatenate([[0], np.cumsum(size)])[np.cumsum([0, *sizes])]
                made = [lists(flat.astype(np.int32), np.diff(ends), pa.int32())]
                if texts_too:
                    made.append(decode_lists(made[0], strings))
                names = [*kept, "ids", "decoded"][: len(kept) + len(made)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *made], names)

    return work


def name_strings(t: Tokenizer) -> pa.Array:
    return pa.array(t.names.tolist(), pa.string())


def decode_lists(ids: pa.Array, names: pa.Array) -> pa.Array:
    """The strings of each row's ids joined by spaces, as the library does for a file without a decoder."""
    strings = names.take(pc.list_flatten(ids))
    return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, strings), " ")


def encode(
    documents: DataFrame, tokenizer_path: str, decoded: bool = False, kept: list[str] | None = None
) -> DataFrame:
    """The kept columns (doc_id), ids, and the text decoded from them if asked for; one row for each row.

    Texts are encoded whole, without added special tokens, truncation or padding. Null and empty texts
    have no ids and decode to the empty text. Kept columns pass through as they are, null included; others
    are not read. An empty table gives an empty one. The tokenizer is read on the driver and broadcast: a few
    MB. Its file is opened by tasks only for characters whose properties depend on a version of Unicode.
    """
    kept = kept or ["doc_id"]
    shared = documents.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))
    kinds = {f.name: f.dataType.simpleString() for f in documents.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in kept), "ids array<int>", *["decoded string"] * decoded])
    chosen = documents.select(*dict.fromkeys([*kept, "text"]))
    return chosen.mapInArrow(_encode_batches(shared, decoded, tuple(kept)), schema)


def encoder(documents: DataFrame, tokenizer_path: str):
    """What `encode` does to the batches of a task (doc_id, text), for operators that go on with its batches."""
    shared = documents.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))
    return _encode_batches(shared, False)


def decode(encoded: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id and decoded, out of doc_id and ids; null ids decode to the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_tokenizer(tokenizer_path))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings = name_strings(shared.value)
        for batch in batches:
            rows = batch.column("ids").cast(pa.list_(pa.int32()))
            some = pc.fill_null(rows, pa.scalar([], pa.list_(pa.int32())))
            some = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(pc.list_value_length(some).to_numpy())]), pa.int32()), pc.list_flatten(some))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), decode_lists(some, strings)], ["doc_id", "decoded"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(work, f"doc_id {kind}, decoded string")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the decimal ids joined by spaces and of the decoded text."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
