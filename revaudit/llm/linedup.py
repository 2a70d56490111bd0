"""Remove passages that occurred before: winnowing, then extension of the matches.

The hashed units are pieces of lines, twenty words long, wherever they begin: a shared passage rarely
starts at a line break, so hashes of whole lines would miss most. Of every window of pieces the
smallest hash is kept, and equal passages of fifty words keep an equal one wherever they are. Documents
are joined on the kept hashes. Around shared ones, the matches are extended both ways by comparing
the hashes of the fifty-word windows that chose them; each window's first document keeps it, later
ones lose all words of it. The result is exact: a word goes if and only if it lies in a run of
fifty words that occurred earlier, in an earlier document (by doc_id) or earlier in the same one.

Runs inside one document are found in its own task. Whole copies are found by a digest of all words,
so that their windows are not listed again. No pairs are made: a group of equal windows is one
minimum, taken before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revaudit.llm.common import slices
from revaudit.llm.words import Words, digests, gram_hashes, lists, salted, split_words
from revaudit.operators.scratch import settle

RUN_WORDS = 50
PIECE_WORDS = 20

_PRINTS = "doc_id long, digest long, check long, n_words long, prints array<long>, own array<int>"
_WINDOWS = "doc_id long, window long, at int"


def _sliding(values: np.ndarray, width: int, least: np.ufunc) -> np.ndarray:
    """The minimum or maximum of each run of `width` values, from its first position on."""
    span, out = 1, values
    while span * 2 <= width:
        out = least(out[: len(out) - span], out[span:])
        span *= 2
    rest = width - span
    return least(out[: len(out) - rest], out[rest:]) if rest else out


@dataclass
class Windows:
    at: np.ndarray  # first word of each window of `run` words
    text: np.ndarray  # the text it is in
    hash: np.ndarray
    least: np.ndarray  # smallest hash of its pieces
    chosen_text: np.ndarray  # texts and hashes of the pieces that some window has chosen
    chosen: np.ndarray


def windows(words: Words, run: int, piece: int) -> Windows:
    total, width = len(words.hash), run - piece + 1
    if total < run:
        none, nowhere = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return Windows(nowhere, nowhere, none, none, nowhere, none)
    text = words.text_of
    whole_hash, whole = gram_hashes(words, run)
    pieces, _ = gram_hashes(words, piece)
    least = np.zeros(total, np.uint64)
    least[: total - run + 1] = _sliding(pieces[: total - piece + 1], width, np.minimum)
    least[~whole] = 0
    # a piece is chosen if one of the windows it is in has no smaller one
    highest = _sliding(np.concatenate([np.zeros(width - 1, np.uint64), least]), width, np.maximum)
    chosen = np.flatnonzero((highest == pieces) & (highest > 0))
    at = np.flatnonzero(whole)
    return Windows(at, text[at], whole_hash[at], least[at], text[chosen], pieces[chosen])


def _firsts(key: np.ndarray) -> np.ndarray:
    """Whether each key is the first of its kind."""
    first = np.zeros(len(key), bool)
    first[np.unique(key, return_index=True)[1]] = True
    return first


def _among(found: Windows, wanted: np.ndarray) -> np.ndarray:
    """Whether each window's salted smallest hash is wanted; neighbours mostly have the same one."""
    if not len(found.at) or not len(wanted):
        return np.zeros(len(found.at), bool)
    change = np.ones(len(found.at), bool)
    change[1:] = (found.least[1:] != found.least[:-1]) | (found.text[1:] != found.text[:-1])
    begin = np.flatnonzero(change)
    hit = np.isin(salted(found.least[begin], found.text[begin]), wanted)
    return np.repeat(hit, np.diff(np.append(begin, len(change))))


def _repeated_inside(found: Windows, counts: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Indexes of the windows that occur earlier in their own text."""
    maybe = np.flatnonzero(_among(found, keys[counts > 1]))
    return maybe[~_firsts(salted(found.hash[maybe], found.text[maybe]))]


def _print_batches(run: int, piece: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = split_words(part.column("text"))
                texts, counts = part.num_rows, words.counts
                found = windows(words, run, piece)
                keys, first, times = np.unique(
                    salted(found.chosen, found.chosen_text), return_index=True, return_counts=True
                )
                again = _repeated_inside(found, times, keys)
                place = found.at[again] - words.first[found.text[again]]
                first.sort()
                digest, check = digests(words)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").cast(pa.int64()),
                        pa.array(digest),
                        pa.array(check),
                        pa.array(counts, pa.int64()),
                        lists(found.chosen[first].view(np.int64), np.bincount(found.chosen_text[first], minlength=texts), pa.int64()),
                        lists(place, np.bincount(found.text[again], minlength=texts), pa.int32()),
                    ],
                    ["doc_id", "digest", "check", "n_words", "prints", "own"],
                )

    return work


def _window_batches(run: int, piece: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = split_words(part.column("text"))
                found = windows(words, run, piece)
                shared = part.column("shared")
                owner = pc.list_parent_indices(shared).to_numpy()
                wanted = salted(pc.list_flatten(shared).to_numpy().view(np.uint64), owner)
                hit = np.flatnonzero(_among(found, wanted))
                hit = hit[_firsts(salted(found.hash[hit], found.text[hit]))]
                doc = part.column("doc_id").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc[found.text[hit]]),
                        pa.array(found.hash[hit].view(np.int64)),
                        pa.array(found.at[hit] - words.first[found.text[hit]], pa.int32()),
                    ],
                    ["doc_id", "window", "at"],
                )

    return work


def _cut(raw: bytes, start: list[int], end: list[int], gone: np.ndarray) -> bytes:
    """The text without the marked words and the spaces before each."""
    keep, at, edges = [], 0, np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    for first, after in edges.reshape(-1, 2).tolist():
        keep.append(raw[at : end[first - 1] if first else 0])
        at = end[after - 1]
    keep.append(raw[at:])
    return b"".join(keep)


def _cut_batches(run: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = split_words(part.column("text"))
                marks, copies = part.column("__marks").to_pylist(), part.column("__copy").to_pylist()
                texts = part.column("text").to_pylist()
                removed = np.zeros(part.num_rows, np.int64)
                for i, (mark, copy) in enumerate(zip(marks, copies, strict=True)):
                    a, b = int(words.first[i]), int(words.first[i + 1])
                    if b - a < run or not (mark or copy):
                        continue
                    if copy:
                        gone = np.ones(b - a, bool)
                    else:
                        at = np.asarray(mark)
                        at = at[at <= b - a - run]
                        steps = np.zeros(b - a + 1, np.int32)
                        np.add.at(steps, at, 1)
                        np.add.at(steps, at + run, -1)
                        gone = np.cumsum(steps[:-1]) > 0
                    lo = int(words.bounds[i])
                    raw = words.data[lo : int(words.bounds[i + 1])].tobytes()
                    texts[i] = _cut(raw, (words.start[a:b] - lo).tolist(), (words.end[a:b] - lo).tolist(), gone).decode()
                    removed[i] = int(gone.sum())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in part.schema.names if c not in ("text", "__marks", "__copy")),
                     pa.array(texts, pa.string()), pa.array(words.counts, pa.int64()), pa.array(removed)],
                    [*(c for c in part.schema.names if c not in ("text", "__marks", "__copy")), "text", "n_words", "n_removed"],
                )

    return work


def removals(documents: DataFrame, run: int = RUN_WORDS, piece: int = PIECE_WORDS) -> DataFrame:
    """doc_id, copy, marks: the documents that lose words, and the first words of the windows they lose.

    copy says that all words occur, in the same order, in an earlier document.
    """
    if not 1 <= piece <= run:
        raise ValueError("a piece has at least one word and at most as many as a run")
    plain = documents.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = settle(plain.mapInArrow(_print_batches(run, piece), _PRINTS), "linedup-prints")
    long = prints.where(F.col("n_words") >= run)
    groups = long.groupBy("digest", "check").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    groups = settle(groups.where("first < last").select("digest", "check", "first"), "linedup-groups")
    copies = settle(
        long.select("doc_id", "digest", "check").join(groups, ["digest", "check"]).where("doc_id > first").select("doc_id").distinct(),
        "linedup-copies",
    )
    own = long.join(copies, "doc_id", "left_anti")
    chosen = own.select("doc_id", F.explode("prints").alias("print"))
    repeated = chosen.groupBy("print").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("b")).where("a < b")
    repeated = settle(repeated.select("print"), "linedup-repeated")  # stored, so that a join can split hot keys
    shared = chosen.join(repeated, "print").groupBy("doc_id").agg(F.collect_set("print").alias("shared"))
    listed = settle(
        plain.repartition("doc_id").join(shared, "doc_id").select("doc_id", "text", "shared").mapInArrow(_window_batches(run, piece), _WINDOWS),
        "linedup-windows",
    )
    firsts = listed.groupBy("window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    firsts = settle(firsts.select("window", "first"), "linedup-firsts")
    later = listed.join(firsts, "window").where("doc_id > first").select("doc_id", "at")
    inner = own.select("doc_id", F.explode("own").alias("at"))
    marks = later.unionByName(inner).groupBy("doc_id").agg(F.collect_set("at").alias("marks"))
    return marks.select("doc_id", F.lit(False).alias("copy"), "marks").unionByName(
        copies.select("doc_id", F.lit(True).alias("copy"), F.array().cast("array<int>").alias("marks"))
    )


def remove_repeats(documents: DataFrame, run: int = RUN_WORDS, piece: int = PIECE_WORDS) -> DataFrame:
    """The documents with later repeats of runs of at least `run` words cut out of their texts.

    All rows and columns stay; text changes, and n_words (before) and n_removed are added or replaced.
    A word goes with the spaces before it; the rest of the text stays as it is. Null texts stay null
    and have no words. Rows without doc_id keep their text and take no part. Rows of one doc_id are one
    document: equal texts among them are no repeats of each other, and their marks are shared. An
    empty table gives an empty one.
    """
    kept = [c for c in documents.columns if c.lower() not in ("n_words", "n_removed", "__marks", "__copy")]
    marks = removals(documents, run, piece).select("doc_id", F.col("marks").alias("__marks"), F.col("copy").alias("__copy"))
    joined = documents.select(*kept).join(marks, "doc_id", "left").select(*kept, "__marks", "__copy")
    others = [c for c in kept if c != "text"]
    fields = {f.name: f for f in documents.schema}
    schema = ", ".join(f"`{c}` {fields[c].dataType.simpleString()}" for c in others)
    cut = joined.mapInArrow(_cut_batches(run), f"{schema}, text string, n_words long, n_removed long")
    return cut.select(*kept, "n_words", "n_removed")
