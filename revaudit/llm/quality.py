"""Quality scores: hashed word n-gram logistic regression, trained by follow-the-regularised-leader.

The features of a text are its tokens, its pairs of neighbouring tokens and the pairs of their shapes
(kind, capitals, same as the one before), hashed to a fixed number of places. A feature's value is its
share of the text's tokens, so a score is a sparse dot product that long texts don't inflate.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revaudit.llm.common import held_out, labelled_sample, slices
from revaudit.llm.tokens import split_tokens
from revaudit.llm.words import lists, mixed

#: Most labelled rows that the weights are learned from; half of each label while there are enough.
TRAINING_ROWS = 4_000
PLACES = 1 << 18
CUT = 0.3


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """text and place of each feature occurrence, and each text's number of tokens."""
    t = split_tokens(column)
    n = len(t.hash)
    count = np.bincount(t.text, minlength=len(column))
    if not n:
        return t.text, t.text, count
    same = np.zeros(n, bool)
    same[1:] = (t.hash[1:] == t.hash[:-1]) & (t.text[1:] == t.text[:-1])
    sign = np.where(t.kind == 3, t.hash, np.uint64(0))  # a sign run is its own shape
    shape = mixed(sign + t.kind.astype(np.uint64) * np.uint64(4) + t.capital * np.uint64(2) + same * np.uint64(1))
    word = mixed(t.hash + t.capital.astype(np.uint64))
    next_to = np.flatnonzero(t.text[1:] == t.text[:-1])
    pair = lambda x, salt: mixed(x[next_to] * np.uint64(0x9E3779B97F4A7C15) + x[next_to + 1] + np.uint64(salt))
    hashes = np.concatenate([word, shape, pair(word, 1), pair(shape, 2)])
    text = np.concatenate([t.text, t.text, t.text[next_to], t.text[next_to]])
    return text, (hashes >> np.uint64(46)).astype(np.int64), count


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            text, place, count = features(part.column("text"))
            key, times = np.unique(text * PLACES + place, return_counts=True)
            text, place = key // PLACES, key % PLACES
            share = (times / np.maximum(count, 1)[text]).astype(np.float32)
            sizes = np.bincount(text, minlength=part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("label"),
                 lists(place.astype(np.int32), sizes, pa.int32()), lists(share, sizes, pa.float32())],
                ["doc_id", "label", "places", "shares"],
            )


def follow_the_leader(
    examples: list[tuple[np.ndarray, np.ndarray, int]], passes: int = 3, alpha: float = 2.0, beta: float = 1.0,
    l1: float = 1e-4, l2: float = 1e-4,
) -> Model:
    """Per-coordinate FTRL-proximal over the examples (places, values, label), in a fixed random order.

    The bias is one more coordinate of value 1. Without examples of both labels, the score is the label
    there is, or 0.5.
    """
    seen = {label for _, _, label in examples}
    if len(seen) < 2:
        return Model(np.zeros(PLACES), {(): 0.0, (0,): -30.0, (1,): 30.0}[tuple(seen)])
    z, n = np.zeros(PLACES + 1), np.zeros(PLACES + 1)
    order = np.random.default_rng(5)

    def weights(at: np.ndarray | slice) -> np.ndarray:
        held = np.sign(z[at]) * np.maximum(np.abs(z[at]) - l1, 0)
        return -held / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(passes):
        for i in order.permutation(len(examples)):
            places, values, label = examples[i]
            at, value = np.append(places, PLACES), np.append(values.astype(float), 1.0)
            w = weights(at)
            score = 1 / (1 + np.exp(-np.clip(w @ value, -30, 30)))
            gradient = (score - label) * value
            n_new = n[at] + gradient * gradient
            z[at] += gradient - (np.sqrt(n_new) - np.sqrt(n[at])) / alpha * w
            n[at] = n_new
    final = weights(slice(None))
    return Model(final[:PLACES], float(final[PLACES]))


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """A model of `labels` (doc_id, quality), learned without held-out rows."""
    sample = labelled_sample(documents, labels, "quality", rows)
    kinds = "doc_id long, label int, places array<int>, shares array<float>"
    table = sample.mapInArrow(_feature_batches, kinds).toArrow()
    order = np.argsort(table["doc_id"].to_numpy(), kind="stable")
    label, places, shares = table["label"].to_pylist(), table["places"], table["shares"]
    return follow_the_leader([(np.asarray(places[i].values), np.asarray(shares[i].values), label[i]) for i in order])


def scores(column: pa.Array, model: Model) -> np.ndarray:
    text, place, count = features(column)
    total = np.bincount(text, model.weights[place], minlength=len(column)) / np.maximum(count, 1)
    return 1 / (1 + np.exp(-np.clip(total + model.bias, -30, 30)))


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted, one row for each row of `documents` (doc_id, text).

    A null or empty text has no features and gets the bias alone. doc_id passes through, null included, which
    is not held out; other columns are not read. An empty table gives an empty one.
    """
    shared = documents.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            for part in slices(batch):
                values = pa.array(scores(part.column("text"), own))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), values], ["doc_id", "score"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = documents.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted")
    )
