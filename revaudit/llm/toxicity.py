"""Toxicity by multiple-instance learning: sentence scores, combined by noisy-or, from document labels.

A document is toxic if at least one of its sentences is. Its probability is 1 minus the product of
(1 - p) over its sentences, each p a logistic score of the sentence's hashed words and word beginnings. Only
documents are labelled; the gradient of a toxic document goes to the sentences that already score highest,
so the trained model also tells where the offence is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revaudit.llm.common import held_out, labelled_sample, slices
from revaudit.llm.tokens import Tokens, split_tokens
from revaudit.llm.words import lists, mixed, span_hashes

#: Most labelled rows that the weights are learned from; half of each label while there are enough.
TRAINING_ROWS = 4_000
PLACES = 1 << 20
CUT = 0.5
#: Bytes of a word's beginning that are features besides the whole word.
BEGINNINGS = (4, 5, 6)
#: Features of a smaller share of the training documents than this have no weight: 8 of 4,000.
LEAST_SHARE = 0.002


@dataclass
class Sentences:
    text: np.ndarray  # the text of each sentence
    start: np.ndarray  # first byte of its first word, from the start of its text
    end: np.ndarray
    of: np.ndarray  # the sentence of each feature
    place: np.ndarray


def _ends(t: Tokens) -> np.ndarray:
    """Whether a sentence ends after each token: before a line feed, or . ! ? before a space or the end."""
    last = np.ones(len(t.start), bool)
    if len(t.start):
        gap = t.start[1:] > t.end[:-1]
        breaks = np.concatenate([[0], np.cumsum(t.data == 10)])
        stop = np.isin(t.data[t.end[:-1] - 1], list(b".!?")) & gap
        last[:-1] = stop | (breaks[t.start[1:]] > breaks[t.end[:-1]]) | (t.text[1:] != t.text[:-1])
    return last


def split_sentences(column: pa.Array) -> Sentences:
    t = split_tokens(column)
    last = _ends(t)
    ends = np.flatnonzero(last)
    begins = np.concatenate([[0], ends[:-1] + 1]).astype(np.int64) if len(ends) else ends
    sentence = np.cumsum(last) - last
    letters = t.kind == 1
    of, hashes = [sentence[letters]], [t.hash[letters]]
    for size in BEGINNINGS:
        long = letters & (t.end - t.start > size)
        of.append(sentence[long])
        hashes.append(mixed(span_hashes(t.data, t.start[long], t.start[long] + size) + np.uint64(size)))
    text = t.text[begins]
    low = t.bounds[text]
    places = (np.concatenate(hashes) >> np.uint64(44)).astype(np.int64)
    return Sentences(text, t.start[begins] - low, t.end[ends] - low, np.concatenate(of), places)


@dataclass
class Model:
    weights: np.ndarray
    bias: float


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch):
            s = split_sentences(part.column("text"))
            order = np.argsort(s.text[s.of], kind="stable")
            text = s.text[s.of][order]
            first = np.searchsorted(s.text, np.arange(part.num_rows))
            sizes = np.bincount(text, minlength=part.num_rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").cast(pa.int64()), part.column("label"),
                 pa.array(np.bincount(s.text, minlength=part.num_rows), pa.int32()),
                 lists((s.of[order] - first[text]).astype(np.int32), sizes, pa.int32()),
                 lists(s.place[order].astype(np.int32), sizes, pa.int32())],
                ["doc_id", "label", "sentences", "of", "places"],
            )


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))


def noisy_or(z: np.ndarray, text: np.ndarray, texts: int) -> np.ndarray:
    """1 minus the product of 1 - p over the sentences of each text; 0 without sentences."""
    return -np.expm1(-np.bincount(text, _softplus(z), minlength=texts))


def fit(
    of: np.ndarray, place: np.ndarray, text: np.ndarray, label: np.ndarray, weight: np.ndarray,
    passes: int = 100, rate: float = 1.0, l1: float = 3e-5, start: float = -11.0,
) -> Model:
    """Minimise the weighted log-loss of the noisy-or by full gradient steps with per-weight rates (AdaGrad).

    of: the sentence of each feature; text: the text of each sentence. An L1 penalty drops the weights of
    words that happen to be near offences. The bias starts so low that the many sentences of a long text don't
    add up. Without texts of both labels every text scores as the label there is; without any, 0.
    """
    if len(set(label.tolist())) < 2:
        return Model(np.zeros(PLACES), 30.0 if label.any() else -30.0)
    places = np.flatnonzero(np.bincount(place, minlength=PLACES))
    at = np.searchsorted(places, place)
    w, b = np.zeros(len(places)), start
    past, past_b = np.full(len(places), 1e-8), 1e-8
    total = weight.sum()
    for _ in range(passes):
        z = b + np.bincount(of, w[at], minlength=len(text))
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        rest = np.minimum(np.bincount(text, _softplus(z), minlength=len(label)), 50)
        pull = np.where(label == 1, -1 / np.maximum(np.expm1(rest), 1e-9), 1.0) * weight
        slope = pull[text] * p
        g = np.bincount(at, slope[of], minlength=len(places)) / total
        gb = slope.sum() / total
        past += g * g
        past_b += gb * gb
        step = rate / np.sqrt(past)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        b -= 0.2 * rate * gb / np.sqrt(past_b)
    weights = np.zeros(PLACES)
    weights[places] = w
    return Model(weights, float(b))


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model:
    """A model of `labels` (doc_id, toxic), learned without held-out rows.

    Words of a smaller share of the sample's texts than LEAST_SHARE have no weight. The sample has more toxic texts than the labels do; texts are weighted back to the labels' shares.
    """
    sample = labelled_sample(documents, labels, "toxic", rows)
    kinds = "doc_id long, label int, sentences int, of array<int>, places array<int>"
    table = sample.mapInArrow(_feature_batches, kinds).toArrow()
    order = np.argsort(table["doc_id"].to_numpy(), kind="stable")
    label = table["label"].to_numpy()[order].astype(np.int64)
    if not len(label):
        return fit(*(np.zeros(0, np.int64),) * 4, np.zeros(0))
    counts = labels.where(~held_out(F.col("doc_id"))).groupBy("toxic").count().where("toxic in (0, 1)").collect()
    share = {int(r["toxic"]): r["count"] / max((label == int(r["toxic"])).sum(), 1) for r in counts}
    sentences = table["sentences"].to_numpy()[order].astype(np.int64)
    first = np.cumsum(sentences) - sentences
    seen = np.zeros(PLACES, np.int32)
    for row in table["places"]:
        seen[np.unique(row.values)] += 1
    often, of, place = seen >= max(LEAST_SHARE * len(label), 1), [], []
    for begin, i in zip(first, order, strict=True):
        own = np.asarray(table["places"][i].values)
        kept = often[own]
        place.append(own[kept])
        of.append((np.asarray(table["of"][i].values)[kept] + begin).astype(np.int32))
    del table
    text = np.repeat(np.arange(len(label)), sentences)
    weight = np.where(label == 1, share.get(1, 1.0), share.get(0, 1.0))
    return fit(np.concatenate(of), np.concatenate(place), text, label, weight)


def _score_batches(shared, least: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            for part in slices(batch):
                s = split_sentences(part.column("text"))
                z = bias + np.bincount(s.of, weights[s.place], minlength=len(s.text))
                score = noisy_or(z, s.text, part.num_rows)
                bad = np.flatnonzero(1 / (1 + np.exp(-np.clip(z, -30, 30))) >= least)
                spans = pa.StructArray.from_arrays(
                    [pa.array(s.start[bad], pa.int32()), pa.array(s.end[bad], pa.int32())], ["start", "end"]
                )
                offsets = np.concatenate([[0], np.cumsum(np.bincount(s.text[bad], minlength=part.num_rows))])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(score),
                     pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)],
                    ["doc_id", "score", "offences"],
                )

    return work


def score(documents: DataFrame, model: Model, least: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted and offences, one row for each row of `documents` (doc_id, text).

    offences are the sentences that reach `least`, as byte positions (start, end) in the UTF-8 text. A null, empty or blank
    text has no sentences and scores 0. doc_id passes through, null included, which is not held out;
    other columns are not read. An empty table gives an empty one.
    """
    shared = documents.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))
    kind = documents.schema["doc_id"].dataType.simpleString()
    scored = documents.select("doc_id", "text").mapInArrow(
        _score_batches(shared, least), f"doc_id {kind}, score double, offences array<struct<start:int,end:int>>"
    )
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"), "offences",
    )


def reject(documents: DataFrame, model: Model, least: float = CUT) -> DataFrame:
    """The documents whose score is below `least`, with all their columns; null and empty texts stay."""
    shared = documents.sparkSession.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        for batch in batches:
            for part in slices(batch):
                s = split_sentences(part.column("text"))
                z = bias + np.bincount(s.of, weights[s.place], minlength=len(s.text))
                yield part.filter(pa.array(noisy_or(z, s.text, part.num_rows) < least))

    return documents.mapInArrow(work, documents.schema)
