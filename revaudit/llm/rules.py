"""Quality rules: text statistics, fixed base rules, and a decision list learned from labels.

The list is learned by sequential covering. A rule is a conjunction of thresholds on statistics; it is
grown one condition at a time by information gain, pruned on rows it was not grown on, and kept while
it is right more often than not there. Rows that it covers leave, and the next rule is grown from the rest.
Rules are emitted as one ordered Spark conditional expression.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revaudit.llm.common import labelled_sample, slices
from revaudit.llm.words import gram_hashes, salted, span_hashes, split_words

#: Most labelled rows that rules are learned from; half of each label while there are enough.
TRAINING_ROWS = 20_000
COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_distinct", "n_lines", "n_letters", "n_upper", "n_marks",
]

_SYMBOLS = np.zeros(256, np.int32)
_SYMBOLS[list(b"#*$%&|<>")] = 1
_MARKS = np.zeros(256, np.int32)
_MARKS[list(b"!?")] = 1
_UPPER = np.zeros(256, np.int32)
_UPPER[ord("A") : ord("Z") + 1] = 1
_LETTER = _UPPER.copy()
_LETTER[ord("a") : ord("z") + 1] = 1
_CHAR = np.ones(256, np.int32)
_CHAR[[9, 10, 11, 12, 13, 32]] = 0
_CHAR[0x80:0xC0] = 0


def _sums(kind: np.ndarray, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(data) + 1, np.int64)
    np.cumsum(kind[data], out=total[1:])
    return np.diff(total[bounds])


def _dup_lines(data: np.ndarray, bounds: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word, and those of them that equal an earlier one."""
    texts = len(bounds) - 1
    breaks = np.flatnonzero(data == 10)
    begin = np.unique(np.concatenate([bounds[:-1], breaks + 1]))
    begin = begin[begin < len(data)]
    nearest = np.searchsorted(breaks, begin)
    brk = np.append(breaks, len(data))[nearest]
    text = np.searchsorted(bounds, begin, side="right") - 1
    end = np.minimum(brk, bounds[text + 1])
    worded = np.searchsorted(start, end) > np.searchsorted(start, begin)
    begin, end, text = begin[worded], end[worded], text[worded]
    key = salted(span_hashes(data, begin, end), text)
    again = np.ones(len(key), bool)
    again[np.unique(key, return_index=True)[1]] = False
    return np.bincount(text, minlength=texts), np.bincount(text[again], minlength=texts)


def count_text(column: pa.Array) -> dict[str, np.ndarray]:
    """The statistics of each text of a column, by the names in COUNTS."""
    words = split_words(column)
    texts, data, bounds = len(column), words.data, words.bounds
    text = words.text_of
    grams, whole = gram_hashes(words, 3)
    at = np.flatnonzero(whole)
    _, kind, times = np.unique(salted(grams[at], text[at]), return_inverse=True, return_counts=True)
    repeated = at[times[kind] > 1]
    covered = np.zeros(len(text), bool)
    for k in range(3):
        covered[repeated + k] = True
    distinct = np.unique(salted(words.hash, text), return_index=True)[1]
    lines, dup_lines = _dup_lines(data, bounds, words.start)
    per_text = lambda picked: np.bincount(picked, minlength=texts).astype(np.int64)
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": _sums(_CHAR, data, bounds),
        "n_symbols": _sums(_SYMBOLS, data, bounds),
        "n_dup_lines": dup_lines.astype(np.int64),
        "n_repeat_words": per_text(text[covered]),
        "n_distinct": per_text(text[distinct]),
        "n_lines": lines.astype(np.int64),
        "n_letters": _sums(_LETTER, data, bounds),
        "n_upper": _sums(_UPPER, data, bounds),
        "n_marks": _sums(_MARKS, data, bounds),
    }


def _count_batches(kept: list[str]):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                counts = count_text(part.column("text"))
                arrays = [part.column(c) for c in kept] + [pa.array(counts[c], pa.int64()) for c in COUNTS]
                yield pa.RecordBatch.from_arrays(arrays, [*kept, *COUNTS])

    return work


def counted(documents: DataFrame, kept: list[str]) -> DataFrame:
    """The kept columns and the statistics of `text`, one row for each row."""
    kinds = {f.name: f.dataType.simpleString() for f in documents.schema}
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in kept), *(f"{c} long" for c in COUNTS)])
    return documents.select(*dict.fromkeys([*kept, "text"])).mapInArrow(_count_batches(kept), schema)


def shares() -> dict[str, Column]:
    """What conditions are about: ratios of statistics, 0 where there is nothing to divide by."""

    def share(part: str, whole: str) -> Column:
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    return {
        "n_words": F.col("n_words").cast("double"),
        "word_length": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "distinct_share": share("n_distinct", "n_words"),
        "upper_share": share("n_upper", "n_letters"),
        "mark_share": share("n_marks", "word_chars"),
    }


@dataclass(frozen=True)
class Condition:
    name: str
    above: bool  # value >= threshold, else value <= threshold
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.name] >= self.threshold if self.above else x[self.name] <= self.threshold

    def column(self) -> Column:
        value = shares()[self.name]
        return value >= self.threshold if self.above else value <= self.threshold


Rule = list[Condition]


def _covers(rule: Rule, x: dict[str, np.ndarray]) -> np.ndarray:
    out = np.ones(len(next(iter(x.values()))), bool)
    for condition in rule:
        out &= condition.holds(x)
    return out


def _grow(x: dict[str, np.ndarray], bad: np.ndarray, most: int) -> Rule:
    rule: Rule = []
    inside = np.ones(len(bad), bool)
    while len(rule) < most and inside.any() and not bad[inside].all():
        p0, n0 = bad[inside].sum(), (~bad[inside]).sum()
        if not p0:
            break
        best, gain = None, 1e-9
        for name, values in x.items():
            here = values[inside]
            for threshold in np.unique(np.quantile(here, np.linspace(0.01, 0.99, 99), method="inverted_cdf")):
                for above in (True, False):
                    hit = here >= threshold if above else here <= threshold
                    p = bad[inside][hit].sum()
                    if p:
                        now = p * (np.log2(p / hit.sum()) - np.log2(p0 / (p0 + n0)))
                        if now > gain:
                            best, gain = Condition(name, above, float(threshold)), now
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x)
    return rule


def _worth(rule: Rule, x: dict[str, np.ndarray], bad: np.ndarray) -> float:
    hit = _covers(rule, x)
    p, n = bad[hit].sum(), (~bad[hit]).sum()
    return (p - n) / (p + n) if p + n else -1.0


def learn(x: dict[str, np.ndarray], bad: np.ndarray, most_rules: int = 12, most_conditions: int = 4) -> list[Rule]:
    """The ordered rules that tell bad rows; rows that none covers are good."""
    rules: list[Rule] = []
    turn = np.arange(len(bad)) % 3 == 2  # every third row prunes
    while len(rules) < most_rules and bad[~turn].any() and bad[turn].any():
        pick = lambda rows: ({k: v[rows] for k, v in x.items()}, bad[rows])
        rule = _grow(*pick(~turn), most_conditions)
        if not rule:
            break
        test = pick(turn)
        lengths = range(1, len(rule) + 1)
        rule = rule[: max(lengths, key=lambda k: (_worth(rule[:k], *test), -k))]
        if _worth(rule, *test) <= 0.5:
            break
        rules.append(rule)
        left = ~_covers(rule, x)
        x, bad, turn = {k: v[left] for k, v in x.items()}, bad[left], turn[left]
    return rules


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that holds, from 1; 0 if none does."""
    out = F.lit(0)
    for number, rule in reversed(list(enumerate(rules, 1))):
        condition = F.lit(True)
        for part in rule:
            condition = condition & part.column()
        out = F.when(condition, number).otherwise(out)
    return out


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> list[Rule]:
    """Rules learned from `labels` (doc_id, quality); none without labelled rows of both kinds."""
    sample = counted(labelled_sample(documents, labels, "quality", rows), ["doc_id", "label"])
    frame = sample.select("doc_id", "label", *(c.alias(f"x_{k}") for k, c in shares().items())).toPandas()
    frame = frame.sort_values(["doc_id", "label", *(f"x_{k}" for k in shares())], kind="stable")
    x = {k: frame[f"x_{k}"].to_numpy(float) for k in shares()}
    return learn(x, frame["label"].to_numpy() == 0)


def judge(documents: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id, the statistics, base_failed, rule (0: none holds) and kept, one row for each row.

    base_failed: fewer than 50 words, or more than half of the words in repeated runs of three. A null
    or blank text has no words and fails. doc_id passes through as it is, null included; other columns are
    not read. An empty table gives an empty one.
    """
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        counted(documents, ["doc_id"])
        .withColumn("base_failed", failed)
        .withColumn("rule", verdict(rules))
        .withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))
    )
