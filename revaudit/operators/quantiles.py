"""Exact linear-interpolated quantiles of whole columns, all columns of a report in one go.

The built-in exact ``percentile`` keeps every distinct value in one buffer of one task. Here the
values are counted once (with map-side combine) and the counts stored. Approximate marks then cut the
counted values into buckets, and every bucket that holds a wanted rank is cut again until it has at
most _BUCKETS values, which are put in order. The marks decide the bucket sizes alone; every rank
comes from exact counts.

The driver holds one round's marks, bucket sizes or last values: at most _BUCKETS rows for each wanted
rank. A column of 10^8 distinct values is cut three times.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revaudit.operators.scratch import settle

_BUCKETS = 512
_MARK_ACCURACY = 5120

#: Quantiles by column, in the order asked for.
Quantiles = dict[str, list[float | None]]


@dataclass
class _Range:
    """Counted values of one column between two of them, and the ranks looked for among them."""

    name: str
    low: float
    high: float
    below: int
    values: int
    ranks: set[int] = field(default_factory=set)

    def holds(self) -> str:
        name = self.name.replace("\\", "\\\\").replace("'", "\\'")
        return f"name = '{name}' AND value >= {_literal(self.low)} AND value <= {_literal(self.high)}"


def _literal(number: float) -> str:
    return f"{number!r}D" if math.isfinite(number) else f"double('{number}')"


def value_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(name, value, n) over all columns, nulls and NaN left out."""
    pairs = [part for name in names for part in (F.lit(name), F.col(f"`{name}`").cast("double"))]
    cells = df.select(F.stack(F.lit(len(names)), *pairs).alias("name", "value"))
    known = cells.filter(F.col("value").isNotNull() & ~F.isnan("value"))
    return known.groupBy("name", "value").agg(F.count(F.lit(1)).alias("n"))


def _tagged(counts: DataFrame, ranges: Sequence[_Range]) -> DataFrame:
    """The counted values within the ranges, each with its range's number."""
    cases = " ".join(f"WHEN {part.holds()} THEN {i}" for i, part in enumerate(ranges))
    inside = " OR ".join(f"({part.holds()})" for part in ranges)
    return counts.filter(inside).withColumn("tag", F.expr(f"CASE {cases} END"))


def _marks(tagged: DataFrame) -> dict[int, list[float]]:
    steps = ", ".join(f"{i / _BUCKETS}D" for i in range(1, _BUCKETS))
    cuts = F.expr(f"percentile_approx(value, array({steps}), {_MARK_ACCURACY})")
    return {r["tag"]: sorted(set(r["marks"])) for r in tagged.groupBy("tag").agg(cuts.alias("marks")).collect()}


def _buckets(tagged: DataFrame, marks: Mapping[int, Sequence[float]]) -> dict[int, list]:
    """Per range its buckets in order: number of rows, lowest and highest value."""
    arrays = " ".join(
        f"WHEN {tag} THEN array({', '.join(_literal(mark) for mark in own)})" for tag, own in marks.items()
    )
    # Binary search for the number of marks below a value, from half the marks down to one.
    halves = F.array(*[F.lit(_BUCKETS >> i) for i in range(1, _BUCKETS.bit_length())])
    bucket = F.aggregate(
        halves,
        F.lit(0),
        lambda place, step: F.when(
            F.get("marks", place + step - 1) < F.col("value"), place + step
        ).otherwise(place),
    )
    sizes = (
        tagged.withColumn("marks", F.expr(f"CASE tag {arrays} END"))
        .groupBy("tag", bucket.alias("bucket"))
        .agg(F.sum("n").alias("size"), F.min("value").alias("low"), F.max("value").alias("high"),
             F.count(F.lit(1)).alias("values"))
    )
    out: dict[int, list] = {}
    for row in sorted(sizes.collect(), key=lambda r: (r["tag"], r["bucket"])):
        out.setdefault(row["tag"], []).append(row)
    return out


def _place(part: _Range, rows: Sequence, rank: int) -> tuple[int, int]:
    """Which of the buckets or values in order holds a rank, and the number of rows before it."""
    ends = list(accumulate((r["size"] for r in rows), initial=part.below))
    at = bisect_right(ends, rank) - 1
    return at, ends[at]


def _narrowed(counts: DataFrame, ranges: Sequence[_Range]) -> list[_Range]:
    """Cut the ranges once; each bucket that holds a wanted rank is a narrower range."""
    tagged = _tagged(counts, ranges)
    left = []
    for tag, rows in _buckets(tagged, _marks(tagged)).items():
        part, narrower = ranges[tag], {}
        for rank in part.ranks:
            at, below = _place(part, rows, rank)
            row = rows[at]
            own = narrower.setdefault(
                at, _Range(part.name, row["low"], row["high"], below, row["values"])
            )
            own.ranks.add(rank)
        left += narrower.values()
    return left


def _found(counts: DataFrame, ranges: Sequence[_Range]) -> dict[tuple[str, int], float]:
    """The values at the wanted ranks of ranges of at most _BUCKETS values."""
    listed: dict[int, list] = {}
    tagged = _tagged(counts, ranges).select("tag", "value", F.col("n").alias("size"))
    for row in sorted(tagged.collect(), key=lambda r: (r["tag"], r["value"])):
        listed.setdefault(row["tag"], []).append(row)
    return {
        (part.name, rank): listed[tag][_place(part, listed[tag], rank)[0]]["value"]
        for tag, part in enumerate(ranges)
        for rank in part.ranks
    }


def quantiles_of_counts(counts: DataFrame, wanted: Mapping[str, Sequence[float]]) -> Quantiles:
    """The quantiles of counted values (name, value, n); read several times, so hand in a stored table."""
    reach = counts.groupBy("name").agg(
        F.sum("n"), F.min("value"), F.max("value"), F.count(F.lit(1))
    )
    places: dict[str, list[float]] = {}
    open_ranges = []
    for name, rows, low, high, values in reach.collect():
        if name in wanted:
            places[name] = [p * (rows - 1) for p in wanted[name]]
            ranks = {rank for place in places[name] for rank in (math.floor(place), math.ceil(place))}
            open_ranges.append(_Range(name, low, high, 0, values, ranks))
    few = []
    while open_ranges:
        few += [part for part in open_ranges if part.values <= _BUCKETS]
        open_ranges = [part for part in open_ranges if part.values > _BUCKETS]
        if open_ranges:
            open_ranges = _narrowed(counts, open_ranges)
    found = _found(counts, few) if few else {}

    def quantile(name: str, place: float) -> float:
        under, over = found[name, math.floor(place)], found[name, math.ceil(place)]
        return under if under == over else under + (over - under) * (place - math.floor(place))

    return {
        name: [quantile(name, place) for place in places[name]] if name in places else [None] * len(probs)
        for name, probs in wanted.items()
    }


def quantiles(df: DataFrame, wanted: Mapping[str, Sequence[float]]) -> Quantiles:
    """Per column its quantiles, in the order asked for; None for a column without values.

    Runs at once: the table is read a single time, for all columns together.
    """
    if not wanted:
        return {}
    return quantiles_of_counts(settle(value_counts(df, list(wanted)), "value-counts"), wanted)


def median(df: DataFrame, name: str) -> Column:
    """The median of a column, computed at once, as a literal."""
    return F.lit(quantiles(df, {name: [0.5]})[name][0]).cast("double")
