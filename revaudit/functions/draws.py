"""Random draws that depend only on (seed, row id, draw name).

The same row always gets the same values, however the data is partitioned and however often
a task is retried.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_HEX_DIGITS = 13


def uniform(seed: int, row_id: Column, name: str) -> Column:
    """Uniform double in [0, 1) from the first 52 bits of a digest."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), row_id.cast("string"), F.lit(name)))
    number = F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("double")
    return number / F.lit(float(16**_HEX_DIGITS))


def integer(u: Column, low: int, high: int) -> Column:
    """Whole number from low to high, both included."""
    return (F.floor(u * F.lit(float(high - low + 1))) + low).cast("bigint")


def choice(u: Column, values: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), integer(u, 1, len(values)).cast("int"))


def poisson_cdf(rate: float) -> list[float]:
    """Cumulative probabilities of 0, 1, 2, … up to the last one a double can tell from 1."""
    term = total = math.exp(-rate)
    steps = [total]
    while total < 1.0 - 1e-15 and term > 1e-18:
        term *= rate / len(steps)
        total += term
        steps.append(total)
    return steps


def poisson(u: Column, rate: float) -> Column:
    """Inverse-distribution draw: the number of cumulative steps at or below u."""
    steps = poisson_cdf(rate)
    drawn = F.when(u < steps[0], 0)
    for votes, step in enumerate(steps[1:], 1):
        drawn = drawn.when(u < step, votes)
    return drawn.otherwise(len(steps)).cast("bigint")
