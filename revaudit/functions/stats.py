"""Statistics expressions with pandas' null and bias conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """0/1 flag; an unknown condition counts as no."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def share(condition: Column) -> Column:
    """Share of all rows that meet the condition; unknown counts as no."""
    return F.avg(flag(condition).cast("double"))


def percent_of(count: Column, total: Column) -> Column:
    return F.try_divide(count.cast("double"), total.cast("double")) * 100


def sum_or_zero(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def adjusted_skewness(value: Column) -> Column:
    """Bias-adjusted sample skewness: null below three values, 0 for a constant column."""
    n = F.count(value).cast("double")
    factor = F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return (
        F.when(n < 3, F.lit(None).cast("double"))
        .when(F.stddev_pop(value) == 0, F.lit(0.0))
        .otherwise(F.skewness(value) * factor)
    )


def pearson(x: Column, y: Column) -> Column:
    """Correlation over complete pairs; null, not an error, when either side is constant."""
    paired = x.isNotNull() & y.isNotNull()
    left, right = F.when(paired, x.cast("double")), F.when(paired, y.cast("double"))
    spread = F.stddev_pop(left) * F.stddev_pop(right)
    return F.covar_pop(left, right) / F.nullif(spread, F.lit(0.0))


def z_score(value: Column, mean: Column, deviation: Column) -> Column:
    return F.abs(value - mean) / F.nullif(deviation, F.lit(0.0))
