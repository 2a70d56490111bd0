"""The common values of a column with any number of different values.

A frequent-items summary of bounded size is made per task and merged, or stored per part and united later. Its
counts are at most too high by a known share of the rows, and a value with more rows than that is
always in it. So the values above a given share are all among those it holds; these few are then counted
exactly, in a pass that shuffles one row per task and value. The different values themselves are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revaudit.operators.scratch import settle

#: Fixed value: the largest summary that the built-in functions allow.
MOST_TRACKED = 1_000_000
OTHERS = "(other)"


def error_share(tracked: int) -> float:
    """The share of all rows by which a count may be too high: 3.5 over the table's places, of which
    three quarters are used."""
    return 3.5 * 0.75 / tracked


def tracked_for(share: float) -> int:
    """The summary's size for which the error is at most half of a share."""
    if not 2 * error_share(MOST_TRACKED) <= share <= 1:
        raise ValueError(f"a share must be at most 1 and at least {2 * error_share(MOST_TRACKED)}")
    return max(math.ceil(2 * error_share(1) / share), 64)


def summarise(df: DataFrame, column: str, tracked: int, by: Sequence[str] = ()) -> DataFrame:
    """Per group: rows with a value (n), and the summary of the values. Store it to unite it later."""
    known = df.filter(F.col(column).isNotNull())
    state = F.call_function("approx_top_k_accumulate", F.col(column), F.lit(tracked))
    return known.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), state.alias("state"))


def united(states: DataFrame, tracked: int) -> DataFrame:
    """One summary out of those of all parts, with the same bound on its error."""
    state = F.call_function("approx_top_k_combine", F.col("state"), F.lit(tracked))
    return states.agg(F.sum("n").alias("n"), state.alias("state"))


def bounds(summary: DataFrame, tracked: int) -> DataFrame:
    """value, at_least, at_most and n for each value that a summary holds; any other value has at most
    `error_share(tracked)` of the n rows."""
    held = F.call_function("approx_top_k_estimate", F.col("state"), F.lit(tracked))
    found = summary.filter("n > 0").select("n", F.inline(held)).withColumnsRenamed({"item": "value", "count": "at_most"})
    below = F.col("at_most") - F.floor(F.col("n") * error_share(tracked))
    return found.select("value", F.greatest(below, F.lit(1)).cast("bigint").alias("at_least"), "at_most", "n")


def _counted(df: DataFrame, column: str, candidates: DataFrame) -> DataFrame:
    """Exact rows of each candidate. The candidates are a stored table, so Spark broadcasts them if they are small."""
    value = F.col(column).alias("value")
    return df.select(value).join(candidates, "value", "left_semi").groupBy("value").agg(F.count(F.lit(1)).alias("rows"))


def _summary(df: DataFrame, column: str, tracked: int, states: DataFrame | None) -> DataFrame:
    return united(states, tracked) if states is not None else summarise(df, column, tracked)


def common_values(df: DataFrame, column: str, share: float, states: DataFrame | None = None) -> DataFrame:
    """value and rows of every value that has more than a share of the rows with a value: exact and complete.

    ``states`` are stored summaries of all parts of ``df``, made with ``tracked_for(share)``; without them
    the summary takes a pass of its own. Candidates are fewer than 2 / share.
    """
    tracked = tracked_for(share)
    held = bounds(_summary(df, column, tracked, states), tracked)
    likely = settle(held.filter(F.col("at_most") > F.col("n") * share).select("value", "n"), "candidates")
    total = likely.agg(F.max("n")).scalar()
    return _counted(df, column, likely.select("value")).filter(F.col("rows") > total * share)


def most_common(
    df: DataFrame, column: str, most: int, tracked: int = 10_000, states: DataFrame | None = None
) -> DataFrame:
    """The most common values the summary holds: value, rows and whether their rank is proved.

    Rows are exact. A rank is proved if no value outside the summary can have as many rows. Ties go to the lowest value.
    """
    held = settle(bounds(_summary(df, column, tracked, states), tracked).select("value", "n"), "candidates")
    unseen = held.agg(F.max("n")).scalar() * error_share(tracked)
    counted = _counted(df, column, held.select("value")).orderBy(F.col("rows").desc(), "value").limit(most)
    return counted.withColumn("proved", F.col("rows") > unseen)


def with_others(df: DataFrame, column: str, share: float, others: str = OTHERS) -> DataFrame:
    """The table with all values that have no more than a share of the rows put together as one; the
    column becomes a string, null stays null. Reports by category then have a bounded number of rows."""
    name = "_common" + "_" * max(len(c) for c in df.columns)
    common = settle(common_values(df, column, share).select(F.col("value").alias(name)), "common")
    kept: Column = F.when(F.col(name).isNotNull(), F.col(column).cast("string")).when(F.col(column).isNotNull(), others)
    return df.join(common, F.col(column) == F.col(name), "left").withColumn(column, kept).select(*df.columns)
