"""One-row results as scalar subqueries, so no operator joins a table with a single row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_scalar(one_row: DataFrame) -> Column:
    """The single row as one struct-valued scalar; take its parts with ``["name"]``."""
    return one_row.select(F.struct("*").alias("row")).scalar()


def with_scalar(df: DataFrame, name: str, one_row: DataFrame) -> DataFrame:
    """Add the single row as a struct column.

    Referring to the column keeps one subquery in the plan, however many of its parts are used.
    """
    return df.withColumn(name, as_scalar(one_row))


def row_total(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()
