"""Sinks for review tables and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV with a header; doubled quotes and blanks at cell ends survive a round trip."""
    df.write.mode(mode).csv(
        path,
        header=True,
        quote='"',
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def write_json(report: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A one-row report as one JSON document; numbers and booleans keep their types."""
    report.coalesce(1).write.mode(mode).json(path, ignoreNullFields=False)


def write_text(spark: SparkSession, lines: Sequence[str], path: str) -> None:
    """The few lines of a report as one text file."""
    page = spark.createDataFrame([("\n".join(lines),)], "value string")
    page.coalesce(1).write.mode("overwrite").text(path)
