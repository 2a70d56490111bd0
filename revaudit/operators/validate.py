"""Validation: types, ranges, missing values, duplicates and a verdict.

Every check is a set of aggregate expressions; the full report evaluates all of them in one
scan, plus one for the duplicates.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revaudit.functions.stats import percent_of
from revaudit.operators import duplicates as dup
from revaudit.operators.subquery import as_scalar
from revaudit.schema import CRITICAL_COLUMNS, EXPECTED_TYPES
from revaudit.settings import Settings


def _rows() -> Column:
    return F.count(F.lit(1))


def _nulls(name: str) -> Column:
    return F.count_if(F.col(name).isNull())


def _pandas_type(field: T.StructField) -> Column:
    """The pandas type the column's Spark type and content stand for."""
    full = _nulls(field.name) == 0
    if isinstance(field.dataType, T.IntegralType):
        return F.when(full, "int64").otherwise("float64")
    if isinstance(field.dataType, T.FractionalType):
        whole = full & F.bool_and(F.col(field.name) % 1 == 0)
        return F.when(whole, "int64").otherwise("float64")
    if isinstance(field.dataType, T.BooleanType):
        return F.when(full, "bool").otherwise("object")
    return F.lit("object")


def _type_checks(df: DataFrame, expected: Mapping[str, str]) -> dict[str, Column]:
    checks = {}
    for name, wanted in expected.items():
        if name in df.columns:
            actual = _pandas_type(df.schema[name])
            checks[name] = F.struct(
                F.lit(wanted).alias("expected"),
                actual.alias("actual"),
                F.contains(actual, F.lit(wanted)).alias("valid"),
            )
    return checks


def _rating_range(settings: Settings) -> Column:
    rating = F.col("rating")
    low, high = F.min(rating), F.max(rating)
    outside = (rating < settings.rating_low) | (rating > settings.rating_high)
    inside = (low >= settings.rating_low) & (high <= settings.rating_high)
    return F.struct(
        low.alias("min"),
        high.alias("max"),
        F.coalesce(inside, F.lit(False)).alias("valid"),
        F.count_if(outside).alias("out_of_range_count"),
    )


def _length_range() -> Column:
    length = F.col("text_length")
    return F.struct(
        F.min(length).alias("min"),
        F.max(length).alias("max"),
        F.avg(length).alias("mean"),
        F.count_if(length == 0).alias("empty_count"),
    )


def _vote_range() -> Column:
    votes = F.col("useful_votes")
    known_and_fine = F.coalesce(votes >= 0, F.lit(False))
    return F.struct(
        F.count_if(votes < 0).alias("negative_count"),
        F.coalesce(F.bool_and(known_and_fine), F.lit(True)).alias("valid"),
    )


def _range_checks(df: DataFrame, settings: Settings) -> dict[str, Column]:
    checks = {
        "rating": _rating_range(settings),
        "text_length": _length_range(),
        "useful_votes": _vote_range(),
    }
    return {name: check for name, check in checks.items() if name in df.columns}


def _missing(name: str) -> Column:
    return F.struct(
        _nulls(name).alias("missing_count"),
        F.bround(percent_of(_nulls(name), _rows()), 2).alias("missing_percentage"),
        F.lit(name in CRITICAL_COLUMNS).alias("is_critical"),
    )


def _named(columns: Mapping[str, Column]) -> Column:
    return F.struct(*[column.alias(name) for name, column in columns.items()])


def _as_rows(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Evaluate equally shaped structs in one aggregate and return them as rows."""
    cells = [part for name in columns for part in (F.lit(name), F.col(f"checks.`{name}`"))]
    return (
        df.agg(_named(columns).alias("checks"))
        .select(F.stack(F.lit(len(columns)), *cells).alias("column", "check"))
        .select("column", "check.*")
    )


def check_types(df: DataFrame, expected: Mapping[str, str] = EXPECTED_TYPES) -> DataFrame:
    """Expected and actual type of each present column; valid if expected is within actual."""
    return _as_rows(df, _type_checks(df, expected))


def range_rating(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return df.agg(_rating_range(settings).alias("check")).select("check.*")


def range_text_length(df: DataFrame) -> DataFrame:
    return df.agg(_length_range().alias("check")).select("check.*")


def range_votes(df: DataFrame) -> DataFrame:
    return df.agg(_vote_range().alias("check")).select("check.*")


def missing_report(df: DataFrame) -> DataFrame:
    """Null count and percentage (half-even, 2 places) of every column."""
    return _as_rows(df, {name: _missing(name) for name in df.columns})


def acquire_profile(df: DataFrame) -> DataFrame:
    """One row: row count, column count, column names and the number of null cells."""
    nulls = F.lit(0)
    for name in df.columns:
        nulls = nulls + _nulls(name)
    return df.agg(_rows().alias("rows"), nulls.alias("null_cells")).select(
        "rows",
        F.lit(len(df.columns)).cast("bigint").alias("columns"),
        F.array(*[F.lit(name) for name in df.columns]).alias("column_names"),
        "null_cells",
    )


def _issues(df: DataFrame, repeated_ids: Column, nulls: Mapping[str, Column]) -> Column:
    found = [F.when(repeated_ids > 0, "Duplicate review IDs found")]
    found += [
        F.when(nulls[name] > 0, f"Critical column '{name}' has missing values")
        for name in df.columns
        if name in CRITICAL_COLUMNS
    ]
    return F.array_compact(F.array(*found))


def validation_verdict(df: DataFrame) -> DataFrame:
    """One row: passed or not, and why. Only duplicate ids and critical nulls fail a table."""
    critical = [name for name in df.columns if name in CRITICAL_COLUMNS]
    repeated = dup.duplicate_groups(df, [dup.BY_ID]).agg(F.count(F.lit(1)).alias("n")).scalar()
    counts = df.agg(*[_nulls(name).alias(name) for name in critical])
    issues = _issues(df, repeated, {name: F.col(name) for name in critical})
    return counts.select(issues.alias("issues")).select(
        (F.size("issues") == 0).alias("validation_passed"), "issues"
    )


def validation_report(
    df: DataFrame,
    file_path: str | None = None,
    settings: Settings = Settings(),
    duplicates: DataFrame | None = None,
) -> DataFrame:
    """The whole validation as one nested row.

    ``duplicates`` is the one-row result of ``duplicate_report`` if the caller has it already.
    """
    counts = ["duplicate_review_ids", "duplicate_texts", "exact_duplicates"]
    found = dup.duplicate_counts(df) if duplicates is None else duplicates.select(*counts)
    checked = df.agg(
        _rows().alias("total_records"),
        _named(_type_checks(df, EXPECTED_TYPES)).alias("data_types"),
        _named(_range_checks(df, settings)).alias("data_ranges"),
        _named({name: _missing(name) for name in df.columns}).alias("missing_values"),
    )
    nulls = {name: F.col(f"missing_values.`{name}`.missing_count") for name in df.columns}
    whole = checked.withColumn("duplicates", as_scalar(found))
    return whole.withColumn(
        "issues", _issues(df, F.col("duplicates.duplicate_review_ids"), nulls)
    ).select(
        F.lit(file_path).cast("string").alias("file_path"),
        "total_records",
        F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        F.array(*[F.lit(name) for name in df.columns]).alias("column_names"),
        "data_types",
        "data_ranges",
        "missing_values",
        "duplicates",
        (F.size("issues") == 0).alias("validation_passed"),
        "issues",
    )
