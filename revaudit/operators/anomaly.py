"""Anomaly detection: outliers, suspicious patterns, missing patterns and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revaudit.functions.stats import percent_of, z_score
from revaudit.operators.duplicates import (
    ALL_SETS,
    BY_BUSINESS,
    duplicate_report,
    keyed_reviews,
    repeated_reviews,
)
from revaudit.operators.quantiles import Quantiles, quantiles
from revaudit.operators.subquery import as_scalar, with_scalar
from revaudit.schema import NUMERIC_COLUMNS
from revaudit.settings import Settings

# Pattern names and their descriptions.
SHORT_REVIEWS = ("very_short_reviews", "Reviews with less than 10 characters")
SUSPICIOUS_VOTES = ("suspicious_vote_pattern", "Low ratings with unusually high useful votes")
REPEATED_REVIEWS = ("repeated_reviews_per_business", "Identical reviews for the same business")

# Alert texts.
OUTLIER_ALERT = "⚠️ ALERT: %s outliers detected"
DUPLICATE_ALERT = "⚠️ ALERT: %s duplicate records found"
PATTERN_ALERT = "⚠️ ALERT: %s suspicious patterns detected"
ALL_CLEAR = "✓ No critical anomalies detected"


def _moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row; per column the mean and the population deviation."""
    parts = [
        F.struct(F.avg(name).alias("mean"), F.stddev_pop(name).alias("deviation")).alias(name)
        for name in columns
    ]
    return df.agg(*parts)


def _number(value: float | None) -> Column:
    return F.lit(value).cast("double")


def _iqr_test(name: str, cuts: Quantiles, settings: Settings) -> Column:
    """Outside the column's quartiles, the first two of its cuts."""
    value, first, third = F.col(name), _number(cuts[name][0]), _number(cuts[name][1])
    reach = (third - first) * settings.iqr_multiplier
    return (value < first - reach) | (value > third + reach)


def _z_test(name: str, settings: Settings) -> Column:
    """Far from the mean found in the ``moments`` column."""
    part = F.col(f"moments.`{name}`")
    return z_score(F.col(name), part["mean"], part["deviation"]) > settings.z_limit


def outliers_iqr(df: DataFrame, column: str, settings: Settings = Settings()) -> DataFrame:
    """Rows strictly outside the quartiles by more than 1.5 interquartile ranges."""
    if column not in df.columns:
        return df.filter(F.lit(False))
    return df.filter(_iqr_test(column, quantiles(df, {column: [0.25, 0.75]}), settings))


def outliers_zscore(df: DataFrame, column: str, settings: Settings = Settings()) -> DataFrame:
    """Rows more than three population deviations from the mean."""
    if column not in df.columns:
        return df.filter(F.lit(False))
    measured = with_scalar(df, "moments", _moments(df, [column]))
    return measured.filter(_z_test(column, settings)).drop("moments")


def _outlier_measures(columns: Sequence[str], cuts: Quantiles, settings: Settings) -> Column:
    return F.struct(
        *[
            F.struct(
                F.count_if(_iqr_test(name, cuts, settings)).alias("iqr"),
                F.count_if(_z_test(name, settings)).alias("zscore"),
            ).alias(name)
            for name in columns
        ]
    )


def outlier_counts(
    df: DataFrame, columns: Sequence[str] = NUMERIC_COLUMNS, settings: Settings = Settings()
) -> DataFrame:
    """Number of outliers per column and method, all counted in one scan."""
    present = [name for name in columns if name in df.columns]
    if not present:
        return df.sparkSession.createDataFrame([], "column string, method string, outliers bigint")
    cuts = quantiles(df, {name: [0.25, 0.75] for name in present})
    measured = (
        df.select(*present)
        .transform(with_scalar, "moments", _moments(df, present))
        .agg(_outlier_measures(present, cuts, settings).alias("found"))
    )
    cells = [
        part
        for name in present
        for method in ("iqr", "zscore")
        for part in (F.lit(name), F.lit(method), F.col(f"found.`{name}`.{method}"))
    ]
    return measured.select(
        F.stack(F.lit(2 * len(present)), *cells).alias("column", "method", "outliers")
    )


def outlier_rows(
    df: DataFrame,
    columns: Sequence[str] = NUMERIC_COLUMNS,
    settings: Settings = Settings(),
    cuts: Quantiles | None = None,
) -> DataFrame:
    """Rows that any test finds, with the tests that found them as ``column.method``.

    ``cuts`` comes from ``report_cuts`` if the caller has it already.
    """
    present = [name for name in columns if name in df.columns]
    if not present:
        return df.withColumn("found_by", F.array().cast("array<string>")).filter(F.lit(False))
    cuts = quantiles(df, {name: [0.25, 0.75] for name in present}) if cuts is None else cuts
    tests = [
        F.when(test, F.lit(f"{name}.{method}"))
        for name in present
        for method, test in (
            ("iqr", _iqr_test(name, cuts, settings)),
            ("zscore", _z_test(name, settings)),
        )
    ]
    measured = with_scalar(df, "moments", _moments(df, present))
    found = measured.withColumn("found_by", F.array_compact(F.array(*tests)))
    return found.filter(F.size("found_by") > 0).drop("moments")


def _lowest_ids(hits: DataFrame, first: int) -> DataFrame:
    """The lowest review ids: a top-k, cut in every task."""
    return hits.select("review_id").orderBy(F.col("review_id").asc_nulls_last()).limit(first)


def _first_ids(hits: DataFrame, first: int) -> DataFrame:
    """How many rows were hit, by one count, and the lowest review ids among them."""
    total = hits.agg(F.count(F.lit(1)).alias("n")).scalar()
    return _lowest_ids(hits, first).select(total.alias("matches"), "review_id")


def _is_short(settings: Settings) -> Column:
    return F.col("text_length") < settings.short_text_below


def _has_odd_votes(threshold: float | None, settings: Settings) -> Column:
    return (F.col("useful_votes") > _number(threshold)) & (F.col("rating") <= settings.negative_to)


def _vote_threshold(df: DataFrame, settings: Settings) -> float | None:
    return quantiles(df, {"useful_votes": [settings.vote_quantile]})["useful_votes"][0]


def _no_ids(df: DataFrame) -> DataFrame:
    return df.select(F.lit(0).cast("bigint").alias("matches"), "review_id").filter(F.lit(False))


def suspicious_short(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    if "text_length" not in df.columns:
        return _no_ids(df)
    return _first_ids(df.filter(_is_short(settings)), settings.sample_rows)


def suspicious_votes(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Low ratings whose useful votes exceed the 95th percentile."""
    if not {"useful_votes", "rating"} <= set(df.columns):
        return _no_ids(df)
    odd = _has_odd_votes(_vote_threshold(df, settings), settings)
    return _first_ids(df.filter(odd), settings.sample_rows)


def _pattern_tests(df: DataFrame, threshold: float | None, settings: Settings) -> dict:
    """The test for each pattern whose columns are there, by the pattern's name and description."""
    tests = {}
    if "text_length" in df.columns:
        tests[SHORT_REVIEWS] = _is_short(settings)
    if {"useful_votes", "rating"} <= set(df.columns):
        tests[SUSPICIOUS_VOTES] = _has_odd_votes(threshold, settings)
    return tests


def _has_business_texts(df: DataFrame) -> bool:
    return {"business_id", "text"} <= set(df.columns)


def suspicious_summary(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Each pattern that occurs: type, count and description. Absent columns have no pattern."""
    votes = {"useful_votes", "rating"} <= set(df.columns)
    threshold = _vote_threshold(df, settings) if votes else None
    tests = _pattern_tests(df, threshold, settings)
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(test).alias(kind) for (kind, _), test in tests.items()],
    )
    patterns = list(tests)
    if _has_business_texts(df):
        counted = counted.withColumn(REPEATED_REVIEWS[0], repeated_reviews(df).scalar())
        patterns.append(REPEATED_REVIEWS)
    if not patterns:
        empty = "type string, count bigint, description string"
        return df.sparkSession.createDataFrame([], empty)
    cells = [
        part
        for kind, description in patterns
        for part in (F.lit(kind), F.col(kind), F.lit(description))
    ]
    return counted.select(
        F.stack(F.lit(len(patterns)), *cells).alias("type", "count", "description")
    ).filter(F.col("count") > 0)


def missing_counts(df: DataFrame) -> DataFrame:
    """Columns that have nulls: how many, and their unrounded percentage."""
    nulls = [F.count_if(F.col(name).isNull()).alias(name) for name in df.columns]
    counted = df.agg(F.struct(*nulls).alias("nulls"), F.count(F.lit(1)).alias("rows"))
    cells = [part for name in df.columns for part in (F.lit(name), F.col(f"nulls.`{name}`"))]
    return (
        counted.select(
            "rows", F.stack(F.lit(len(df.columns)), *cells).alias("column", "missing_count")
        )
        .filter(F.col("missing_count") > 0)
        .select(
            "column",
            "missing_count",
            percent_of(F.col("missing_count"), F.col("rows")).alias("missing_percentage"),
        )
    )


def missing_patterns(
    df: DataFrame, first: int | None = None, settings: Settings = Settings()
) -> DataFrame:
    """Per column with nulls: count, percentage and the lowest review ids that lack it.

    The rank limit is applied in every task before the shuffle, so a column that is null in
    most rows sends only a few rows on.
    """
    first = settings.sample_rows if first is None else first
    names = [F.when(F.col(name).isNull(), F.lit(name)) for name in df.columns]
    by_id = Window.partitionBy("column").orderBy(F.col("review_id").asc_nulls_last())
    rows = (
        df.select("review_id", F.explode(F.array_compact(F.array(*names))).alias("column"))
        .withColumn("position", F.row_number().over(by_id))
        .filter(F.col("position") <= first)
    )
    return rows.join(F.broadcast(missing_counts(df)), "column").select(
        "column", "missing_count", "missing_percentage", "position", "review_id"
    )


def _alert(outliers: Column, duplicates: Column, patterns: Column) -> Column:
    lines = F.concat_ws(
        "\n",
        *[
            F.when(count > 0, F.format_string(text, count.cast("string")))
            for text, count in (
                (OUTLIER_ALERT, outliers),
                (DUPLICATE_ALERT, duplicates),
                (PATTERN_ALERT, patterns),
            )
        ],
    )
    return F.when(lines == "", ALL_CLEAR).otherwise(lines)


def report_cuts(df: DataFrame, settings: Settings = Settings()) -> Quantiles:
    """The quartiles of the numeric columns and the vote threshold, from one pass over the table."""
    wanted = {name: [0.25, 0.75] for name in NUMERIC_COLUMNS if name in df.columns}
    if "useful_votes" in wanted:
        wanted["useful_votes"] = [0.25, 0.75, settings.vote_quantile]
    return quantiles(df, wanted)


def _sample(hits: DataFrame) -> Column:
    """The ids of a table of review ids as one array in order."""
    ids = F.collect_list(F.struct("review_id"))
    ordered = F.array_sort(ids, lambda x, y: _nulls_last(x["review_id"], y["review_id"]))
    return hits.agg(F.transform(ordered, lambda x: x["review_id"]).alias("ids")).scalar()


def _nulls_last(x: Column, y: Column) -> Column:
    return (
        F.when(x.isNull(), F.when(y.isNull(), 0).otherwise(1))
        .when(y.isNull(), -1)
        .when(x < y, -1)
        .when(x > y, 1)
        .otherwise(0)
    )


def _missing_listed(df: DataFrame, settings: Settings) -> Column:
    """The columns with nulls, each with count, percentage and the lowest ids."""
    ids = F.transform(
        F.array_sort(F.collect_list(F.struct("position", "review_id"))), lambda x: x["review_id"]
    )
    per_column = (
        missing_patterns(df, settings=settings)
        .groupBy("column", "missing_count", "missing_percentage")
        .agg(ids.alias("sample"))
    )
    rows = F.struct("column", "missing_count", "missing_percentage", "sample")
    return per_column.agg(F.array_sort(F.collect_list(rows)).alias("listed")).scalar()


def stored_keys(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The keys that the duplicate report compares."""
    return keyed_reviews(df, (*ALL_SETS, BY_BUSINESS) if _has_business_texts(df) else ALL_SETS)


def anomaly_report(
    df: DataFrame,
    settings: Settings = Settings(),
    duplicates: DataFrame | None = None,
    cuts: Quantiles | None = None,
) -> DataFrame:
    """One nested row: outliers per column and method, duplicates, patterns, nulls, the alert.

    Duplicates, patterns and columns with nulls come with the lowest review ids that have them; only
    patterns that occur and columns with nulls are listed. ``duplicates`` is the one-row result of
    ``duplicate_report`` and ``cuts`` that of ``report_cuts`` if the caller has them already.
    """
    present = [name for name in NUMERIC_COLUMNS if name in df.columns]
    cuts = report_cuts(df, settings) if cuts is None else cuts
    patterns = _pattern_tests(df, cuts.get("useful_votes", [None])[-1], settings)
    measures = {kind: F.count_if(test) for (kind, _), test in patterns.items()}
    measured = df
    if present:
        measures["outliers"] = _outlier_measures(present, cuts, settings)
        measured = with_scalar(df, "moments", _moments(df, present))
    measures["rows"] = F.count(F.lit(1))
    scanned = measured.agg(*[column.alias(name) for name, column in measures.items()])
    if duplicates is None:
        duplicates = duplicate_report(stored_keys(df), settings.sample_rows)
    none = F.array().cast(f"array<{dict(df.dtypes)['review_id']}>")
    samples = {
        known: _sample(_lowest_ids(df.filter(test), settings.sample_rows))
        for known, test in patterns.items()
    }
    if _has_business_texts(df):
        samples[REPEATED_REVIEWS] = none

    summed = scanned.withColumn("found", as_scalar(duplicates)).withColumns(
        {REPEATED_REVIEWS[0]: F.col("found.repeated_groups"), "missing": _missing_listed(df, settings)}
    )
    listed = [
        F.when(
            F.col(kind) > 0,
            F.struct(
                F.lit(kind).alias("type"),
                F.col(kind).alias("count"),
                F.lit(description).alias("description"),
                sample.alias("sample"),
            ),
        )
        for (kind, description), sample in samples.items()
    ]
    counts = [
        F.col(f"outliers.`{name}`.{method}") for name in present for method in ("iqr", "zscore")
    ]
    occurring = [(F.col(kind) > 0).cast("bigint") for kind, _ in samples]
    summed = summed.withColumns(
        {
            "total_outliers": sum(counts, F.lit(0).cast("bigint")),
            "pattern_types": sum(occurring, F.lit(0).cast("bigint")),
        }
    )
    alert = _alert(
        F.col("total_outliers"), F.col("found.exact_duplicates"), F.col("pattern_types")
    )
    parts = ["outliers"] if present else []
    parts.append(F.col("found").dropFields("repeated_groups").alias("duplicates"))
    if listed:
        parts.append(F.array_compact(F.array(*listed)).alias("suspicious_patterns"))
    return summed.select(
        *parts, F.col("missing").alias("missing_patterns"), "total_outliers", "pattern_types",
        alert.alias("alert"),
    )


def anomaly_alert(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row: the three counts an alert is raised on, and its text."""
    return anomaly_report(df, settings).select(
        "total_outliers",
        F.col("duplicates.exact_duplicates").alias("exact_duplicates"),
        "pattern_types",
        "alert",
    )
