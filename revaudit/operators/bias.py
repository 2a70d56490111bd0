"""Bias analysis of ratings: overall, per category, per month and per text length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revaudit.functions.stats import adjusted_skewness, pearson, percent_of, share
from revaudit.operators.facts import facts
from revaudit.operators.quantiles import median
from revaudit.schema import CATEGORY_COLUMNS
from revaudit.settings import Settings

# Length bins, open at the left end and closed at the right.
LENGTH_BINS = (
    ("very_short", 0, 50),
    ("short", 50, 150),
    ("medium", 150, 500),
    ("long", 500, None),
)

# The verdict of each case.
POSITIVE_BIAS = "Positive bias - over 70% positive reviews"
NEGATIVE_BIAS = "Negative bias - over 50% negative reviews"
NO_BIAS = "No significant bias detected"

# The advice that goes with each verdict.
ADVICE = {
    POSITIVE_BIAS: (
        "1. **Oversample negative reviews** to balance the dataset",
        "2. **Apply class weights** during model training",
        "3. **Use stratified sampling** for train/test splits",
    ),
    NEGATIVE_BIAS: (
        "1. **Oversample positive reviews** to balance the dataset",
        "2. **Consider synthetic data generation** for positive examples",
    ),
    NO_BIAS: ("- No significant bias detected, proceed with standard training",),
}


def dataset_stats(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row: rows, date range, businesses, users, mean length, owner-response rate."""
    distinct = F.count_distinct if exact else F.approx_count_distinct
    return df.agg(
        F.count(F.lit(1)).alias("reviews"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        distinct("business_id").alias("businesses"),
        distinct("user_id").alias("users"),
        F.avg("text_length").alias("mean_text_length"),
        F.avg(F.col("has_owner_response").cast("double")).alias("response_rate"),
    )


def rating_counts(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("rating").isNotNull())
        .groupBy("rating")
        .agg(F.count(F.lit(1)).alias("reviews"))
    )


def rating_distribution(df: DataFrame) -> DataFrame:
    """Share of each rating among the known ones."""
    known = df.agg(F.count("rating").alias("n")).scalar()
    return rating_counts(df).select("rating", (F.col("reviews") / known).alias("share"))


def _shares(settings: Settings) -> dict[str, Column]:
    rating = F.col("rating")
    return {
        "positive_ratio": share(rating >= settings.positive_from),
        "negative_ratio": share(rating <= settings.negative_to),
        "neutral_ratio": share(rating == settings.neutral_at),
    }


def _verdict(settings: Settings) -> Column:
    return (
        F.when(F.col("positive_ratio") > settings.positive_share_limit, POSITIVE_BIAS)
        .when(F.col("negative_ratio") > settings.negative_share_limit, NEGATIVE_BIAS)
        .otherwise(NO_BIAS)
    )


def rating_summary(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row: centre, spread and skew of the ratings, and the shares over all rows."""
    rating = F.col("rating")
    return df.agg(
        F.avg(rating).alias("mean_rating"),
        F.stddev_samp(rating).alias("std_rating"),
        adjusted_skewness(rating).alias("skewness"),
        *[column.alias(name) for name, column in _shares(settings).items()],
    ).withColumn("median_rating", median(df, "rating"))


def rating_bias_verdict(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    shares = df.agg(*[column.alias(name) for name, column in _shares(settings).items()])
    return shares.withColumn("bias_detected", _verdict(settings))


def bias_recommendations(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The advice that follows from the verdict, one line per row."""
    listed = [
        part
        for verdict, lines in ADVICE.items()
        for part in (F.lit(verdict), F.array(*[F.lit(line) for line in lines]))
    ]
    advice = F.element_at(F.create_map(*listed), F.col("bias_detected"))
    return rating_bias_verdict(df, settings).select(
        F.posexplode(advice).alias("position", "line")
    ).withColumn("position", F.col("position") + 1)


def _per_category(df: DataFrame, category: str) -> DataFrame:
    """Per value: count, mean and deviation of the rating; the missing value has count 0."""
    known = F.col("category").isNotNull()
    return (
        df.select(F.col(category).cast("string").alias("category"), "rating")
        .groupBy("category")
        .agg(
            F.count("category").alias("count"),
            F.avg(F.when(known, F.col("rating"))).alias("avg_rating"),
            F.stddev_samp(F.when(known, F.col("rating"))).alias("rating_std"),
            F.count(F.lit(1)).alias("rows"),
        )
    )


def _category_table(groups: DataFrame) -> DataFrame:
    """The groups with percentages of all rows, which the groups themselves add up to."""
    total = groups.agg(F.sum("rows").alias("n")).scalar()
    return groups.withColumn("percentage", percent_of(F.col("count"), total)).drop("rows")


def _imbalance(groups: DataFrame) -> DataFrame:
    name = F.coalesce("category", F.lit("nan"))
    largest, smallest = F.max("count"), F.min("count")
    # Names tell groups apart already; reading the other columns keeps one grouping in the plan.
    rest = [F.col(c) for c in groups.columns if c not in ("category", "count")]
    return groups.agg(
        F.when(smallest > 0, largest / smallest)
        .when(smallest == 0, F.lit(float("inf")))
        .alias("imbalance_ratio"),
        F.min_by(name, F.struct(-F.col("count"), name, *rest)).alias("most_common"),
        F.min_by(name, F.struct("count", name, *rest)).alias("least_common"),
    )


def category_bias(df: DataFrame, category: str) -> DataFrame:
    """Per value: count, percentage of all rows, mean and deviation of the rating.

    Rows without a value form a group of count 0 without statistics. An absent column has no rows.
    """
    if category not in df.columns:
        empty = "category string, count bigint, avg_rating double, rating_std double, percentage double"
        return df.sparkSession.createDataFrame([], empty)
    return _category_table(_per_category(df, category))


def category_imbalance(df: DataFrame, category: str) -> DataFrame:
    """One row: largest over smallest count, and both values' names; ties take the lowest name."""
    counts = (
        df.select(F.col(category).cast("string").alias("category"))
        .groupBy("category")
        .agg(F.count("category").alias("count"))
    )
    return _imbalance(counts)


def monthly_trend(df: DataFrame) -> DataFrame:
    """Per calendar month: mean, deviation and number of ratings; no rows without dates."""
    if "date" not in df.columns:
        empty = "month string, avg_rating double, rating_std double, count bigint"
        return df.sparkSession.createDataFrame([], empty)
    return (
        df.select(F.date_format(F.col("date").cast("date"), "yyyy-MM").alias("month"), "rating")
        .filter(F.col("month").isNotNull())
        .groupBy("month")
        .agg(
            F.avg("rating").alias("avg_rating"),
            F.stddev_samp("rating").alias("rating_std"),
            F.count("rating").alias("count"),
        )
    )


def _length_bins() -> Column:
    length, rating = F.col("text_length"), F.col("rating")
    bins = []
    for label, above, upto in LENGTH_BINS:
        inside = (length > above) if upto is None else (length > above) & (length <= upto)
        bins.append(
            F.struct(
                F.avg(F.when(inside, rating)).alias("mean"),
                F.count(F.when(inside, rating)).alias("count"),
            ).alias(label)
        )
    return F.struct(*bins)


def length_bias(df: DataFrame) -> DataFrame:
    """Mean and number of ratings per text-length bin, empty bins included; none without lengths."""
    if "text_length" not in df.columns:
        empty = "length_category string, mean double, count bigint"
        return df.sparkSession.createDataFrame([], empty)
    labels = [label for label, *_ in LENGTH_BINS]
    cells = [part for label in labels for part in (F.lit(label), F.col(f"bins.{label}"))]
    return (
        df.agg(_length_bins().alias("bins"))
        .select(F.stack(F.lit(len(labels)), *cells).alias("length_category", "bin"))
        .select("length_category", "bin.mean", "bin.count")
    )


def length_rating_corr(df: DataFrame) -> DataFrame:
    return df.agg(pearson(F.col("text_length"), F.col("rating")).alias("correlation"))


def category_tables(df: DataFrame) -> dict[str, DataFrame]:
    """The grouping of each category column that is there."""
    return {c: _per_category(df, c) for c in CATEGORY_COLUMNS if c in df.columns}


def bias_summary(
    df: DataFrame,
    settings: Settings = Settings(),
    categories: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """One nested row: rating summary and verdict, length bins, imbalance per category column."""
    rating = F.col("rating")
    measures = [
        F.avg(rating).alias("mean_rating"),
        F.stddev_samp(rating).alias("std_rating"),
        adjusted_skewness(rating).alias("skewness"),
        *[column.alias(name) for name, column in _shares(settings).items()],
    ]
    if "text_length" in df.columns:
        measures += [
            F.struct(
                _length_bins().alias("length_categories"),
                pearson(F.col("text_length"), rating).alias("correlation"),
            ).alias("text_length_bias")
        ]
    scanned = df.agg(*measures)
    distribution = F.struct(
        "mean_rating",
        median(df, "rating").alias("median_rating"),
        "std_rating",
        "skewness",
        "positive_ratio",
        "negative_ratio",
        "neutral_ratio",
        _verdict(settings).alias("bias_detected"),
    )
    parts = [distribution.alias("rating_distribution")]
    if "text_length" in df.columns:
        parts.append(F.col("text_length_bias"))
    for category, groups in (category_tables(df) if categories is None else categories).items():
        imbalance = _imbalance(groups).select(F.struct("*")).scalar()
        parts.append(imbalance.alias(f"{category}_bias"))
    return scanned.select(*parts)


def _table_facts(table: DataFrame, section: str, key: str) -> DataFrame:
    """Rows of a keyed table as (path, number, label), the key within the path."""
    values = [name for name in table.columns if name != key]
    start = F.concat(F.lit(f"{section}."), F.coalesce(F.col(key).cast("string"), F.lit("nan")))
    cells = []
    for name in values:
        cells += [F.concat(start, F.lit(f".{name}")), F.col(name).cast("double")]
    return table.select(F.stack(F.lit(len(values)), *cells).alias("path", "number")).withColumn(
        "label", F.lit(None).cast("string")
    )


def bias_analysis(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The whole analysis as (path, number, label) rows; its size may grow with the categories."""
    return bias_facts(bias_summary(df, settings), *bias_tables(df))


def bias_tables(df: DataFrame) -> tuple[DataFrame, dict[str, DataFrame], DataFrame | None]:
    """Ratings, categories and months, each counted once."""
    months = monthly_trend(df) if "date" in df.columns else None
    return rating_counts(df), category_tables(df), months


def bias_facts(
    summary: DataFrame,
    ratings: DataFrame,
    categories: dict[str, DataFrame],
    months: DataFrame | None,
) -> DataFrame:
    """The parts of the analysis as one table of facts."""
    known = ratings.agg(F.sum("reviews").alias("n")).scalar()
    shares = ratings.select("rating", (F.col("reviews") / known).alias("share"))
    out = facts(summary).unionByName(
        _table_facts(shares, "rating_distribution.distribution", "rating")
    )
    for category, groups in categories.items():
        section = f"{category}_bias.categories"
        out = out.unionByName(_table_facts(_category_table(groups), section, "category"))
    if months is not None:
        out = out.unionByName(_table_facts(months, "temporal_bias.monthly_trend", "month"))
    return out
