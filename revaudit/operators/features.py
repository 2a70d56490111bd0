"""Feature operators: time, sentiment, per-business and interaction columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revaudit.functions import text as tx
from revaudit.functions.stats import flag, sum_or_zero
from revaudit.operators.scratch import settle
from revaudit.settings import Settings

# A business row is five numbers and an id, so this many stay far below a broadcast's limits.
BROADCAST_BUSINESSES = 200_000
# A business with more than one in this many rows is joined apart from the others.
HOT_SHARE = 2_000


def temporal_features(df: DataFrame) -> DataFrame:
    """Weekday (Monday 0), month, quarter and a weekend flag; a malformed date raises."""
    if "date" not in df.columns:
        return df
    dated = df.withColumn("date", F.col("date").cast("date"))
    day = F.weekday("date")
    return dated.withColumns(
        {
            "day_of_week": day,
            "month": F.month("date"),
            "quarter": F.quarter("date"),
            "is_weekend": flag(day >= 5),
        }
    )


def rating_flags(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    rating = F.col("rating")
    return df.withColumns(
        {
            "is_positive": flag(rating >= settings.positive_from),
            "is_negative": flag(rating <= settings.negative_to),
            "is_neutral": flag(rating == settings.neutral_at),
        }
    )


def lexicon_counts(
    df: DataFrame,
    positive: Sequence[str] = tx.POSITIVE_WORDS,
    negative: Sequence[str] = tx.NEGATIVE_WORDS,
) -> DataFrame:
    cleaned = F.col("cleaned_text")
    return df.withColumns(
        {
            "positive_word_count": tx.lexicon_count(cleaned, positive),
            "negative_word_count": tx.lexicon_count(cleaned, negative),
        }
    )


def sentiment_score(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "sentiment_score", F.col("positive_word_count") - F.col("negative_word_count")
    )


def sentiment_features(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    return rating_flags(df, settings).transform(lexicon_counts).transform(sentiment_score)


def _per_business(df: DataFrame) -> DataFrame:
    return (
        df.filter(F.col("business_id").isNotNull())
        .groupBy("business_id")
        .agg(
            F.avg("rating").alias("business_avg_rating"),
            F.stddev_samp("rating").alias("business_rating_std"),
            F.count("rating").alias("business_review_count"),
            sum_or_zero(F.col("useful_votes")).alias("business_total_useful_votes"),
            F.count(F.lit(1)).alias("rows"),
        )
    )


def business_stats(df: DataFrame) -> DataFrame:
    return _per_business(df).drop("rows")


def settled_stats(df: DataFrame) -> DataFrame:
    """The statistics of all businesses, stored for ``business_features``."""
    return settle(_per_business(df), "business-stats")


def business_features(
    df: DataFrame,
    broadcast_up_to: int = BROADCAST_BUSINESSES,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Add each business's statistics to its reviews; no business, no statistics.

    Hand in a stored table of reviews: a lazily cleaned one would be cleaned again for the
    statistics. ``counted`` comes from ``settled_stats`` if the caller has it already.

    The statistics are computed once and counted. Up to ``broadcast_up_to`` businesses they are
    broadcast and the reviews stay where they are. Beyond that, only businesses holding more
    than 1/HOT_SHARE of the rows are broadcast (there are fewer than HOT_SHARE of those), and
    the reviews of all others, none of them frequent, are shuffled to their statistics.
    """
    if "business_id" not in df.columns:
        return df
    counted = settled_stats(df) if counted is None else counted
    stats = counted.drop("rows")
    order = [*df.columns, *[c for c in stats.columns if c != "business_id"]]
    if counted.limit(broadcast_up_to + 1).count() <= broadcast_up_to:
        return df.join(F.broadcast(stats), "business_id", "left").select(*order)

    reviews = counted.agg(F.sum("rows")).first()[0]
    hot = counted.filter(F.col("rows") > reviews / HOT_SHARE).drop("rows")
    known = F.col("business_id").isNotNull()
    near = df.join(F.broadcast(hot), "business_id", "left").filter(
        ~known | F.col("business_review_count").isNotNull()
    )
    far = (
        df.filter(known)
        .join(F.broadcast(hot.select("business_id")), "business_id", "left_anti")
        .join(stats, "business_id")
    )
    return near.select(*order).unionByName(far.select(*order))


def interaction_features(df: DataFrame) -> DataFrame:
    length = F.col("text_length")
    return df.withColumns(
        {
            "rating_length_interaction": F.col("rating") * length,
            "votes_to_length_ratio": F.try_divide(F.col("useful_votes"), length + 1),
        }
    )


def create_features(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The feature stage over cleaned reviews."""
    return (
        temporal_features(df)
        .transform(sentiment_features, settings)
        .transform(business_features)
        .transform(interaction_features)
    )
