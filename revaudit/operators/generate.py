"""Seeded synthetic reviews in two profiles.

Every value is a function of (seed, row id, column), so any id table can be turned into reviews
without a shuffle. Rows with injected nulls or outliers are an exact number of rows with the
lowest draws; they are found through a threshold, never through a list of ids.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revaudit.functions.draws import choice, integer, poisson, uniform
from revaudit.functions.text import sentiment_label
from revaudit.operators.subquery import as_scalar

# Ratings are drawn from these slots with equal chance.
RATING_SLOTS = (1, 1, 2, 2, 3, 3, 3, 4, 4, 4, 4, 5, 5, 5, 5, 5)

# Mean votes per review.
VOTE_RATES = {"useful_votes": 2.0, "funny_votes": 0.5, "cool_votes": 1.0}

# Categories, and the templates and words of the basic profile.
CATEGORIES = ("Restaurant", "Hotel", "Retail", "Healthcare", "Automotive")

BASIC_TEMPLATES = {
    5: (
        "Absolutely amazing {item}! The {aspect} was excellent.",
        "Best experience ever. Highly recommend!",
        "Perfect in every way. Outstanding service.",
    ),
    4: (
        "Really good {item}. The {aspect} was great.",
        "Very satisfied. Would come again.",
        "Good experience overall.",
    ),
    3: (
        "The {item} was okay. Average {aspect}.",
        "Nothing special but decent.",
        "It was fine.",
    ),
    2: (
        "Disappointed with the {item}. Poor {aspect}.",
        "Not worth it. Below expectations.",
        "Would not recommend.",
    ),
    1: (
        "Terrible {item}! Awful {aspect}.",
        "Worst experience ever.",
        "Complete disaster.",
    ),
}
BASIC_WORDS = {
    "item": ("service", "food", "product", "experience"),
    "aspect": ("quality", "staff", "atmosphere", "value"),
}
BASIC_PLATFORMS = ("Google", "Yelp", "Facebook")

# The templates and words of the extended profile.
EXTENDED_TEMPLATES = {
    5: (
        "Absolutely amazing {item}! The {aspect} was {positive_adj} and {positive_adj2}.",
        "Best {item} I've ever experienced. {aspect} exceeded all expectations!",
        "Incredible {aspect}! Will definitely recommend to everyone.",
        "Perfect in every way. The {item} was {positive_adj} beyond words.",
    ),
    4: (
        "Really good {item}. The {aspect} was {positive_adj}.",
        "Great experience overall. Minor issues but {aspect} was {positive_adj}.",
        "Very satisfied with the {item}. {aspect} could be slightly better.",
        "Good {item}, especially the {aspect}. Would come again.",
    ),
    3: (
        "The {item} was okay. {aspect} was average.",
        "Nothing special but decent {item}. {aspect} could improve.",
        "Mixed experience. Some parts good, {aspect} was mediocre.",
        "It was fine. The {item} met basic expectations.",
    ),
    2: (
        "Disappointed with the {item}. {aspect} was {negative_adj}.",
        "Not worth it. The {aspect} was particularly {negative_adj}.",
        "Below expectations. {item} needs major improvements.",
        "Poor {aspect}. Would not recommend this {item}.",
    ),
    1: (
        "Terrible {item}! {aspect} was absolutely {negative_adj}.",
        "Worst experience ever. The {aspect} was {negative_adj} and {negative_adj2}.",
        "Complete disaster. Everything about the {item} was awful.",
        "Unacceptable {aspect}. Never returning.",
    ),
}
_POSITIVE = ("excellent", "outstanding", "fantastic", "wonderful", "exceptional", "great")
_NEGATIVE = ("terrible", "awful", "poor", "disappointing", "unacceptable", "horrible")
EXTENDED_WORDS = {
    "item": ("service", "food", "product", "experience", "facility"),
    "aspect": ("quality", "staff", "atmosphere", "cleanliness", "value", "timing"),
    "positive_adj": _POSITIVE,
    "positive_adj2": _POSITIVE,
    "negative_adj": _NEGATIVE,
    "negative_adj2": _NEGATIVE,
}
EXTENDED_PLATFORMS = ("Google", "Yelp", "Facebook", "TripAdvisor")

NULL_TEXT_SHARE = 0.01
OUTLIER_SHARE = 0.02

_DRAW_BUCKETS = 65536


@dataclass(frozen=True)
class Profile:
    templates: Mapping[int, Sequence[str]]
    words: Mapping[str, Sequence[str]]
    platforms: Sequence[str]
    extended: bool


PROFILES = {
    "basic": Profile(BASIC_TEMPLATES, BASIC_WORDS, BASIC_PLATFORMS, extended=False),
    "extended": Profile(EXTENDED_TEMPLATES, EXTENDED_WORDS, EXTENDED_PLATFORMS, extended=True),
}


def lowest_draws(ids: DataFrame, fraction: float, seed: int, name: str) -> Column:
    """Condition that holds for exactly ``int(fraction * n)`` ids, those with the lowest draws.

    Draws are uniform, so equal-width buckets are even: a histogram of them finds the bucket
    the wanted rank falls in, and only that bucket is put in order to find the threshold.
    """
    drawn = ids.select("id", uniform(seed, F.col("id"), name).alias("u")).withColumn(
        "bucket", F.floor(F.col("u") * _DRAW_BUCKETS)
    )
    # At most _DRAW_BUCKETS rows, whatever the number of ids.
    histogram = drawn.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    everything = Window.partitionBy(F.lit(0))
    reach = histogram.select(
        "bucket",
        "size",
        F.sum("size").over(everything.orderBy("bucket")).alias("upto"),
        F.floor(F.sum("size").over(everything) * F.lit(fraction)).alias("wanted"),
    )
    below = F.col("upto") - F.col("size")
    cut = as_scalar(
        reach.filter((below < F.col("wanted")) & (F.col("upto") >= F.col("wanted"))).select(
            "bucket", (F.col("wanted") - below).alias("rank")
        )
    )
    in_order = Window.partitionBy("bucket").orderBy("u", "id")
    last = (
        drawn.filter(F.col("bucket") == cut["bucket"])
        .withColumn("rank", F.row_number().over(in_order))
        .filter(F.col("rank") == cut["rank"])
        .select(F.struct("u", "id").alias("last"))
        .scalar()
    )
    own = F.struct(uniform(seed, F.col("id"), name).alias("u"), F.col("id").alias("id"))
    return F.coalesce(own <= last, F.lit(False))


def _filled_template(profile: Profile, rating: Column, draw) -> Column:
    ratings = sorted(profile.templates)
    variants = F.array(
        *[F.array(*[F.lit(t) for t in profile.templates[rating_]]) for rating_ in ratings]
    )
    width = len(profile.templates[ratings[0]])
    text = F.element_at(
        F.element_at(variants, rating.cast("int")),
        integer(draw("template"), 1, width).cast("int"),
    )
    for slot, words in profile.words.items():
        text = F.replace(text, F.lit("{" + slot + "}"), choice(draw(slot), words))
    return text


def synthetic_reviews(
    ids: DataFrame, profile: str = "basic", seed: int = 42, as_of: str = "2025-01-01 12:00:00"
) -> DataFrame:
    """One review per row of ``ids`` (a BIGINT column ``id``, unique)."""
    shape = PROFILES[profile]
    row_id = F.col("id").cast("bigint")
    moment = F.lit(as_of).cast("timestamp_ntz")

    def draw(name: str) -> Column:
        return uniform(seed, row_id, name)

    slots = F.array(*[F.lit(slot) for slot in RATING_SLOTS])
    drawn = ids.select(
        row_id.alias("id"),
        F.element_at(slots, integer(draw("rating"), 1, len(RATING_SLOTS)).cast("int"))
        .cast("bigint")
        .alias("rating"),
        *[draw(name).alias(name) for name in VOTE_RATES],
    )
    written = drawn.withColumn("text", _filled_template(shape, F.col("rating"), draw))
    votes = {name: poisson(F.col(name), rate) for name, rate in VOTE_RATES.items()}
    text = F.when(~lowest_draws(ids, NULL_TEXT_SHARE, seed, "null_text"), F.col("text"))
    date = F.date_sub(moment.cast("date"), integer(draw("date"), 0, 365).cast("int"))
    columns = {
        "review_id": F.format_string("R%06d", row_id),
        "business_id": F.format_string("B%04d", integer(draw("business_id"), 1, 100)),
        "user_id": F.format_string("U%05d", integer(draw("user_id"), 1, 1000)),
        "text": text,
        "rating": F.col("rating"),
        "date": F.date_format(date, "yyyy-MM-dd"),
        **votes,
        "text_length": F.length("text").cast("bigint"),
        "business_category": choice(draw("business_category"), CATEGORIES),
        "has_owner_response": draw("has_owner_response") > 0.7,
        "platform": choice(draw("platform"), shape.platforms),
        "sentiment_label": sentiment_label(F.col("rating")),
    }
    if shape.extended:
        columns = _extended(columns, ids, seed, moment, draw)
    return written.select(*[column.alias(name) for name, column in columns.items()])


def _extended(
    columns: dict[str, Column], ids: DataFrame, seed: int, moment: Column, draw
) -> dict[str, Column]:
    """The basic columns with the extended ones in their places, and one outlier value."""
    one_value = integer(uniform(seed, F.lit(0), "outlier_value"), 100, 500)
    is_outlier = lowest_draws(ids, OUTLIER_SHARE, seed, "outlier")
    hours = integer(draw("response_hours"), 1, 168).cast("double")
    added = {
        "date": {"time": F.date_format(moment, "HH:mm:ss")},
        "business_category": {
            "response_time_hours": F.when(draw("has_response_time") > 0.7, hours)
        },
        "has_owner_response": {"verified_purchase": draw("verified_purchase") > 0.2},
        "platform": {"language": F.lit("en")},
    }
    out: dict[str, Column] = {}
    for name, column in columns.items():
        out[name] = column
        out.update(added.get(name, {}))
    out["useful_votes"] = F.when(is_outlier, one_value).otherwise(columns["useful_votes"])
    return out


def synthetic_votes(ids: DataFrame, seed: int = 42) -> DataFrame:
    """Poisson votes per id, the same as in the full reviews."""
    drawn = ids.select("id", *[uniform(seed, F.col("id"), n).alias(n) for n in VOTE_RATES])
    return drawn.select("id", *[poisson(F.col(n), rate).alias(n) for n, rate in VOTE_RATES.items()])


def generate_reviews(
    spark: SparkSession, n: int = 5000, profile: str = "basic", seed: int = 42, **options
) -> DataFrame:
    """``n`` synthetic reviews with ids 0 to n - 1."""
    return synthetic_reviews(spark.range(n), profile, seed, **options)


def sample_head(df: DataFrame, n: int = 100) -> DataFrame:
    """The first ``n`` reviews by id; equal ids are ordered by their other columns."""
    rest = [c for c in ("user_id", "date", "text") if c in df.columns]
    keys = [F.col(c).asc_nulls_last() for c in ("review_id", *rest)]
    return df.orderBy(*keys).limit(n)
