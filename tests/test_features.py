from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from revaudit.operators import features


def test_weekdays(spark):
    df = spark.createDataFrame([("2024-01-06",), ("2024-01-08",), (None,)], "date string")
    rows = features.temporal_features(df).orderBy(F.col("date").asc_nulls_last()).collect()
    assert [(r["day_of_week"], r["is_weekend"], r["quarter"]) for r in rows] == [
        (5, 1, 1), (0, 0, 1), (None, 0, None),
    ]


def test_malformed_date_raises(spark):
    df = spark.createDataFrame([("2024-13-01",)], "date string")
    with pytest.raises(Exception, match="2024-13-01"):
        features.temporal_features(df).collect()


def test_rating_flags_of_halves_and_nulls(spark):
    df = spark.createDataFrame([(4.0,), (2.0,), (3.0,), (3.5,), (None,)], "rating double")
    flags = [tuple(r)[1:] for r in features.rating_flags(df).collect()]
    assert flags == [(1, 0, 0), (0, 1, 0), (0, 0, 1), (0, 0, 0), (0, 0, 0)]


def hot_reviews(spark, n=9000):
    """A third of all rows in one business, a third in none, the rest spread over many."""
    business = (
        F.when(F.col("id") % 3 == 0, "HOT")
        .when(F.col("id") % 3 == 1, F.lit(None))
        .otherwise(F.concat(F.lit("B"), (F.col("id") % 2500).cast("string")))
    )
    return spark.range(n).select(
        F.col("id").alias("review_id"),
        business.alias("business_id"),
        (F.col("id") % 5 + 1).alias("rating"),
        F.when(F.col("id") % 7 > 0, F.col("id") % 11).alias("useful_votes"),
    )


def test_business_features_agree_on_both_sides_of_the_broadcast_limit(spark):
    reviews = hot_reviews(spark)
    small = features.business_features(reviews)
    large = features.business_features(reviews, broadcast_up_to=10)
    assert small.columns == large.columns
    rows = sorted(map(str, small.collect()))
    assert len(rows) == 9000
    assert rows == sorted(map(str, large.collect()))
    plan = large._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_business_features_by_hand(spark):
    df = spark.createDataFrame(
        [("A", 5, 1), ("A", 3, None), ("A", None, 2), ("B", 4, None), (None, 1, 9)],
        "business_id string, rating long, useful_votes long",
    )
    out = features.business_features(df).collect()
    stats = {r["business_id"]: tuple(r)[3:] for r in out}
    assert len(out) == 5
    assert stats == {
        "A": (4.0, pytest.approx(2**0.5), 2, 3),
        "B": (4.0, None, 1, 0),
        None: (None, None, None, None),
    }


def test_interactions(spark):
    df = spark.createDataFrame([(4.0, 9, 5)], "rating double, text_length long, useful_votes long")
    row = features.interaction_features(df).first()
    assert (row["rating_length_interaction"], row["votes_to_length_ratio"]) == (36.0, 0.5)
