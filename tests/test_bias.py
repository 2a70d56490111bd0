from __future__ import annotations

import math

import pytest

from revaudit.operators import bias
from revaudit.plans.report import bias_report


def ratings(spark, values):
    return spark.createDataFrame([(v,) for v in values], "rating long")


def test_positive_bias(spark):
    df = ratings(spark, [5] * 80 + [4] * 10 + [3] * 5 + [2] * 3 + [1] * 2)
    row = bias.rating_bias_verdict(df).first()
    assert row["positive_ratio"] == 0.9
    assert row["bias_detected"] == "Positive bias - over 70% positive reviews"
    assert bias.bias_recommendations(df).count() == 3


def test_balanced_and_negative(spark):
    row = bias.rating_bias_verdict(ratings(spark, [1, 2, 3, 4, 5] * 20)).first()
    assert (row["positive_ratio"], row["negative_ratio"]) == (0.4, 0.4)
    assert row["bias_detected"] == "No significant bias detected"
    negative = ratings(spark, [1, 1, 1, 5])
    assert bias.rating_bias_verdict(negative).first()["bias_detected"].startswith("Negative bias")
    assert bias.bias_recommendations(negative).count() == 2


def test_limits_are_strict_and_nulls_count_as_rows(spark):
    exact = bias.rating_bias_verdict(ratings(spark, [5] * 7 + [3] * 3)).first()
    assert exact["bias_detected"] == "No significant bias detected"
    with_null = bias.rating_bias_verdict(ratings(spark, [5, None])).first()
    assert with_null["positive_ratio"] == 0.5


@pytest.mark.parametrize(
    "values, skewness",
    [([1, 2, 2, 5, 5, 5, 4], -0.382985), ([3, 3, 3], 0.0), ([3, 4], None), ([3], None)],
)
def test_skewness(spark, values, skewness):
    row = bias.rating_summary(ratings(spark, values)).first()
    expected = None if skewness is None else pytest.approx(skewness, abs=1e-6)
    assert row["skewness"] == expected
    if len(values) == 1:
        assert row["std_rating"] is None


def test_distribution_leaves_nulls_out(spark):
    rows = bias.rating_distribution(ratings(spark, [5, 5, 1, None])).collect()
    assert {r["rating"]: r["share"] for r in rows} == {5: pytest.approx(2 / 3), 1: pytest.approx(1 / 3)}


def test_categories_with_a_null(spark):
    df = spark.createDataFrame(
        [("a", 5), (None, 1), ("a", 3), ("b", 4)], "business_category string, rating long"
    )
    rows = {r["category"]: r for r in bias.category_bias(df, "business_category").collect()}
    assert {k: (r["count"], r["percentage"], r["avg_rating"]) for k, r in rows.items()} == {
        "a": (2, 50.0, 4.0), "b": (1, 25.0, 4.0), None: (0, 0.0, None),
    }
    row = bias.category_imbalance(df, "business_category").first()
    assert tuple(row) == (math.inf, "a", "nan")


def test_ties_take_the_lowest_name(spark):
    df = spark.createDataFrame([("b",), ("a",)], "platform string")
    assert tuple(bias.category_imbalance(df, "platform").first()) == (1.0, "a", "a")


def test_length_bins(spark):
    df = spark.createDataFrame(
        [(0, 1), (50, 2), (51, 3), (150, 4), (151, 5), (500, 1)], "text_length long, rating long"
    )
    rows = {r["length_category"]: (r["mean"], r["count"]) for r in bias.length_bias(df).collect()}
    assert rows == {"very_short": (2.0, 1), "short": (3.5, 2), "medium": (3.0, 2), "long": (None, 0)}


def test_correlation(spark):
    df = spark.createDataFrame([(1, 2), (2, 4), (3, None), (4, 8)], "text_length long, rating long")
    assert bias.length_rating_corr(df).first()[0] == pytest.approx(1.0)
    constant = spark.createDataFrame([(1, 2), (2, 2)], "text_length long, rating long")
    assert bias.length_rating_corr(constant).first()[0] is None


def test_monthly_trend_drops_null_dates(spark):
    df = spark.createDataFrame(
        [("2024-01-31", 5), ("2024-01-01", None), ("2024-02-01", 3), (None, 1)],
        "date string, rating long",
    )
    rows = {r["month"]: tuple(r)[1:] for r in bias.monthly_trend(df).collect()}
    assert rows == {"2024-01": (5.0, None, 1), "2024-02": (3.0, None, 1)}


def test_dataset_stats_exact_and_approximate(spark):
    df = spark.createDataFrame(
        [("2024-01-02", "B1", "U1", 4, True), ("2024-01-01", "B2", "U1", 6, False)],
        "date string, business_id string, user_id string, text_length long, "
        "has_owner_response boolean",
    )
    expected = (2, "2024-01-01", "2024-01-02", 2, 1, 5.0, 0.5)
    assert tuple(bias.dataset_stats(df).first()) == expected
    assert tuple(bias.dataset_stats(df, exact=False).first()) == expected


def test_report_lines(spark):
    df = spark.createDataFrame(
        [(5, "a", "web", 10, "2024-01-01"), (4, "a", "app", 60, "2024-02-01"),
         (1, "b", "app", 60, "2024-02-01")],
        "rating long, business_category string, platform string, text_length long, date string",
    )
    lines = bias_report(df, generated_on="2024-03-01 00:00:00")
    assert lines[2] == "Generated on: 2024-03-01 00:00:00"
    for line in (
        "- Mean Rating: 3.33",
        "- Positive Review Ratio: 66.7%",
        "- Negative Review Ratio: 33.3%",
        "- **Bias Status**: No significant bias detected",
        "### business_category_bias",
        "- Imbalance Ratio: 2.00",
        "- Most Common: a",
        "- very_short: 5.00 over 1 reviews",
        "- long: N/A over 0 reviews",
        "- 2024-02: 2.50 over 2 reviews",
        "- No significant bias detected, proceed with standard training",
    ):
        assert line in lines


def test_report_without_optional_columns(spark):
    lines = bias_report(ratings(spark, [5, 5]))
    assert not any(line.startswith("###") for line in lines)


def test_empty_table(spark):
    df = spark.createDataFrame([], "rating long, business_category string, text_length long")
    assert bias.rating_summary(df).first()["mean_rating"] is None
    assert bias.category_bias(df, "business_category").count() == 0
    assert bias.rating_distribution(df).count() == 0
    assert bias.length_bias(df).count() == 4
    assert "- Mean Rating: N/A" in bias_report(df)


def test_absent_columns_have_no_rows(spark):
    df = spark.createDataFrame([("R1", 4.0)], "review_id string, rating double")
    assert bias.category_bias(df, "business_category").count() == 0
    assert bias.length_bias(df).count() == 0
    assert bias.monthly_trend(df).count() == 0
