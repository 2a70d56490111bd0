from __future__ import annotations

import pytest

from revaudit.operators import validate
from revaudit.operators.facts import facts


def test_types(spark):
    df = spark.createDataFrame(
        [("R1", 5, "Good"), ("R2", 4, "Great")], "review_id string, rating long, text string"
    )
    found = {r["column"]: (r["actual"], r["valid"]) for r in validate.check_types(df).collect()}
    assert found == {
        "review_id": ("object", True), "rating": ("int64", True), "text": ("object", True),
    }


@pytest.mark.parametrize(
    "rows, kind, actual",
    [
        ([(1,), (None,)], "long", "float64"),
        ([(1.0,), (2.0,)], "double", "int64"),
        ([(1.5,), (2.0,)], "double", "float64"),
        ([(1.0,), (None,)], "double", "float64"),
    ],
)
def test_type_of_numbers(spark, rows, kind, actual):
    df = spark.createDataFrame(rows, f"rating {kind}")
    assert validate.check_types(df).first()["actual"] == actual


def test_ranges(spark):
    df = spark.createDataFrame(
        [(1, 0, 10), (2, 1, 20), (3, 2, 30), (4, 3, 40), (5, 4, 50)],
        "rating long, useful_votes long, text_length long",
    )
    assert tuple(validate.range_rating(df).first()) == (1, 5, True, 0)
    assert tuple(validate.range_text_length(df).first()) == (10, 50, 30.0, 0)
    assert tuple(validate.range_votes(df).first()) == (0, True)


def test_ranges_with_nulls_and_without_rows(spark):
    df = spark.createDataFrame([(0, None), (6, -1)], "rating long, useful_votes long")
    assert tuple(validate.range_rating(df).first()) == (0, 6, False, 2)
    assert tuple(validate.range_votes(df).first()) == (1, False)
    nulls = spark.createDataFrame([(None, None)], "rating long, useful_votes long")
    assert validate.range_rating(nulls).first()["valid"] is False
    assert tuple(validate.range_votes(nulls).first()) == (0, False)
    assert tuple(validate.range_votes(nulls.limit(0)).first()) == (0, True)


def test_missing_percentage_is_half_even(spark):
    df = spark.range(800).selectExpr("CASE WHEN id > 0 THEN id END AS rating", "id AS other")
    rows = {r["column"]: tuple(r)[1:] for r in validate.missing_report(df).collect()}
    assert rows == {"rating": (1, 0.12, True), "other": (0, 0.0, False)}


def test_verdict(spark):
    schema = "review_id string, text string, rating long"
    good = spark.createDataFrame([("R1", "a", 9), ("R2", "a", 5)], schema)
    assert tuple(validate.validation_verdict(good).first()) == (True, [])
    bad = spark.createDataFrame([("R1", None, 9), ("R1", "a", None)], schema)
    assert validate.validation_verdict(bad).first()["issues"] == [
        "Duplicate review IDs found",
        "Critical column 'text' has missing values",
        "Critical column 'rating' has missing values",
    ]


def test_report_and_its_flat_form(spark):
    df = spark.createDataFrame(
        [("R1", "a", 5), ("R1", "a", 5), ("R2", "b", None)],
        "review_id string, text string, rating long",
    )
    report = validate.validation_report(df, "somewhere")
    row = report.first()
    assert row["total_records"] == 3 and row["validation_passed"] is False
    assert row["duplicates"].asDict() == {
        "duplicate_review_ids": 2, "duplicate_texts": 2, "exact_duplicates": 2,
    }
    flat = {r["path"]: r["number"] if r["label"] is None else r["label"]
            for r in facts(report).collect()}
    assert flat["data_ranges.rating.max"] == 5.0
    assert flat["data_types.rating.actual"] == "float64"
    assert flat["missing_values.rating.missing_percentage"] == 33.33
    assert flat["file_path"] == "somewhere"
