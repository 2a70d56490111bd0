from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from revaudit.operators import clean
from revaudit.settings import Settings


def test_missing_values(spark):
    df = spark.createDataFrame(
        [("R1", "Good", 5.0, 1.0), (None, None, None, None), ("R3", "Bad", 1.0, 0.0)],
        "review_id string, text string, rating double, useful_votes double",
    )
    out = clean.handle_missing_values(df)
    assert out.count() == 2
    assert out.filter("text IS NULL OR rating IS NULL OR useful_votes IS NULL").count() == 0


def test_median_sees_rows_that_are_dropped_later(spark):
    df = spark.createDataFrame(
        [("R1", 1), ("R2", None), (None, 4), (None, 5), ("R3", 2)], "review_id string, rating int"
    )
    ratings = {r["review_id"]: r["rating"] for r in clean.handle_missing_values(df).collect()}
    assert ratings == {"R1": 1.0, "R2": 3.0, "R3": 2.0}  # median of 1, 2, 4, 5


def test_all_ratings_null_stay_null(spark):
    df = spark.createDataFrame([("R1", None)], "review_id string, rating int")
    assert clean.impute_rating(df).first()["rating"] is None


def test_absent_optional_columns_are_skipped(spark):
    df = spark.createDataFrame([(1,), (None,)], "other int")
    assert clean.handle_missing_values(df).collect() == df.collect()


def test_normalized_votes(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "useful_votes long")
    scores = [r[1] for r in clean.normalize_votes(df).orderBy("useful_votes").collect()]
    assert scores == [-1.0, 0.0, 1.0]
    for votes in ([(5,), (5,)], [(5,)]):
        same = spark.createDataFrame(votes, "useful_votes long")
        assert {r[1] for r in clean.normalize_votes(same).collect()} == {None}


def test_one_row_per_id_with_the_lowest_text(spark):
    df = spark.createDataFrame(
        [("b", "R1", 1), ("a", "R1", 2), ("a", "R1", 1), ("z", "R2", 3)],
        "text string, review_id string, n int",
    )
    out = clean.drop_duplicate_ids(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [("a", "R1", 1), ("z", "R2", 3)]


def test_stage_drops_empty_texts_and_counts(spark):
    df = spark.createDataFrame(
        [("R1", "Nice <b>food</b>!", 4, 1), ("R2", "@#$", 3, 2), ("R3", None, 2, None)],
        "review_id string, text string, rating long, useful_votes long",
    )
    (row,) = clean.preprocess(df).collect()
    assert (row["cleaned_text"], row["text_length"], row["word_count"]) == ("nice bfoodb!", 12, 2)
    rich = clean.preprocess(df, Settings(strip_tags=True, rich_columns=True)).first()
    assert (rich["cleaned_text"], rich["avg_word_length"]) == ("nice food!", 4.5)
    assert rich["useful_votes_normalized"] is None


def test_optional_steps(spark):
    df = spark.createDataFrame(
        [("R1", "short", 4), ("R2", "a text long enough", 4), ("R2", "an other text", 4)],
        "review_id string, text string, rating long",
    )
    out = clean.preprocess(df, Settings(filter_length=True, drop_duplicate_ids=True))
    assert [r["cleaned_text"] for r in out.collect()] == ["a text long enough"]


def test_text_called_null_stays_a_text(spark):
    df = spark.createDataFrame([("R1", "null"), ("R2", "nan")], "review_id string, text string")
    assert clean.preprocess(df).count() == 2


@pytest.mark.parametrize("rows", [[], [("R1", "ok then", 3, datetime.date(2024, 1, 6))]])
def test_tiny_tables(spark, rows):
    df = spark.createDataFrame(rows, "review_id string, text string, rating long, date date")
    assert clean.preprocess(df).count() == len(rows)
    assert clean.preprocess(df, Settings(rich_columns=True)).filter(F.lit(True)).count() == len(rows)


@pytest.mark.parametrize("limit", [0, 100])
def test_duplicate_ids_with_a_hot_id(spark, limit):
    """Broadcast or not, a third of all rows under one id leaves one of them."""
    rows = spark.range(900).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('R', id) END AS review_id",
        "concat('t', 1000 - id) AS text", "id AS votes",
    )
    kept = clean.drop_duplicate_ids(rows.unionByName(rows), limit).collect()
    expected = {r["review_id"] for r in rows.collect()}
    assert len(kept) == len(expected) and {r["review_id"] for r in kept} == expected
    texts = [r["text"] for r in rows.collect() if r["review_id"] == "hot"]
    assert [r["text"] for r in kept if r["review_id"] == "hot"] == [min(texts)]
