from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from revaudit.operators import duplicates


def test_null_equals_null(spark):
    df = spark.createDataFrame(
        [(None, "a"), (None, None), ("x", None)], "review_id string, text string"
    )
    assert tuple(duplicates.duplicate_counts(df).first()) == (2, 2, 0)


def test_borders_between_columns_count(spark):
    df = spark.createDataFrame(
        [("R1", "t", "a", "bc"), ("R1", "t", "ab", "c"), ("R1", "t", "a", None)],
        "review_id string, text string, one string, two string",
    )
    assert duplicates.duplicate_counts(df).first()["exact_duplicates"] == 0


def test_negative_zero_equals_zero(spark):
    df = spark.createDataFrame(
        [("R1", "t", 0.0), ("R1", "t", -0.0)], "review_id string, text string, v double"
    )
    assert duplicates.duplicate_counts(df).first()["exact_duplicates"] == 2


def crowded(spark, n=6000):
    """A third of all rows share a text, another sixth is copied whole."""
    text = F.when(F.col("id") % 3 == 0, "same").otherwise(
        F.concat(F.lit("text "), (F.col("id") % 4001).cast("string"))
    )
    rows = spark.range(n).select(
        F.when(F.col("id") % 50 > 0, F.format_string("R%05d", F.col("id") % 5500)).alias(
            "review_id"
        ),
        F.format_string("B%d", F.col("id") % 5).alias("business_id"),
        F.when(F.col("id") % 90 > 0, text).alias("text"),
    )
    return rows.unionByName(rows.filter("substr(review_id, 5) IN ('07', '7', '70', '77')"))


def test_counts_rows_and_groups_against_pandas(spark):
    df = crowded(spark)
    pdf = df.toPandas()
    pdf = pdf.astype(object).where(pdf.notna(), None)
    keys = {"review_id": ["review_id"], "text": ["text"], "all_columns": list(pdf.columns)}
    members = {name: pdf[pdf.duplicated(subset=by, keep=False)] for name, by in keys.items()}
    assert tuple(duplicates.duplicate_counts(df).first()) == tuple(map(len, members.values()))

    first = duplicates.duplicate_rows(df).toPandas()
    for name, rows in members.items():
        expected = rows["review_id"].sort_values(na_position="last").head(10).tolist()
        found = first[first["duplicate_set"] == name].sort_values("position")
        assert found["review_id"].tolist() == expected
        assert found["position"].tolist() == list(range(1, len(expected) + 1))

    sizes = pdf.groupby(["business_id", "text"]).size()
    assert duplicates.repeated_reviews(df).first()[0] == int((sizes > 1).sum())


def test_no_duplicates(spark):
    df = spark.createDataFrame([("R1", "a"), ("R2", "b")], "review_id string, text string")
    assert tuple(duplicates.duplicate_counts(df).first()) == (0, 0, 0)
    assert duplicates.duplicate_rows(df).count() == 0


def test_first_rows_put_null_ids_last(spark):
    pdf = pd.DataFrame({"review_id": ["R9", None, None, "R1"], "text": ["t", "t", "u", "u"]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None),
                               "review_id string, text string")
    rows = duplicates.duplicate_rows(df, first=3).filter("duplicate_set = 'text'")
    assert [r["review_id"] for r in rows.orderBy("position").collect()] == ["R1", "R9", None]
