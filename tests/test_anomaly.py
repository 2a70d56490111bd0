from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from revaudit.operators import anomaly


def test_iqr(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 2, 3, 10, 50, 7)], "v long")
    out = anomaly.outliers_iqr(df, "v")
    assert out.columns == ["v"] and [r["v"] for r in out.collect()] == [50]
    assert anomaly.outliers_iqr(df, "absent").count() == 0
    assert anomaly.outliers_zscore(df, "absent").count() == 0


def test_zscore_names_the_right_rows_despite_nulls(spark):
    df = spark.createDataFrame([(None,)] * 3 + [(1.0,)] * 30 + [(100.0,)], "v double")
    assert [r["v"] for r in anomaly.outliers_zscore(df, "v").collect()] == [100.0]


@pytest.mark.parametrize("rows", [[(5.0,)] * 4, [(5.0,)], [(None,)], []])
def test_constant_or_tiny_columns_have_no_outliers(spark, rows):
    df = spark.createDataFrame(rows, "useful_votes double")
    assert anomaly.outliers_iqr(df, "useful_votes").count() == 0
    assert anomaly.outliers_zscore(df, "useful_votes").count() == 0
    assert {r["outliers"] for r in anomaly.outlier_counts(df).collect()} == {0}


def reviews(spark):
    return spark.range(200).select(
        F.format_string("R%03d", "id").alias("review_id"),
        F.lit("B1").alias("business_id"),
        F.when(F.col("id") < 150, F.concat(F.lit("t"), F.col("id").cast("string")))
        .otherwise("same")
        .alias("text"),
        F.when(F.col("id") == 3, 1).otherwise(5).cast("bigint").alias("rating"),
        F.when(F.col("id") == 3, 900).otherwise(F.col("id") % 3).alias("useful_votes"),
        F.when(F.col("id") < 2, 4).when(F.col("id") > 2, 40).cast("bigint").alias("text_length"),
    )


def test_patterns(spark):
    df = reviews(spark)
    assert [tuple(r) for r in anomaly.suspicious_short(df).collect()] == [(2, "R000"), (2, "R001")]
    assert [tuple(r) for r in anomaly.suspicious_votes(df).collect()] == [(1, "R003")]
    found = {r["type"]: r["count"] for r in anomaly.suspicious_summary(df).collect()}
    assert found == {
        "very_short_reviews": 2, "suspicious_vote_pattern": 1, "repeated_reviews_per_business": 1,
    }


def test_only_patterns_that_occur(spark):
    df = reviews(spark).filter("text_length = 40 AND rating = 5 AND text != 'same'")
    assert anomaly.suspicious_summary(df).count() == 0
    assert anomaly.suspicious_short(df).count() == 0


def test_missing_patterns(spark):
    df = reviews(spark).withColumn("note", F.lit(None).cast("string"))
    rows = anomaly.missing_patterns(df).orderBy("column", "position").collect()
    notes = [r for r in rows if r["column"] == "note"]
    assert [r["review_id"] for r in notes] == [f"R{i:03d}" for i in range(10)]
    assert {(r["missing_count"], r["missing_percentage"]) for r in notes} == {(200, 100.0)}
    lengths = [r for r in rows if r["column"] == "text_length"]
    assert [(r["missing_count"], r["missing_percentage"], r["review_id"]) for r in lengths] == [
        (1, 0.5, "R002")
    ]
    assert {r["column"] for r in rows} == {"note", "text_length"}


def test_alerts(spark):
    row = anomaly.anomaly_alert(reviews(spark)).first()
    assert row["exact_duplicates"] == 0 and row["pattern_types"] == 3
    lines = row["alert"].split("\n")
    assert lines == [
        f"⚠️ ALERT: {row['total_outliers']} outliers detected",
        "⚠️ ALERT: 3 suspicious patterns detected",
    ]
    counts = anomaly.outlier_counts(reviews(spark)).agg(F.sum("outliers")).first()[0]
    assert row["total_outliers"] == counts > 0
    quiet = spark.createDataFrame([("R1", "some text")], "review_id string, text string")
    assert anomaly.anomaly_alert(quiet).first()["alert"] == "✓ No critical anomalies detected"


def ids(sample):
    return list(sample)


def test_report_names_the_rows(spark):
    df = reviews(spark).withColumn("note", F.lit(None).cast("string"))
    row = anomaly.anomaly_report(df).first()
    found = {p["type"]: p for p in row["suspicious_patterns"]}
    assert ids(found["very_short_reviews"]["sample"]) == ["R000", "R001"]
    assert found["very_short_reviews"]["description"] == "Reviews with less than 10 characters"
    assert ids(found["suspicious_vote_pattern"]["sample"]) == ["R003"]
    assert ids(found["repeated_reviews_per_business"]["sample"]) == []
    assert {m["column"]: m["missing_count"] for m in row["missing_patterns"]} == {"note": 200, "text_length": 1}
    assert row["missing_patterns"][0]["sample"] == [f"R{i:03d}" for i in range(10)]
    assert ids(row["duplicates"]["text_sample"]) == [f"R{i}" for i in range(150, 160)]
    assert ids(row["duplicates"]["exact_sample"]) == []
    quiet = anomaly.anomaly_report(df.filter("text_length = 40 AND rating = 5 AND text != 'same'").drop("note"))
    assert quiet.first()["suspicious_patterns"] == [] == quiet.first()["missing_patterns"]


def test_outlier_rows_are_named(spark):
    rows = anomaly.outlier_rows(reviews(spark)).collect()
    votes = [r for r in rows if "useful_votes.iqr" in r["found_by"]]
    assert [r["review_id"] for r in votes] == ["R003"]
    assert "useful_votes.zscore" in votes[0]["found_by"]
    counts = anomaly.outlier_counts(reviews(spark)).agg(F.sum("outliers")).first()[0]
    assert sum(len(r["found_by"]) for r in rows) == counts


@pytest.mark.parametrize("absent", ["useful_votes", "text_length", "business_id", "rating", "text"])
def test_patterns_without_a_column(spark, absent):
    df = reviews(spark).drop(absent)
    left = {r["type"] for r in anomaly.suspicious_summary(df).collect()}
    gone = {
        "useful_votes": "suspicious_vote_pattern", "rating": "suspicious_vote_pattern",
        "text_length": "very_short_reviews", "business_id": "repeated_reviews_per_business",
        "text": "repeated_reviews_per_business",
    }
    assert left == set(gone.values()) - {gone[absent]}
    assert anomaly.suspicious_short(df).count() == (0 if absent == "text_length" else 2)
    assert anomaly.suspicious_votes(df).count() == (0 if absent in ("useful_votes", "rating") else 1)


def test_nothing_to_look_at(spark):
    df = spark.createDataFrame([("R1",)], "review_id string")
    assert anomaly.suspicious_summary(df).count() == 0
    assert anomaly.outlier_counts(df).count() == 0
    assert anomaly.outlier_rows(df).count() == 0


def test_first_ids_over_many_partitions(spark):
    df = spark.range(1000).selectExpr("lpad(id, 4, '0') AS review_id", "id AS text_length").repartition(16)
    rows = anomaly.suspicious_short(df).collect()
    assert [(r["matches"], r["review_id"]) for r in rows] == [(10, f"{i:04d}") for i in range(10)]
