"""State by parts against the same reports over everything at once."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from revaudit.catalog.tables import reviews
from revaudit.operators import bias, features, parts, partsketches, validate


@pytest.fixture(scope="module")
def whole(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("whole")) + "/reviews"
    reviews(spark, sf_dir).write.parquet(path)
    return spark.read.parquet(path)


def thirds(df):
    part = F.pmod(F.hash("user_id"), F.lit(3))
    return [df.filter(part == i) for i in range(3)]


@pytest.fixture(scope="module")
def state(spark, whole, tmp_path_factory):
    """Three batches arrive on a stream, then the second is replayed."""
    base = str(tmp_path_factory.mktemp("live"))
    batches = thirds(whole)
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(f"{base}/in")
        live = spark.readStream.schema(whole.schema).parquet(f"{base}/in")
        parts.report_stream(live, f"{base}/state").awaitTermination()
    before = parts.stored_states(spark, f"{base}/state")
    assert before.select("part").distinct().count() == 3
    parts.add_part(batches[1], f"{base}/state", "b000000000001")
    return parts.merged(parts.stored_states(spark, f"{base}/state"))


def same(found, expected):
    key = lambda row: tuple(str(cell) for cell in row[:2])
    found, expected = (sorted(map(tuple, df.collect()), key=key) for df in (found, expected))
    assert len(found) == len(expected) > 0
    for one, other in zip(found, expected, strict=True):
        for cell, wanted in zip(one, other, strict=True):
            exact = not isinstance(wanted, float)
            assert cell == (wanted if exact else pytest.approx(wanted, rel=1e-9, abs=1e-9)), (one, other)


def test_validation(state, whole):
    checks = parts.column_checks(state)
    nulls = ["column", "missing_count", "missing_percentage", "is_critical"]
    same(checks.select(*nulls), validate.missing_report(whole).select(*nulls))
    found = {r["column"]: r for r in checks.collect()}
    rating, length, votes = (
        check(whole).first()
        for check in (validate.range_rating, validate.range_text_length, validate.range_votes)
    )
    assert (found["rating"]["min"], found["rating"]["max"]) == (rating["min"], rating["max"])
    assert found["rating"]["broken_count"] == rating["out_of_range_count"]
    assert found["text_length"]["mean"] == pytest.approx(length["mean"])
    assert found["text_length"]["broken_count"] == length["empty_count"]
    assert found["useful_votes"]["broken_count"] == votes["negative_count"]


def test_bias(state, whole):
    same(parts.rating_shares(state), bias.rating_distribution(whole))
    found = parts.rating_moments(state)
    same(found, bias.rating_summary(whole).select(*found.columns))
    for category in ("business_category", "platform"):
        found = parts.category_moments(state, category)
        same(found, bias.category_bias(whole, category).select(*found.columns))
    found = parts.month_moments(state)
    same(found, bias.monthly_trend(whole).select(*found.columns))
    found = parts.business_moments(state).select("business_id", "business_avg_rating", "business_rating_std")
    stats = features.business_stats(whole).filter("business_id IS NOT NULL")
    same(found, stats.select(*found.columns))


def test_a_part_reads_only_itself(spark, whole, tmp_path):
    path = str(tmp_path / "state")
    parts.add_part(whole.limit(50), path, "one")
    plan = parts.part_state(whole)._jdf.queryExecution().executedPlan().toString()
    assert path not in plan and plan.count("FileScan") == 1


def test_far_apart_means_keep_their_moments(spark, tmp_path):
    rng = np.random.default_rng(3)
    values = np.concatenate([1e6 + rng.normal(size=500), rng.normal(size=700) ** 3, [5.0]])
    df = spark.createDataFrame(pd.DataFrame({"rating": values, "at": np.repeat([0, 1, 2], [500, 700, 1])}))
    for i in range(3):
        parts.add_part(df.filter(F.col("at") == i).drop("at"), str(tmp_path), f"p{i}")
    row = parts.rating_moments(parts.merged(parts.stored_states(spark, str(tmp_path)))).first()
    series = pd.Series(values)
    assert row["mean_rating"] == pytest.approx(series.mean(), rel=1e-9)
    assert row["std_rating"] == pytest.approx(series.std(), rel=1e-9)
    assert row["skewness"] == pytest.approx(series.skew(), rel=1e-6)
    assert row["median_rating"] == pytest.approx(series.median())


def test_nothing_yet_and_null_columns(spark, tmp_path):
    none = parts.stored_states(spark, str(tmp_path / "none"))
    assert parts.column_checks(parts.merged(none)).count() == 0
    empty = spark.createDataFrame([], "rating double, text string, platform string")
    nulls = spark.createDataFrame([(None, None, None)] * 2, empty.schema)
    for name, df in (("a", empty), ("b", nulls), ("c", empty)):
        parts.add_part(df, str(tmp_path / "some"), name)
    state = parts.merged(parts.stored_states(spark, str(tmp_path / "some")))
    found = {r["column"]: r for r in parts.column_checks(state).collect()}
    assert found["rating"]["missing_count"] == 2 and found["rating"]["mean"] is None
    assert parts.rating_shares(state).count() == 0
    assert parts.rating_moments(state).first()["median_rating"] is None


@pytest.mark.parametrize("shape", ["normal", "heavy tail", "third in one value"])
def test_sketched_quantiles_stay_within_their_bound(spark, shape):
    rng = np.random.default_rng(11)
    values = rng.normal(size=60_000)
    if shape == "heavy tail":
        values = np.exp(8 * values)
    elif shape == "third in one value":
        values = np.where(rng.random(60_000) < 0.34, 0.25, values)
    frame = pd.DataFrame({"v": values, "month": np.arange(60_000) % 12})
    stored = partsketches.sketch_parts(spark.createDataFrame(frame), ["month"], ["v"])
    row = partsketches.united(stored).select(
        *[partsketches.quantile("v", p).alias(str(i)) for i, p in enumerate((0.05, 0.25, 0.5, 0.95))]
    ).first()
    for value, p in zip(row, (0.05, 0.25, 0.5, 0.95), strict=True):
        below, upto = (values < value).mean(), (values <= value).mean()
        assert below - partsketches.RANK_ERROR <= p <= upto + partsketches.RANK_ERROR


def test_sketched_distinct_counts(spark):
    df = spark.range(90_000).selectExpr("id % 30000 AS user_id", "id % 12 AS month")
    stored = partsketches.sketch_parts(df, ["month"], counted=["user_id"])
    joined = partsketches.united(stored).select(partsketches.distinct("user_id")).first()[0]
    at_once = partsketches.sketch_parts(df, [], counted=["user_id"]).select(partsketches.distinct("user_id"))
    assert joined == pytest.approx(30_000, rel=4 * partsketches.DISTINCT_ERROR)
    assert joined == pytest.approx(at_once.first()[0], rel=2 * partsketches.DISTINCT_ERROR)


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([(1, None, None)], "month int, v double, u string")
    row = partsketches.united(partsketches.sketch_parts(df, ["month"], ["v"], ["u"])).select(
        partsketches.quantile("v", 0.5).alias("median"), partsketches.distinct("u").alias("users")
    )
    assert tuple(row.first()) == (None, 0)
