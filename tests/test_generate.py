from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from revaudit.functions.draws import poisson_cdf
from revaudit.operators import generate
from revaudit.schema import RAW_REVIEW, RAW_REVIEW_EXTENDED

N = 20_000


@pytest.fixture(scope="module")
def basic(spark):
    return generate.generate_reviews(spark, N).cache()


@pytest.fixture(scope="module")
def extended(spark):
    return generate.generate_reviews(spark, N, "extended").cache()


def kinds(schema):
    return [(f.name, f.dataType) for f in schema]


def test_schemas(basic, extended):
    assert kinds(basic.schema) == kinds(RAW_REVIEW)
    assert kinds(extended.schema) == kinds(RAW_REVIEW_EXTENDED)


@pytest.mark.parametrize("n", [0, 1, 99, 100, 4999, 5000])
def test_exact_number_of_null_texts(spark, n):
    df = generate.generate_reviews(spark, n)
    assert df.count() == n
    assert df.filter("text IS NULL").count() == int(0.01 * n)
    assert df.filter("text_length IS NULL").count() == 0


def test_ids_are_unique_past_six_digits(spark):
    ids = spark.range(999_990, 1_000_010)
    found = generate.synthetic_reviews(ids).select("review_id").distinct().collect()
    assert len(found) == 20 and {"R999999", "R1000000"} <= {r[0] for r in found}


def test_rating_shares(basic):
    shares = {r["rating"]: r["count"] / N for r in basic.groupBy("rating").count().collect()}
    for rating, slots in zip(range(1, 6), (2, 2, 3, 4, 5)):
        assert shares[rating] == pytest.approx(slots / 16, abs=0.012)


def test_vote_moments(basic):
    for name, rate in generate.VOTE_RATES.items():
        mean, variance = basic.agg(F.avg(name), F.var_pop(name)).first()
        assert mean == pytest.approx(rate, abs=0.05)
        assert variance == pytest.approx(rate, rel=0.06)


def test_poisson_steps():
    steps = poisson_cdf(2.0)
    assert steps[:3] == pytest.approx([math.exp(-2) * x for x in (1, 3, 5)])
    assert steps == sorted(steps) and steps[-1] == pytest.approx(1)


def test_outliers_have_one_value(extended):
    high = extended.filter("useful_votes >= 100").groupBy("useful_votes").count().collect()
    assert len(high) == 1
    assert 100 <= high[0]["useful_votes"] <= 500 and high[0]["count"] == int(0.02 * N)


def test_extended_values(extended):
    row = extended.agg(
        F.min("response_time_hours"), F.max("response_time_hours"),
        F.count("response_time_hours") / N, F.avg(F.col("verified_purchase").cast("int")),
        F.count_distinct("platform"), F.count_if(F.contains("text", F.lit("{"))),
        F.count_distinct("time"), F.min("language"),
    ).first()
    assert row[:2] == (1.0, 168.0)
    assert row[2] == pytest.approx(0.3, abs=0.02) and row[3] == pytest.approx(0.8, abs=0.02)
    assert row[4:] == (4, 0, 1, "en")


def test_same_rows_however_partitioned(spark):
    one = generate.synthetic_reviews(spark.range(0, 2000, 1, 1))
    many = generate.synthetic_reviews(spark.range(0, 2000, 1, 7).orderBy(F.desc("id")))
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_seeds_differ(spark):
    one, two = (generate.generate_reviews(spark, 500, seed=s) for s in (1, 2))
    assert one.exceptAll(two).count() > 400


def test_lowest_draws_against_a_full_sort(spark):
    from revaudit.functions.draws import uniform

    ids = spark.range(0, 30_000, 3)
    hit = ids.filter(generate.lowest_draws(ids, 0.07, 5, "x"))
    full = ids.orderBy(uniform(5, F.col("id"), "x"), "id").limit(int(0.07 * 10_000))
    assert sorted(r[0] for r in hit.collect()) == sorted(r[0] for r in full.collect())


def test_sample_head(basic):
    ids = [r["review_id"] for r in generate.sample_head(basic).collect()]
    assert ids == [f"R{i:06d}" for i in range(100)]
