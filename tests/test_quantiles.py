"""The spread-out quantiles against numpy's linear ones."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from revaudit.operators import quantiles as module
from revaudit.operators.anomaly import anomaly_report
from revaudit.operators.quantiles import quantiles

PROBS = [0.0, 0.25, 0.5, 0.75, 0.95, 1.0]


def shapes():
    rng = np.random.default_rng(7)
    yield "normal", rng.normal(size=20_011)
    yield "heavy tail", np.exp(rng.normal(scale=8, size=9_973))
    yield "few values", rng.integers(0, 4, size=5_000).astype(float)
    yield "third in one value", np.where(rng.random(9_001) < 0.34, 3.0, rng.normal(size=9_001))
    yield "negative and positive", np.array([-1e20, -1.0, 0.0, 1e-20, 5.0, 1e20])
    yield "one", np.array([4.5])
    yield "two", np.array([3.0, 4.0])
    yield "integers", rng.permutation(7_000).astype(float)


@pytest.mark.parametrize("name, values", list(shapes()), ids=lambda x: x if isinstance(x, str) else "")
def test_against_numpy(spark, name, values):
    df = spark.createDataFrame(pd.DataFrame({"v": values})).repartition(5)
    found = quantiles(df, {"v": PROBS})["v"]
    assert found == pytest.approx(list(np.quantile(values, PROBS)), rel=1e-12)


def test_several_columns_nulls_and_nan(spark):
    df = spark.createDataFrame(
        [(1, 2.0, None), (2, None, None), (3, float("nan"), None), (None, 4.0, None)],
        "a long, b double, c double",
    )
    row = quantiles(df, {"a": [0.5], "b": [0.25, 0.75], "c": [0.5]})
    assert row == {"a": [2.0], "b": [2.5, 3.5], "c": [None]}


def test_small_published_case(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 2, 3, 10, 50, 7)], "v long")
    assert quantiles(df, {"v": [0.25, 0.75]})["v"] == [1.5, 8.5]


def test_infinite_values_and_odd_names(spark):
    df = spark.createDataFrame([(float("-inf"),), (1.0,), (float("inf"),)], "`it's a \\ name` double")
    (found,) = quantiles(df, {df.columns[0]: [0.0, 0.5, 1.0]}).values()
    assert found == [float("-inf"), 1.0, float("inf")]
    assert quantiles(df, {}) == {}


def test_many_distinct_values_take_few_rounds(spark, monkeypatch):
    """Of 200,000 distinct values the driver sees at most the buckets of each round, and few rounds run."""
    sizes = []
    cut = module._buckets

    def seen(tagged, marks):
        out = cut(tagged, marks)
        sizes.append(max(len(rows) for rows in out.values()))
        return out

    monkeypatch.setattr(module, "_buckets", seen)
    df = spark.range(200_000).selectExpr("CAST(id AS DOUBLE) * 1.5 AS v").repartition(8)
    assert quantiles(df, {"v": [0.5]})["v"] == [149_999.25]
    assert len(sizes) <= 3 and max(sizes) <= module._BUCKETS


def test_one_pass_for_a_report(spark, monkeypatch):
    """A report counts the values of all its columns in one pass."""
    calls = []
    counted = module.value_counts
    monkeypatch.setattr(module, "value_counts", lambda df, names: calls.append(names) or counted(df, names))
    df = spark.range(50).selectExpr(
        "CAST(id AS STRING) AS review_id", "'t' AS text", "id AS useful_votes", "id % 5 + 1 AS rating",
        "id AS text_length",
    )
    anomaly_report(df).collect()
    assert calls == [["useful_votes", "text_length"]]
