from __future__ import annotations

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from revaudit.operators import duplicates, history
from revaudit.operators.generate import generate_reviews


def plan_of(df):
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        df.explain()
    return shown.getvalue()


@pytest.fixture(scope="module")
def reviews(spark):
    first = generate_reviews(spark, 300).select("review_id", "business_id", "text", F.col("rating").cast("double"))
    odd = spark.createDataFrame(
        [(None, None, None, None), (None, "B", "", 1.0), (None, None, None, None)],
        "review_id string, business_id string, text string, rating double",
    )
    return first.unionByName(first.filter(F.crc32("review_id") % 7 == 0)).unionByName(odd)


@pytest.fixture(scope="module")
def dealt(reviews):
    return [reviews.filter(F.pmod(F.xxhash64("review_id", "text"), F.lit(3)) == i) for i in range(3)]


def test_index_equals_counts_of_the_union(spark, reviews, dealt, tmp_path):
    index = history.open_index(spark, "digests_a", str(tmp_path / "index"), 8)
    empty = history.duplicate_counts(index).first()
    assert list(empty) == [0, 0, 0]
    for i in (0, 1, 1, 2, 0):  # two parts are added twice
        history.add_part(dealt[i], index, f"p{i}")
    assert history.duplicate_counts(index).first() == duplicates.duplicate_counts(reviews).first()
    plan = plan_of(history.duplicate_counts(index))
    assert plan.count("Exchange") == 1  # of the one row
    # another session's catalog finds the same table by its path
    spark.sql("DROP TABLE digests_a")
    again = history.open_index(spark, "digests_b", str(tmp_path / "index"), 8)
    assert history.duplicate_counts(again).first() == duplicates.duplicate_counts(reviews).first()


def test_repeats_of_a_new_part(spark, reviews, dealt, tmp_path):
    index = history.open_index(spark, "digests_c", str(tmp_path / "index"), 8)
    for i in (0, 1):
        history.add_part(dealt[i], index, f"p{i}")
    found = history.repeats(dealt[2], index, "p2")
    sizes = duplicates.duplicate_groups(reviews).withColumnRenamed("rows", "n")
    want = (
        duplicates.keyed_reviews(dealt[2])
        .alias("a")
        .join(sizes.alias("b"), F.expr("a.duplicate_set = b.duplicate_set AND a.key <=> b.key"))
        .select("a.duplicate_set", "a.review_id", "b.n")
    )
    listed = [(r[0], r[1] or "", r[2]) for r in want.collect()]
    ours = found.select("duplicate_set", "review_id", (F.col("rows_here") + F.col("rows_before")).alias("n"))
    assert sorted((r[0], r[1] or "", r[2]) for r in ours.collect()) == sorted(listed) != []
    # the same after the part itself is in the index
    history.add_part(dealt[2], index, "p2")
    assert sorted(map(str, history.repeats(dealt[2], index, "p2").collect())) == sorted(map(str, found.collect()))


def test_old_rows_are_not_shuffled(spark, dealt, tmp_path):
    index = history.open_index(spark, "digests_d", str(tmp_path / "index"), 8)
    history.add_part(dealt[0], index, "p0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = plan_of(history.repeats(dealt[1], index, "p1"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.splitlines()
    (scan,) = [i for i, line in enumerate(lines) if "digests_d" in line]
    depth = len(lines[scan]) - len(lines[scan].lstrip(" :+-*()0123456789"))
    above = []
    for line in reversed(lines[:scan]):
        own = len(line) - len(line.lstrip(" :+-*()0123456789"))
        if own < depth:
            above.append(line)
            depth = own
    join = next(i for i, line in enumerate(above) if "Join" in line)
    assert not any("Exchange" in line for line in above[:join]), plan


def test_one_text_reads_one_bucket(spark, dealt, tmp_path):
    index = history.open_index(spark, "digests_e", str(tmp_path / "index"), 8)
    for i in (0, 1):
        history.add_part(dealt[i], index, f"p{i}")
    text = dealt[0].filter("text <> ''").first()["text"]
    asked = history.parts_with_text(index, text)
    # plans print the buckets only of scans by bucket, which a scan of one bucket need not be
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", False)
    try:
        assert "SelectedBucketsCount: 1 out of 8" in plan_of(history.parts_with_text(index, text))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    want = {(f"p{i}", dealt[i].filter(F.col("text") == text).count()) for i in (0, 1)}
    assert {tuple(r) for r in asked.collect()} == {w for w in want if w[1]}
    assert history.parts_with_text(index, "never written").count() == 0
