from __future__ import annotations

from revaudit.operators.scratch import settle


def test_settled_table_is_read_back_without_a_job(spark):
    """Each job stays on the driver for a while; one only to read a known schema is one too many."""
    context = spark.sparkContext
    context.setJobGroup("settle", "settle")
    out = settle(spark.range(20, numPartitions=2).selectExpr("id", "array(struct(id as a)) as b", "string(null) as c"), "settle")
    jobs = context.statusTracker().getJobIdsForGroup("settle")
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1
    assert sorted(r["b"][0]["a"] for r in out.collect()) == list(range(20)) and out.where("c is null").count() == 20
