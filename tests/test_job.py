from __future__ import annotations

import json

import pytest

from revaudit.operators.generate import generate_reviews
from revaudit.plans import review_job
from revaudit.plans.review_job import process, run
from revaudit.settings import Settings


def only_part(folder):
    (part,) = folder.glob("part-*")
    return part.read_text()


def test_full_job_on_synthetic_reviews(spark, tmp_path):
    summary = run(spark, str(tmp_path), "synthetic", n=5000).first()
    assert summary["clean_reviews"] == 4950
    assert summary["validation_passed"] is True and summary["issues"] == ""
    assert summary["feature_columns"] == 32
    assert summary["bias_detected"] == "No significant bias detected"

    clean = spark.read.parquet(str(tmp_path / "clean_reviews"))
    assert len(clean.columns) == 16 and clean.count() == 4950
    features = spark.read.parquet(str(tmp_path / "features"))
    assert len(features.columns) == 32 and features.count() == 4950

    validation = json.loads(only_part(tmp_path / "validation_results"))
    assert validation["total_records"] == 4950 and validation["total_columns"] == 16
    # Few templates and words: every text occurs more than once.
    assert validation["duplicates"]["duplicate_texts"] == 4950
    assert validation["data_ranges"]["text_length"]["min"] == len("it was fine.")
    assert "validation_timestamp" in validation
    anomalies = json.loads(only_part(tmp_path / "anomalies"))
    assert anomalies["total_outliers"] == summary["total_outliers"]
    assert only_part(tmp_path / "bias_report").startswith("# Bias Detection Report")
    assert spark.read.parquet(str(tmp_path / "bias_analysis")).count() > 50


def test_short_job_and_unknown_stage(spark, tmp_path):
    raw = generate_reviews(spark, 300)
    summary = process(raw, str(tmp_path / "short"), stages=("validation", "anomalies"))
    assert "feature_columns" not in summary.columns
    assert not (tmp_path / "short" / "features").exists()
    assert process(raw, str(tmp_path / "none"), stages=()).first()["clean_reviews"] == 297
    with pytest.raises(ValueError, match="publish"):
        process(raw, str(tmp_path / "bad"), stages=("publish",))


def test_failures_propagate(spark, tmp_path):
    raw = generate_reviews(spark, 100).withColumnRenamed("rating", "stars")
    with pytest.raises(Exception, match="rating"):
        process(raw, str(tmp_path), stages=("bias",))


def test_job_goes_on_where_it_was_ended(spark, tmp_path, monkeypatch):
    raw, out, ran = generate_reviews(spark, 300), str(tmp_path / "job"), []
    stages = ("features", "validation", "bias")
    broken = {"validation": True}

    def watched(name, stage):
        def work(job):
            ran.append(name)
            if broken.get(name):
                raise RuntimeError("ended")
            return stage(job)

        return work

    for name, stage in list(review_job.STAGES.items()):
        monkeypatch.setitem(review_job.STAGES, name, watched(name, stage))
    real = review_job.preprocess
    monkeypatch.setattr(review_job, "preprocess", lambda *a: ran.append("clean") or real(*a))

    def job(rows=raw, settings=Settings()):
        ran.clear()
        return process(rows, out, settings, stages, resume=True).first().asDict(), sorted(ran)

    with pytest.raises(RuntimeError, match="ended"):
        job()
    assert sorted(ran) == ["bias", "clean", "features", "validation"]
    broken.clear()
    first, done = job()
    assert done == ["validation"]
    whole = process(raw, str(tmp_path / "whole"), stages=stages).first().asDict()
    assert first == whole and list(first) == list(whole)
    assert job(raw.repartition(3)) == (first, [])
    # another setting, the old one again after it, and other rows: all runs again
    everything = ["bias", "clean", "features", "validation"]
    assert job(settings=Settings(rating_high=4))[1] == everything
    assert job() == (first, everything)
    assert job(raw.limit(299))[1] == everything
