"""The whole job: load, clean, derive features, then validate and report on the clean table.

The clean table is written once as Parquet; every later stage reads only the columns it needs
from it, so no stage repeats the text cleaning and none depends on cached blocks. The later
stages do not depend on each other and are submitted together. A job may go on where one with the
same input and settings was ended.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revaudit.operators.anomaly import anomaly_report, outlier_rows, report_cuts, stored_keys
from revaudit.operators.bias import bias_facts, bias_summary, bias_tables
from revaudit.operators.clean import preprocess
from revaudit.operators.duplicates import duplicate_report
from revaudit.operators.features import create_features
from revaudit.operators.scratch import settle
from revaudit.operators.validate import validation_report
from revaudit.plans.manifest import Manifest, job_digest
from revaudit.plans.report import render
from revaudit.settings import Settings
from revaudit.sources.readers import load_reviews
from revaudit.sources.writers import write_json, write_parquet, write_text


@dataclass(frozen=True)
class Job:
    """What the stages share."""

    clean: DataFrame
    duplicates: DataFrame | None
    base: str
    settings: Settings
    now: str


def _features(job: Job) -> dict[str, Column]:
    features = create_features(job.clean, job.settings)
    write_parquet(features, f"{job.base}/features")
    return {"feature_columns": F.lit(len(features.columns)).cast("bigint")}


def _validation(job: Job) -> dict[str, Column]:
    report = validation_report(
        job.clean, f"{job.base}/clean_reviews", job.settings, job.duplicates
    )
    found = report.first()
    saved = job.clean.sparkSession.createDataFrame([found], report.schema)
    write_json(
        saved.withColumn("validation_timestamp", F.lit(job.now)), f"{job.base}/validation_results"
    )
    return {
        "validation_passed": F.lit(found["validation_passed"]),
        "issues": F.lit(", ".join(found["issues"])),
    }


def _anomalies(job: Job) -> dict[str, Column]:
    cuts = report_cuts(job.clean, job.settings)
    write_parquet(outlier_rows(job.clean, settings=job.settings, cuts=cuts), f"{job.base}/outliers")
    report = anomaly_report(job.clean, job.settings, job.duplicates, cuts)
    found = report.first()
    saved = job.clean.sparkSession.createDataFrame([found], report.schema)
    write_json(saved, f"{job.base}/anomalies")
    return {
        "total_outliers": F.lit(found["total_outliers"]).cast("bigint"),
        "pattern_types": F.lit(found["pattern_types"]).cast("bigint"),
        "alert": F.lit(found["alert"]),
    }


def _bias(job: Job) -> dict[str, Column]:
    ratings, categories, months = bias_tables(job.clean)
    ratings = settle(ratings, "ratings")
    categories = {name: settle(groups, "categories") for name, groups in categories.items()}
    months = None if months is None else settle(months, "months")
    summary = settle(bias_summary(job.clean, job.settings, categories), "bias-summary")
    write_parquet(bias_facts(summary, ratings, categories, months), f"{job.base}/bias_analysis")
    found = summary.first().asDict()
    listed = None if months is None else months.orderBy("month").collect()
    write_text(job.clean.sparkSession, render(found, listed, job.now), f"{job.base}/bias_report")
    return {"bias_detected": F.lit(found["rating_distribution"]["bias_detected"])}


Stage = Callable[[Job], dict[str, Column]]

STAGES: dict[str, Stage] = {
    "features": _features,
    "validation": _validation,
    "anomalies": _anomalies,
    "bias": _bias,
}


def process(
    raw: DataFrame,
    out_dir: str,
    settings: Settings = Settings(),
    stages: Sequence[str] = tuple(STAGES),
    resume: bool = False,
) -> DataFrame:
    """Run the job on loaded reviews and return its one-row summary. Any failure propagates.

    With ``resume``, stages that an earlier job with ``resume`` has finished in this folder are not run again
    if its input rows and settings were the same. That takes one more pass over the input.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise ValueError(f"Unknown stages: {sorted(unknown)}")
    spark = raw.sparkSession
    base = out_dir.rstrip("/")
    manifest = Manifest(spark, base, job_digest(raw, settings)) if resume else None
    if manifest is None or manifest.found("clean") is None:
        _noted(manifest, "clean", lambda: write_parquet(preprocess(raw, settings), f"{base}/clean_reviews") or {})
    clean = spark.read.parquet(f"{base}/clean_reviews")
    now = datetime.now().isoformat(sep=" ", timespec="seconds")

    summary = clean.agg(F.count(F.lit(1)).alias("clean_reviews"))
    finished = {name: found for name in stages if manifest and (found := manifest.found(name)) is not None}
    left = [name for name in stages if name not in finished]
    duplicates = None
    if {"validation", "anomalies"} & set(left):
        # One digest and one shuffle of each review serve both reports.
        keys = settle(stored_keys(clean), "duplicate-keys")
        duplicates = settle(duplicate_report(keys, settings.sample_rows), "duplicates")
    job = Job(clean, duplicates, base, settings, now)
    with ThreadPoolExecutor(max(len(left), 1)) as pool:
        target = inheritable_thread_target(spark)(_noted)
        started = {name: pool.submit(target, manifest, name, partial(STAGES[name], job)) for name in left}
    for name in stages:
        summary = summary.withColumns(finished[name] if name in finished else started[name].result())
    return summary


def _noted(manifest: Manifest | None, name: str, stage: Callable[[], dict[str, Column]]) -> dict[str, Column]:
    if manifest is not None:
        manifest.begin(name)
    added = stage()
    if manifest is not None:
        manifest.finish(name, added)
    return added


def run(
    spark: SparkSession,
    out_dir: str,
    source: str = "local",
    path: str | None = None,
    settings: Settings = Settings(),
    stages: Sequence[str] = tuple(STAGES),
    resume: bool = False,
    **options,
) -> DataFrame:
    """Load reviews from a source and process them. Leave a stage out for the short job."""
    return process(load_reviews(spark, source, path, **options), out_dir, settings, stages, resume)
