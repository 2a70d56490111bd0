"""One query per operator, over the whole test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revaudit.catalog.tables import order_reviews, reviews, reviews_dup, table
from revaudit.functions.text import sentiment_label
from revaudit.operators import (
    anomaly, bias, clean, duplicates, features, generate, heavy, history, parts, partsketches, validate,
)
from revaudit.operators.facts import facts
from revaudit.operators.scratch import new_path, settle
from revaudit.operators.subquery import with_scalar
from revaudit.plans.report import bias_report
from revaudit.plans.review_job import STAGES, process
from revaudit.settings import Settings
from revaudit.sources.readers import load_reviews, read_reviews_csv
from revaudit.sources.writers import write_csv, write_json
from revaudit.streaming.live import drop_repeated_ids

Query = Callable[[SparkSession, str], DataFrame]

SEED = 42
RICH = Settings(strip_tags=True, rich_columns=True)

_REGISTRY: dict[str, Query] = {}


def _rounded(df: DataFrame) -> DataFrame:
    """Six places on every double, and lists as text: comparable across engines."""
    shown = []
    for field in df.schema:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.round(column, 6)
        elif isinstance(field.dataType, T.ArrayType):
            column = F.concat_ws(", ", column)
        shown.append(column.alias(field.name))
    return df.select(*shown)


def _query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        _REGISTRY[name] = lambda spark, sf_dir: _rounded(build(spark, sf_dir))
        return build

    return register


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _on(name: str, source: Query, operator: Callable[[DataFrame], DataFrame]) -> None:
    """Register an operator applied to one of the review tables."""
    _query(name)(lambda spark, sf_dir: operator(source(spark, sf_dir)))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.preprocess(reviews(spark, sf_dir))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(_cleaned(spark, sf_dir), "cleaned")


def _worded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.add_cleaned_text(reviews(spark, sf_dir))


def _talk(spark: SparkSession, sf_dir: str) -> DataFrame:
    talk = table(spark, sf_dir, "conversations")
    return clean.add_cleaned_text(talk).select("conv_id", "turn", "cleaned_text")


def _order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "value")


# Sources, sinks and generators.


@_query("read_reviews_csv")
def _read_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "reviews-csv")
    write_csv(reviews(spark, sf_dir), path)
    return read_reviews_csv(spark, path)


@_query("read_reviews_csv_split")
def _read_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "reviews-csv")
    write_csv(reviews(spark, sf_dir), path)
    return read_reviews_csv(spark, path, split=True)


@_query("acquire_reviews")
def _acquire(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_reviews(spark, "parquet", f"{sf_dir}/conversations.parquet")


@_query("acquire_local")
def _acquire_local(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the local source finds is read as it is and not generated again."""
    path = new_path(spark, "reviews-local")
    write_csv(reviews(spark, sf_dir), path)
    return load_reviews(spark, "local", path)


@_query("acquire_table")
def _acquire_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    order_reviews(spark, sf_dir).createOrReplaceTempView("acquired_reviews")
    return load_reviews(spark, "table", "acquired_reviews")


_on("acquire_profile", reviews, validate.acquire_profile)
_on("synth_reviews_basic", _order_ids, lambda ids: generate.synthetic_reviews(ids, "basic", SEED))
_on(
    "synth_reviews_extended",
    _order_ids,
    lambda ids: generate.synthetic_reviews(ids, "extended", SEED),
)
_on("synth_votes", _order_ids, lambda ids: generate.synthetic_votes(ids, SEED))
_on(
    "synth_null_injection",
    _order_ids,
    lambda ids: ids.filter(
        generate.lowest_draws(ids, generate.NULL_TEXT_SHARE, SEED, "null_text")
    ),
)
_on(
    "synth_outlier_injection",
    _order_ids,
    lambda ids: ids.filter(generate.lowest_draws(ids, generate.OUTLIER_SHARE, SEED, "outlier")),
)
_on("sample_head", reviews, generate.sample_head)
_on("dataset_stats", reviews, bias.dataset_stats)
_on("rating_counts", reviews, bias.rating_counts)


@_query("write_clean")
def _write_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "clean-csv")
    write_csv(_cleaned(spark, sf_dir), path)
    return read_reviews_csv(spark, path)


@_query("validation_json")
def _validation_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "validation-json")
    write_json(validate.validation_report(reviews_dup(spark, sf_dir)), path)
    document = F.col("value")
    asked = {
        "total_records": "$.total_records",
        "rating_max": "$.data_ranges.rating.max",
        "rating_valid": "$.data_ranges.rating.valid",
        "missing_text": "$.missing_values.text.missing_count",
        "exact_duplicates": "$.duplicates.exact_duplicates",
        "validation_passed": "$.validation_passed",
    }
    return spark.read.text(path).select(
        *[F.get_json_object(document, at).alias(name) for name, at in asked.items()]
    )


@_query("bias_report")
def _bias_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = bias_report(reviews(spark, sf_dir))
    return spark.createDataFrame(list(enumerate(lines, 1)), "line_number bigint, line string")


# Cleaning.

_on("clean_text", reviews, lambda df: clean.add_cleaned_text(df).select("review_id", "cleaned_text"))


@_query("clean_text_html")
def _clean_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"))
    return clean.add_cleaned_text(pages, strip_tags=True).drop("text")


_on("clean_text_conversations", _talk, lambda df: df)
_on(
    "drop_empty_text",
    _worded,
    lambda df: clean.drop_empty_text(df).select("review_id", "user_id", "cleaned_text"),
)
_on(
    "text_stats",
    _worded,
    lambda df: clean.add_text_stats(df).select("review_id", "user_id", "text_length", "word_count"),
)
_on(
    "avg_word_length",
    _worded,
    lambda df: clean.add_text_stats(df)
    .transform(clean.add_avg_word_length)
    .select("review_id", "user_id", "avg_word_length"),
)
_on("fill_text", reviews, lambda df: clean.fill_text(df).select("review_id", "user_id", "text"))
_on(
    "impute_rating",
    reviews,
    lambda df: clean.impute_rating(df).select("review_id", "user_id", "date", "rating"),
)
_on(
    "fill_votes",
    reviews,
    lambda df: clean.fill_votes(df).select(
        "review_id", "user_id", "useful_votes", "funny_votes", "cool_votes"
    ),
)
_on("drop_null_ids", reviews, clean.drop_null_ids)
_on(
    "handle_missing_values",
    reviews,
    clean.handle_missing_values,
)
_on(
    "normalize_votes",
    _stored,
    lambda df: clean.normalize_votes(df).select(
        "review_id", "user_id", "useful_votes", "useful_votes_normalized"
    ),
)
_on("length_filter", _cleaned, lambda df: clean.filter_length(df).drop("text", "cleaned_text"))
_on(
    "drop_duplicate_ids",
    lambda spark, sf_dir: clean.drop_null_ids(reviews_dup(spark, sf_dir)),
    clean.drop_duplicate_ids,
)
_on("preprocess", reviews, clean.preprocess)
_on("preprocess_rich", reviews, lambda df: clean.preprocess(df, RICH))

# Features.

_on(
    "temporal_features",
    reviews,
    lambda df: features.temporal_features(df).select(
        "review_id", "user_id", "date", "day_of_week", "month", "quarter", "is_weekend"
    ),
)
_on(
    "temporal_features_orders",
    order_reviews,
    lambda df: features.temporal_features(df).select(
        "review_id", "date", "day_of_week", "month", "quarter", "is_weekend"
    ),
)
_on(
    "rating_flags",
    reviews,
    lambda df: features.rating_flags(df).select(
        "review_id", "user_id", "rating", "is_positive", "is_negative", "is_neutral"
    ),
)
_on(
    "lexicon_counts",
    _worded,
    lambda df: features.lexicon_counts(df).select(
        "review_id", "user_id", "positive_word_count", "negative_word_count"
    ),
)
_on(
    "lexicon_counts_conversations",
    _talk,
    lambda df: features.lexicon_counts(df).drop("cleaned_text"),
)
_on(
    "sentiment_score",
    _worded,
    lambda df: features.sentiment_features(df).select("review_id", "user_id", "sentiment_score"),
)
_on(
    "interaction_features",
    _cleaned,
    lambda df: features.interaction_features(df).select(
        "review_id", "user_id", "rating_length_interaction", "votes_to_length_ratio"
    ),
)
_on(
    "sentiment_label",
    reviews,
    lambda df: df.select(
        "review_id", "user_id", "rating", sentiment_label(F.col("rating")).alias("sentiment_label")
    ),
)
_on("business_stats", reviews, features.business_stats)
_on("business_stats_orders", order_reviews, features.business_stats)
_on("business_features", reviews, lambda df: features.business_features(df).drop("text"))
_on("business_features_orders", order_reviews, features.business_features)
_on("features", _stored, features.create_features)

# Validation.

_on("check_types", reviews, validate.check_types)
_on("range_rating", reviews, validate.range_rating)
_on("range_text_length", reviews, validate.range_text_length)
_on("range_votes", reviews, validate.range_votes)
_on("missing_report", reviews, validate.missing_report)
_on("duplicate_counts", reviews_dup, duplicates.duplicate_counts)
_on("validation_verdict", reviews_dup, validate.validation_verdict)
_on("validation_report", reviews_dup, lambda df: facts(validate.validation_report(df)))

# Bias.

_on("rating_distribution", reviews, bias.rating_distribution)
_on("rating_distribution_orders", order_reviews, bias.rating_distribution)
_on("rating_summary", reviews, bias.rating_summary)
_on("rating_summary_orders", order_reviews, bias.rating_summary)
_on("rating_bias_verdict", reviews, bias.rating_bias_verdict)
_on("bias_recommendations", reviews, bias.bias_recommendations)
_on("category_bias", reviews, lambda df: bias.category_bias(df, "business_category"))
_on("category_bias_orders", order_reviews, lambda df: bias.category_bias(df, "business_category"))
_on("platform_bias", reviews, lambda df: bias.category_bias(df, "platform"))


@_query("category_bias_labels")
def _label_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    return bias.category_bias(labels.withColumnRenamed("toxic", "rating"), "quality")


_on("category_imbalance", reviews, lambda df: bias.category_imbalance(df, "business_category"))
_on("platform_imbalance", reviews, lambda df: bias.category_imbalance(df, "platform"))
_on("monthly_trend", reviews, bias.monthly_trend)
_on("monthly_trend_orders", order_reviews, bias.monthly_trend)
_on("length_bias", _cleaned, bias.length_bias)
_on("length_rating_corr", reviews, bias.length_rating_corr)
_on("bias_analysis", reviews, bias.bias_analysis)

# Anomalies.

_on(
    "outliers_iqr",
    reviews,
    lambda df: anomaly.outliers_iqr(df, "useful_votes").select(
        "review_id", "user_id", "useful_votes"
    ),
)
_on(
    "outliers_iqr_lengths",
    reviews,
    lambda df: anomaly.outliers_iqr(df, "text_length").select(
        "review_id", "user_id", "text_length"
    ),
)
_on("outliers_iqr_events", _events, lambda df: anomaly.outliers_iqr(df, "value"))
_on(
    "outliers_iqr_orders",
    order_reviews,
    lambda df: anomaly.outliers_iqr(df, "useful_votes", Settings(iqr_multiplier=0.5)),
)
_on(
    "outliers_zscore",
    reviews,
    lambda df: anomaly.outliers_zscore(df, "useful_votes").select(
        "review_id", "user_id", "useful_votes"
    ),
)
_on("outliers_zscore_events", _events, lambda df: anomaly.outliers_zscore(df, "value"))
_on("outlier_counts", reviews, anomaly.outlier_counts)
_on("duplicate_rows", reviews_dup, duplicates.duplicate_rows)
_on("suspicious_short", _cleaned, anomaly.suspicious_short)
_on("suspicious_votes", reviews, anomaly.suspicious_votes)
_on("repeated_reviews", reviews, duplicates.repeated_reviews)
_on("suspicious_summary", reviews, anomaly.suspicious_summary)
_on("missing_patterns", reviews, anomaly.missing_patterns)
_on("anomaly_alert", reviews_dup, anomaly.anomaly_alert)
_on("anomaly_report", reviews_dup, lambda df: facts(anomaly.anomaly_report(df)))

# Reports by parts.


def _streamed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state after three batches of a stream, of which the second is run again."""
    base = new_path(spark, "live-reviews")
    source = reviews(spark, sf_dir)
    batches = [source.filter(F.pmod(F.xxhash64("user_id"), F.lit(3)) == i) for i in range(3)]
    for batch in batches:
        batch.write.mode("append").parquet(f"{base}/in")
        live = spark.readStream.schema(source.schema).parquet(f"{base}/in")
        parts.report_stream(live, f"{base}/state").awaitTermination()
    parts.add_part(batches[1], f"{base}/state", "b000000000001")
    return parts.merged(parts.stored_states(spark, f"{base}/state"))


def _yearly_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state of the orders, each year's added as a part."""
    path = new_path(spark, "order-state")
    orders = order_reviews(spark, sf_dir)
    first, last = orders.select(F.min(F.year("date")), F.max(F.year("date"))).first()
    for year in range(first, last + 1) if first is not None else ():
        parts.add_part(orders.filter(F.year("date") == year), path, str(year))
    return parts.merged(parts.stored_states(spark, path))


_on("stream_column_checks", _streamed_state, parts.column_checks)
_on("stream_rating_distribution", _streamed_state, parts.rating_shares)
_on("stream_rating_summary", _streamed_state, parts.rating_moments)
_on("stream_category_bias", _streamed_state, lambda s: parts.category_moments(s, "business_category"))
_on("parts_monthly_trend_orders", _yearly_state, parts.month_moments)
_on("parts_business_stats_orders", _yearly_state, parts.business_moments)


@_query("sketched_events")
def _sketched_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether quartiles from one sketch of each event type lie within twice their bound of the exact ranks."""
    events = table(spark, sf_dir, "events")
    stored = settle(partsketches.sketch_parts(events, ["event_type"], ["value"]), "event-sketches")
    shares = (0.25, 0.5, 0.75)
    found = partsketches.united(stored).select(
        *[partsketches.quantile("value", p).alias(f"q{i}") for i, p in enumerate(shares)]
    )
    value, bound = F.col("value"), 2 * partsketches.RANK_ERROR
    cells = []
    for i, p in enumerate(shares):
        below, upto = (F.avg(test.cast("double")) for test in (value < F.col(f"cuts.q{i}"), value <= F.col(f"cuts.q{i}")))
        within = (below - bound <= p) & (upto + bound >= p)
        cells.append(F.struct(F.lit(p).alias("share"), F.count("value").alias("n"), within.alias("within")))
    checked = with_scalar(events, "cuts", found).agg(F.array(*cells).alias("rows"))
    return checked.select(F.inline("rows"))


_on("common_users_events", _events, lambda df: heavy.common_values(df, "user_id", 0.0005))
_on(
    "common_category_bias_orders",
    order_reviews,
    lambda df: bias.category_bias(heavy.with_others(df, "business_id", 0.001), "business_id"),
)


def _indexed(spark: SparkSession, source: DataFrame, through: int) -> history.Index:
    """An index of the reviews by cool votes, up to and with a number of them; the first part is added twice."""
    index = history.open_index(spark, f"digests_{uuid.uuid4().hex}", new_path(spark, "digests"), 16)
    for votes in (0, *range(through + 1)):
        history.add_part(source.filter(F.col("cool_votes") == votes), index, str(votes))
    return index


@_query("history_duplicate_counts")
def _history_duplicate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.duplicate_counts(_indexed(spark, reviews_dup(spark, sf_dir), 3))


@_query("history_repeats")
def _history_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last part that repeat an earlier part's or each other."""
    source = reviews_dup(spark, sf_dir)
    return history.repeats(source.filter("cool_votes = 3"), _indexed(spark, source, 2), "3")


@_query("stream_distinct_ids")
def _stream_distinct_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids left by a stream of three batches, which is started anew for each; the delay is longer than all dates."""
    base, source = new_path(spark, "live-ids"), reviews_dup(spark, sf_dir).select("review_id", "date")
    for i in range(3):
        source.filter(F.pmod(F.xxhash64("date"), F.lit(3)) == i).write.mode("append").parquet(f"{base}/in")
        live = spark.readStream.schema(source.schema).parquet(f"{base}/in")
        written = drop_repeated_ids(live, "400 days").writeStream.format("parquet").outputMode("append")
        written.option("checkpointLocation", f"{base}/notes").trigger(availableNow=True).start(f"{base}/out").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("review_id", F.col("date").isNull().alias("undated"))


# The whole job.


@_query("job_resumed")
def _job_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of a job that goes on after one that did the features and the bias report."""
    path, source = new_path(spark, "review-job"), reviews_dup(spark, sf_dir)
    process(source, path, stages=["features", "bias"], resume=True)
    return process(source, path, resume=True)


@_query("job_summary")
def _job_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process(reviews_dup(spark, sf_dir), new_path(spark, "review-job"))


@_query("job_short")
def _job_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = [name for name in STAGES if name != "features"]
    return process(reviews_dup(spark, sf_dir), new_path(spark, "review-job"), stages=short)


def _job_output(spark: SparkSession, sf_dir: str, stage: str) -> str:
    path = new_path(spark, "review-job")
    process(reviews_dup(spark, sf_dir), path, stages=[stage])
    return path


@_query("job_features")
def _job_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_job_output(spark, sf_dir, 'features')}/features")


@_query("job_bias")
def _job_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_job_output(spark, sf_dir, 'bias')}/bias_analysis")


@_query("job_anomalies")
def _job_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    document = F.col("value")
    asked = {
        "total_outliers": "$.total_outliers",
        "exact_duplicates": "$.duplicates.exact_duplicates",
        "alert": "$.alert",
        "first_exact_duplicate": "$.duplicates.exact_sample[0]",
    }
    return spark.read.text(f"{_job_output(spark, sf_dir, 'anomalies')}/anomalies").select(
        *[F.get_json_object(document, at).alias(name) for name, at in asked.items()]
    )


@_query("job_outliers")
def _job_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outlier rows that the job writes, each with the tests that found it."""
    found = spark.read.parquet(f"{_job_output(spark, sf_dir, 'anomalies')}/outliers")
    return found.select("review_id", "user_id", *anomaly.NUMERIC_COLUMNS, "found_by")
