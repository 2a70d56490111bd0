"""The row-wise stages on a stream of reviews.

Operators that look at one row at a time run here: filling, cleaning, text statistics, time and
sentiment features. Repeated ids may be dropped on the way, as far back as a delay says. Medians and
reports need whole tables; run those on the Parquet table this stream appends to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from revaudit.operators import clean, features
from revaudit.settings import Settings


def clean_rows(reviews: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The stateless part of cleaning and features; runs alike on batches and streams."""
    return (
        clean.fill_text(reviews)
        .transform(clean.fill_votes)
        .transform(clean.drop_null_ids)
        .transform(clean.add_cleaned_text, settings.strip_tags)
        .transform(clean.drop_empty_text)
        .transform(clean.add_text_stats)
        .transform(features.temporal_features)
        .transform(features.sentiment_features, settings)
        .transform(features.interaction_features)
    )


def drop_repeated_ids(reviews: DataFrame, delay: str) -> DataFrame:
    """The first row to arrive of each review id, as far back as a delay behind the latest date.

    An id is held until the mark, the latest date of earlier batches less the delay, passes its row's date plus
    the delay; a repeat until then goes, a later one comes out again. Rows dated before the mark are late and go.
    Rows without an id or a date are no repeats and always pass. State holds the ids within the
    delay, spread by id; keep it in RocksDB if they are many.
    """
    timed = F.col("review_id").isNotNull() & F.col("date").isNotNull()
    mark = "_mark" + "_" * max((len(c) for c in reviews.columns), default=0)
    once = (
        reviews.filter(timed)
        .withColumn(mark, F.col("date").cast("timestamp"))
        .withWatermark(mark, delay)
        .dropDuplicatesWithinWatermark(["review_id"])
        .drop(mark)
    )
    return once.unionByName(reviews.filter(~timed))


def append_clean_rows(
    reviews: DataFrame,
    out_path: str,
    progress_path: str | None = None,
    settings: Settings = Settings(),
    once_within: str | None = None,
) -> StreamingQuery:
    """Process what has arrived and append it to a Parquet table; call again for later input.

    With ``once_within``, a delay such as "30 days", repeated ids are dropped (`drop_repeated_ids`).

    What has been read is noted in ``progress_path``, by default a folder beside the table and
    named after it. The table and its notes belong together: the sink skips batches that it has
    already written, so new notes for an old table would lose rows.
    """
    progress = progress_path or f"{out_path.rstrip('/')}-progress"
    if once_within is not None:
        reviews = drop_repeated_ids(reviews, once_within)
    return (
        clean_rows(reviews, settings)
        .writeStream.format("parquet")
        .option("checkpointLocation", progress)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(out_path)
    )
