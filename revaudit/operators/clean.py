"""Cleaning operators. An absent optional column makes an operator a no-op."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revaudit.functions import text as tx
from revaudit.operators.quantiles import median
from revaudit.operators.scratch import settle
from revaudit.operators.subquery import with_scalar
from revaudit.schema import VOTE_COLUMNS
from revaudit.settings import Settings

# An id is a short string, so this many stay far below a broadcast's limits.
BROADCAST_IDS = 200_000


def fill_text(df: DataFrame) -> DataFrame:
    return df.na.fill("", subset=["text"]) if "text" in df.columns else df


def impute_rating(df: DataFrame) -> DataFrame:
    """Null ratings take the median of all rows given, so run it before rows are dropped."""
    if "rating" not in df.columns:
        return df
    return df.withColumn("rating", F.coalesce(F.col("rating").cast("double"), median(df, "rating")))


def fill_votes(df: DataFrame) -> DataFrame:
    present = [c for c in VOTE_COLUMNS if c in df.columns]
    return df.na.fill(0, subset=present) if present else df


def drop_null_ids(df: DataFrame) -> DataFrame:
    return df.na.drop(subset=["review_id"]) if "review_id" in df.columns else df


def handle_missing_values(df: DataFrame) -> DataFrame:
    """Fill text, ratings and votes, then drop rows without an id."""
    return df.transform(fill_text).transform(impute_rating).transform(fill_votes).transform(
        drop_null_ids
    )


def add_cleaned_text(df: DataFrame, strip_tags: bool = False) -> DataFrame:
    """Add the cleaned text.

    It comes from a one-element explode: the optimizer would copy a plain column's expression
    into every later filter on it, and clean each text again for each of them.
    """
    others = [c for c in df.columns if c != "cleaned_text"]
    cleaned = F.explode(F.array(tx.clean_text(F.col("text"), strip_tags)))
    return df.select(*others, cleaned.alias("cleaned_text"))


def drop_empty_text(df: DataFrame) -> DataFrame:
    return df.filter(F.col("cleaned_text") != "")


def add_text_stats(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "text_length": F.length("cleaned_text").cast("bigint"),
            "word_count": tx.word_count(F.col("cleaned_text")),
        }
    )


def add_avg_word_length(df: DataFrame) -> DataFrame:
    mean = tx.average_word_length(F.col("text_length"), F.col("word_count"))
    return df.withColumn("avg_word_length", mean)


def normalize_votes(df: DataFrame) -> DataFrame:
    """Standard score of useful votes; null where the sample deviation is 0 or undefined."""
    if "useful_votes" not in df.columns:
        return df
    votes = F.col("useful_votes")
    moments = df.agg(F.avg(votes).alias("mean"), F.stddev_samp(votes).alias("deviation"))
    score = (votes - F.col("moments.mean")) / F.nullif(F.col("moments.deviation"), F.lit(0.0))
    scored = with_scalar(df, "moments", moments)
    return scored.withColumn("useful_votes_normalized", score).drop("moments")


def filter_length(df: DataFrame, shortest: int = 10, longest: int = 5000) -> DataFrame:
    """Keep texts of ``shortest`` to ``longest`` characters, both included."""
    return df.filter(F.col("text_length").between(shortest, longest))


def drop_duplicate_ids(df: DataFrame, broadcast_up_to: int = BROADCAST_IDS) -> DataFrame:
    """One row per review id, the one with the lowest text.

    Ids are counted first, and only rows of repeated ids are put together; rows of other ids stay
    where they are. Up to ``broadcast_up_to`` repeated ids are broadcast. A minimum over structs
    combines on the map side, so a very frequent id costs one row per task.
    """
    counted = df.groupBy("review_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    repeated = settle(counted.select(F.col("review_id").alias("repeated_id")), "repeated-ids")
    if repeated.limit(broadcast_up_to + 1).count() <= broadcast_up_to:
        repeated = F.broadcast(repeated)
    same = F.col("review_id").eqNullSafe(F.col("repeated_id"))
    rest = [c for c in df.columns if c not in ("review_id", "text")]
    kept = (
        df.join(repeated, same, "left_semi")
        .groupBy("review_id")
        .agg(F.min(F.struct("text", *rest)).alias("kept"))
        .select("review_id", "kept.*")
        .select(*df.columns)
    )
    return df.join(repeated, same, "left_anti").unionByName(kept)


def preprocess(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The cleaning stage: missing values, cleaned text, empty rows out, text statistics."""
    out = handle_missing_values(df)
    if settings.drop_duplicate_ids:
        out = drop_duplicate_ids(out)
    out = add_cleaned_text(out, settings.strip_tags).transform(drop_empty_text)
    out = add_text_stats(out)
    if settings.filter_length:
        out = filter_length(out, settings.min_text_length, settings.max_text_length)
    if settings.rich_columns:
        # Stored once, so that the votes' mean doesn't clean every text again.
        out = settle(add_avg_word_length(out), "cleaned").transform(normalize_votes)
    return out
