"""Duplicates against history: a stored index of digests, bucketed by key.

The index is a table with one row per part and different key, in buckets of the key's hash and sorted within
them, with Bloom filters in its files. Old rows are never shuffled again: a new part is dealt out
to the buckets and merged with them, a single text is looked up in one bucket, and the counts over all
parts are grouped inside the buckets. Rows name their part, and the rows that a part has of a key
are taken once, so adding a part again changes nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revaudit.operators.duplicates import ALL_SETS, BY_TEXT, _counted, keyed_reviews, text_digest


@dataclass(frozen=True)
class Index:
    spark: SparkSession
    name: str
    buckets: int

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)


def open_index(spark: SparkSession, name: str, path: str, buckets: int = 64) -> Index:
    """The index at a path, under a table name of the session's catalog; an empty one if there is none.

    A later session must name the same number of buckets. Choose it so that a bucket of all history fits a task.
    """
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS `{name}` (key BINARY, duplicate_set STRING, part STRING, rows BIGINT)
        USING parquet OPTIONS ('parquet.bloom.filter.enabled#key' = 'true')
        CLUSTERED BY (key) SORTED BY (key) INTO {buckets} BUCKETS LOCATION '{path}'"""
    )
    spark.catalog.refreshTable(f"`{name}`")
    return Index(spark, f"`{name}`", buckets)


def _whole_key(name: Column, key: Column) -> Column:
    """One key for all sets, so that buckets are by it alone; null is a key of its own."""
    return F.when(key.isNull(), F.concat(name, F.lit("?")).cast("binary")).otherwise(
        F.concat(F.concat(name, F.lit("=")).cast("binary"), key)
    )


def _keyed(df: DataFrame, sets: Sequence[str]) -> DataFrame:
    rows = keyed_reviews(df, sets)
    return rows.withColumn("key", _whole_key(F.col("duplicate_set"), F.col("key")))


def _per_key(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("key").agg(
        F.any_value("duplicate_set").alias("duplicate_set"), F.count(F.lit(1)).alias("rows")
    )


def add_part(df: DataFrame, index: Index, part: str, sets: Sequence[str] = ALL_SETS) -> None:
    """Add the digests of a part, which must be the same rows whenever it is added again."""
    counted = _per_key(_keyed(df, sets)).withColumn("part", F.lit(part))
    dealt = counted.repartition(index.buckets, "key").select("key", "duplicate_set", "part", "rows")
    dealt.write.mode("append").insertInto(index.name)


def _held(rows: DataFrame) -> DataFrame:
    """Rows per key over the parts, each part's once; needs no exchange."""
    once = rows.groupBy("key", "part").agg(
        F.any_value("duplicate_set").alias("duplicate_set"), F.max("rows").alias("rows")
    )
    return once.groupBy("key").agg(
        F.any_value("duplicate_set").alias("duplicate_set"), F.sum("rows").alias("rows")
    )


def duplicate_counts(index: Index) -> DataFrame:
    """One row, as `duplicates.duplicate_counts` of all parts together, from the index alone."""
    return _counted(_held(index.rows()).filter(F.col("rows") > 1)).drop("repeated_groups")


def repeats(df: DataFrame, index: Index, part: str, sets: Sequence[str] = ALL_SETS) -> DataFrame:
    """The rows of a part that repeat a row of it or of another part: review_id, duplicate_set,
    rows_here and rows_before (of the same key, here and in the other parts)."""
    keyed = _keyed(df, sets)
    here = _per_key(keyed).select("key", F.col("rows").alias("rows_here"))
    before = _held(index.rows().filter(F.col("part") != part)).select("key", F.col("rows").alias("rows_before"))
    known = (
        here.join(before, "key", "left")
        .select("key", "rows_here", F.coalesce("rows_before", F.lit(0)).cast("bigint").alias("rows_before"))
        .filter("rows_here > 1 OR rows_before > 0")
    )
    return keyed.join(known, "key").select("review_id", "duplicate_set", "rows_here", "rows_before")


def parts_with_text(index: Index, text: str) -> DataFrame:
    """The parts that have a text, and how often: reads one bucket, and of it what its Bloom filters admit."""
    digest = index.spark.range(1).select(F.lit(text).alias("text")).select(text_digest("text")).first()[0]
    key = F.lit(f"{BY_TEXT}=".encode() + bytes(digest))
    return index.rows().filter(F.col("key") == key).groupBy("part").agg(F.max("rows").alias("rows"))
