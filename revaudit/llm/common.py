"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text as an array; empty for null or blank texts."""
    blank = F.lit("\x20\x09\x0a\x0b\x0c\x0d")
    inner = F.trim(F.coalesce(text, F.lit("")), blank)
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACES))


def held_out(doc_id: Column) -> Column:
    """Rows kept for testing: crc32 of the id's decimal text divisible by 5; null ids are not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most `rows` labelled training rows (doc_id, text, label), the lowest by a hash of the id.

    Half are of each label while there are enough. Rows without an id or label, held-out rows and
    ids whose labels disagree are not used. `documents` are matched by a broadcast of the chosen ids, so
    that texts are not shuffled; their number is `rows`.
    """
    one = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .select("doc_id", "label")
    )
    order = [F.xxhash64("doc_id", F.lit(17)), F.col("doc_id")]
    chosen = None
    for value in (0, 1):
        part = one.where(F.col("label") == value).orderBy(*order).limit(rows // 2)
        chosen = part if chosen is None else chosen.unionByName(part)
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def slices(batch: pa.RecordBatch, column: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch by rows into parts of about `most` bytes of text; a longer text is a part of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for row, size in enumerate(sizes.tolist()):
        if held and held + size > most:
            yield batch.slice(begin, row - begin)
            begin, held = row, 0
        held += size
    yield batch.slice(begin)
