"""Token ids as Parquet list columns, laid out for selective reads.

A folder of token files holds one row per document, in ascending doc_id order over files and within them:

- `tokens/`: doc_id, part, start_in_part, end_in_part, ids. One file per part. The ids are dictionary or delta
  encoded (the writer leaves a dictionary that saves nothing); the other columns, which ascend or are small, are delta encoded. Row groups and pages are
  bounded, and every page has its lowest and highest value in the page index, so that a read of a few
  documents or of a span of tokens skips the other pages of all columns, and a read of sizes never
  touches the ids.
- `parts/`: part, base, docs, n_tokens, first_id, last_id. base is the number of ids in all parts before.

A document's place in the whole run of ids is base + start_in_part. The number of parts follows the number of tokens.
Rows are dealt by doc_id and a row number, so that an id that many rows have spreads over parts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revaudit.llm import bpe
from revaudit.llm.words import lists
from revaudit.operators.scratch import settle

ENCODINGS = ("dictionary", "delta")
#: Bytes of text to a token, as reckoned when texts are dealt to parts.
BYTES_PER_TOKEN = 3


@dataclass(frozen=True)
class Layout:
    """How files are cut. Sizes in bytes are of encoded values before compression."""

    tokens_per_part: int = 8_000_000
    row_group_bytes: int = 16 << 20
    page_bytes: int = 128 << 10
    page_rows: int = 1000
    encoding: str = "dictionary"

    def options(self) -> dict[str, str]:
        if self.encoding not in ENCODINGS:
            raise ValueError(f"encoding is one of {ENCODINGS}")
        return {
            "parquet.writer.version": "v2",  # whole numbers without a dictionary are then delta encoded
            "parquet.enable.dictionary": "false",
            "parquet.enable.dictionary#ids.list.element": str(self.encoding == "dictionary").lower(),
            "parquet.block.size": str(self.row_group_bytes),
            "parquet.page.size": str(self.page_bytes),
            "parquet.page.row.count.limit": str(self.page_rows),
            "parquet.page.write-checksum.enabled": "true",
        }


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The place of each row in its part: batches of one task come in the part's order."""
    from pyspark import TaskContext

    part, used = TaskContext.get().partitionId(), 0
    for batch in batches:
        sizes = pc.list_value_length(batch.column("ids")).to_numpy().astype(np.int64)
        ends = used + np.cumsum(sizes)
        numbers = [pa.array(np.full(len(sizes), part), pa.int32()), pa.array(ends - sizes), pa.array(ends)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *numbers, batch.column("ids")],
            ["doc_id", "part", "start_in_part", "end_in_part", "ids"],
        )
        used = int(ends[-1]) if len(ends) else used


def write(encoded: DataFrame, path: str, layout: Layout = Layout()) -> None:
    """Write doc_id and ids (array<int>) as token files below `path`, which must not exist.

    Rows without doc_id come last; rows of one doc_id follow each other, in order of a hash of their ids. Null ids
    count as none. Other columns are left out. An empty table gives files without rows.
    """
    spark = encoded.sparkSession
    none = F.array().cast("array<int>")
    rows = encoded.select("doc_id", F.coalesce(F.col("ids").cast("array<int>"), none).alias("ids"))
    sized = rows.select("*", F.size("ids").cast("long").alias("n_tokens"), F.monotonically_increasing_id().alias("row"))
    rows = settle(sized, "tokens-encoded")  # what follows samples its input
    total = rows.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n")).first()["n"]
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("ids"), F.col("row")]
    dealt = rows.repartitionByRange(max(1, -(-total // layout.tokens_per_part)), *order).sortWithinPartitions(*order)
    _write_parts(dealt.select("doc_id", "ids").mapInArrow(_number, _columns(encoded)), path, layout)


def _columns(table: DataFrame) -> str:
    kind = table.schema["doc_id"].dataType.simpleString()
    return f"doc_id {kind}, part int, start_in_part long, end_in_part long, ids array<int>"


def _write_parts(numbered: DataFrame, path: str, layout: Layout) -> None:
    numbered.write.options(**layout.options()).parquet(f"{path}/tokens")
    sums = numbered.sparkSession.read.parquet(f"{path}/tokens").groupBy("part").agg(
        F.count("*").alias("docs"), F.max("end_in_part").alias("n_tokens"),
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"),
    )
    # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = (F.sum("n_tokens").over(before) - F.col("n_tokens")).alias("base")
    sums.select("part", base, "docs", "n_tokens", "first_id", "last_id").coalesce(1).write.parquet(f"{path}/parts")


def _with_ends(batches: Iterator[pa.RecordBatch], end_id: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        sizes = pc.list_value_length(ids).to_numpy()
        flat = np.insert(pc.list_flatten(ids).to_numpy(), np.cumsum(sizes), end_id)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists(flat, sizes + 1, pa.int32())], ["doc_id", "ids"])


def write_documents(documents: DataFrame, tokenizer_path: str, end_id: int, path: str, layout: Layout = Layout()) -> None:
    """Encode `documents` (doc_id, text) and write their ids, the end id behind each document's own, as token files.

    Texts are put in order of doc_id first, encoded and written by the same task, so that ids are never shuffled.
    Null and empty texts have the end id only. Rows without doc_id come last; rows of one doc_id follow each
    other, in order of a hash of their texts. Other columns are not read. An empty table gives files without rows.
    """
    encoder = bpe.encoder(documents, tokenizer_path)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _number(_with_ends(encoder(batches), end_id))

    rows = documents.select("doc_id", "text")
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-size // (layout.tokens_per_part * BYTES_PER_TOKEN)))
    order = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    # the random number splits rows that are equal in all else
    dealt = rows.repartitionByRange(parts, *order, F.rand(11)).sortWithinPartitions(*order)
    _write_parts(dealt.mapInArrow(work, _columns(documents)), path, layout)


def read(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens and, unless left out, ids. start is the number of ids in all documents before.

    Filters on doc_id reach the files' row groups and pages.
    """
    rows = spark.read.parquet(f"{path}/tokens")
    parts = spark.read.parquet(f"{path}/parts").select("part", "base")  # one row per file
    start, size = F.col("base") + F.col("start_in_part"), F.col("end_in_part") - F.col("start_in_part")
    return rows.join(F.broadcast(parts), "part").select(
        "doc_id", start.alias("start"), size.alias("n_tokens"), *["ids"] * ids
    )


def read_span(spark: SparkSession, path: str, start: int, stop: int) -> DataFrame:
    """doc_id, start, ids: the ids with start <= place < stop, cut at both ends; documents outside are not read.

    Of the files, only those whose part overlaps the span are looked into; of the first and the last, only the pages
    that the page index leaves.
    """
    if not 0 <= start <= stop:
        raise ValueError("a span has 0 <= start <= stop")
    parts = spark.read.parquet(f"{path}/parts")
    overlaps = (F.col("base") < stop) & (F.col("base") + F.col("n_tokens") > start)
    at = parts.where(overlaps).agg(
        F.min("part").alias("first"), F.min("base").alias("low"), F.max("part").alias("last"), F.max("base").alias("high")
    ).first()
    rows = spark.read.parquet(f"{path}/tokens")
    if at["first"] is None:
        rows = rows.where(F.lit(False))
    else:
        rows = rows.where(
            F.col("part").between(at["first"], at["last"])
            & ((F.col("part") > at["first"]) | (F.col("end_in_part") > start - at["low"]))
            & ((F.col("part") < at["last"]) | (F.col("start_in_part") < stop - at["high"]))
        )
    rows = rows.join(F.broadcast(parts.select("part", "base")), "part")
    place = F.col("base") + F.col("start_in_part")
    skip = F.greatest(F.lit(start) - place, F.lit(0))
    take = F.least(F.lit(stop) - F.col("base"), F.col("end_in_part")) - F.col("start_in_part") - skip
    cut = rows.select("doc_id", (place + skip).alias("start"), F.slice("ids", (skip + 1).cast("int"), take.cast("int")).alias("ids"))
    return cut.where(F.size("ids") > 0)


def _checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        flat = pc.list_flatten(ids).to_numpy().astype("<u4", copy=False)
        ends = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy())
        sums = [zlib.crc32(flat[a:b]) for a, b in zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(sums, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what `read` gives: crc32 of the ids as little-endian unsigned 32-bit numbers."""
    kind = tokens.schema["doc_id"].dataType.simpleString()
    rows = tokens.select("doc_id", "start", "n_tokens", "ids")
    return rows.mapInArrow(_checksums, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")
