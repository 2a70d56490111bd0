"""CSV files with line breaks inside quoted cells, read in blocks by many tasks.

A line break ends a record if the number of quotes before it in the file is even; doubled quotes inside a cell
don't change that. So one pass counts the quotes of each block of lines, and the exclusive or of all blocks
before tells whether a block begins inside a quoted cell. A second pass then cuts each block into records on its
own. Only what reaches across a block's border is put together afterwards: at most a head and a tail for each block.

Quotes must be used as RFC 4180 has it: around whole cells, and doubled inside them. A lone quote in an unquoted cell
would shift all that follows; such files need the plain reader.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from revaudit.operators.scratch import settle

#: Blocks whose beginnings are broadcast, about 200 bytes each; those of more are joined by a shuffle.
BROADCAST_BLOCKS = 100_000

_WHOLE, _HEAD, _MIDDLE, _TAIL = 0, 1, 2, 3
_PIECE = "path string, block long, kind int, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line of the files with its file and block; carriage returns stay."""
    return spark.read.text(path, lineSep="\n").select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    )


def block_starts(lines: DataFrame) -> DataFrame:
    """path, block, inside (whether the block begins inside a quoted cell) and crlf (how the file's first line ends)."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    odd = lines.withColumn("line", F.monotonically_increasing_id()).groupBy("path", "block").agg(
        (F.sum(quotes) % 2).alias("odd"), F.min_by(F.endswith("value", F.lit("\r")), "line").alias("crlf")
    )
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = (F.sum("odd").over(before) - F.col("odd")) % 2 == 1
    return odd.select("path", "block", inside.alias("inside"), F.first("crlf").over(before).alias("crlf"))


class _Block:
    """The records of one block of lines, handed in part by part."""

    def __init__(self, inside: bool) -> None:
        self.odd, self.begun_inside, self.pending = int(inside), inside, None

    def add(self, lines: pa.Array) -> list[tuple[int, str]]:
        quotes = pc.count_substring(lines, '"').to_numpy()
        odd = (self.odd + np.cumsum(quotes)) % 2
        ends = np.flatnonzero(odd == 0) + 1
        self.odd = int(odd[-1])
        offsets = np.unique(np.concatenate([[0], ends, [len(lines)]]))
        whole = pa.LargeListArray.from_arrays(pa.array(offsets, pa.int64()), lines.cast(pa.large_string()))
        texts = pc.binary_join(whole, pa.scalar("\n", pa.large_string())).to_pylist()
        if self.pending is not None:
            texts[0] = self.pending + "\n" + texts[0]
        self.pending = texts.pop() if len(texts) > len(ends) else None
        out = [(_WHOLE, t) for t in texts]
        if out and self.begun_inside:
            out[0], self.begun_inside = (_HEAD, out[0][1]), False
        return out

    def rest(self) -> list[tuple[int, str]]:
        if self.pending is None:
            return []
        return [(_MIDDLE if self.begun_inside else _TAIL, self.pending)]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of a task come in the order of their file; blocks follow each other."""
    at, block = None, None

    def rows(key, found):
        kinds, texts = zip(*found, strict=True)
        n = len(found)
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]] * n), pa.array([key[1]] * n, pa.int64()), pa.array(kinds, pa.int32()), pa.array(texts)],
            ["path", "block", "kind", "text"],
        )

    for batch in batches:
        path, start = batch.column("path").dictionary_encode(), batch.column("block").to_numpy()
        code = path.indices.to_numpy()
        change = np.flatnonzero((code[1:] != code[:-1]) | (start[1:] != start[:-1])) + 1
        for a, b in zip([0, *change], [*change, len(code)], strict=True):
            if a == b:
                continue
            key = (path.dictionary[int(code[a])].as_py(), int(start[a]))
            if key != at:
                if block is not None and (left := block.rest()):
                    yield rows(at, left)
                at, block = key, _Block(batch.column("inside")[int(a)].as_py())
            if found := block.add(batch.column("value").slice(a, b - a)):
                yield rows(at, found)
    if block is not None and (left := block.rest()):
        yield rows(at, left)


def records(spark: SparkSession, path: str) -> DataFrame:
    """path, block and text: one row for each record of the files; block is where its first line's block begins."""
    lines = _lines(spark, path)
    starts = settle(block_starts(lines), "csv-blocks")
    if starts.count() <= BROADCAST_BLOCKS:
        placed = lines.join(F.broadcast(starts), ["path", "block"])  # lines keep their order
    else:
        numbered = lines.withColumn("line", F.monotonically_increasing_id())
        placed = numbered.join(starts, ["path", "block"]).sortWithinPartitions("path", "block", "line").drop("line")
    # as the plain reader has it, line breaks inside cells are single characters if the file's own lines end with two
    value = F.when(F.col("crlf"), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value")).alias("value")
    pieces = placed.select(value, "path", "block", "inside").mapInArrow(_cut, _PIECE)
    edges = settle(pieces.where(F.col("kind") != _WHOLE), "csv-edges")
    # a head ends what the last tail has begun; there are two rows a block at most
    order = Window.partitionBy("path").orderBy("block", "kind")
    begun = F.sum(F.when(F.col("kind") == _TAIL, 1).otherwise(0)).over(order)
    listed = F.array_sort(F.collect_list(F.struct("block", "kind", "text")))
    joined = edges.withColumn("begun", begun).groupBy("path", "begun").agg(F.min("block").alias("block"), listed.alias("parts"))
    crossing = joined.select("path", "block", F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))
    whole = pieces.where(F.col("kind") == _WHOLE).select("path", "block", "text")
    return whole.unionByName(crossing)


def read_split_csv(spark: SparkSession, path: str) -> DataFrame:
    """The records as columns of strings, named by the header that every file begins with; blank lines are left out.

    All files must have the same header. Records of a file's first block that repeat it are left out as well.
    """
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true"}
    plain = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, quote='"', escape='"')
    names = plain.columns
    rows = records(spark, path)
    typed = ", ".join(f"`{n.replace('`', '``')}` STRING" for n in names)
    cells = rows.where(F.length("text") > 0).select(F.from_csv("text", typed, options).alias("cells"), "block")
    header = F.lit(True)
    for n in names:
        header = header & F.col("cells")[n].eqNullSafe(F.lit(n))
    return cells.where(~((F.col("block") == 0) & header)).select(*[F.col("cells")[n].alias(n) for n in names])
