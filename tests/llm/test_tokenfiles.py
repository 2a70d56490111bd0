from __future__ import annotations

import glob
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import odd_documents
from revaudit.llm import queries, tokenfiles
from revaudit.llm.tokenfiles import Layout

SCHEMA = "doc_id long, ids array<int>"
SMALL = Layout(tokens_per_part=3000, row_group_bytes=4096, page_bytes=512, page_rows=20)


def made(spark, count: int, seed: int = 2, most: int = 49_408):
    rng = random.Random(seed)
    rows = [(i * 3, [rng.randrange(most) for _ in range(rng.randint(0, 60))]) for i in range(count)]
    return rows, spark.createDataFrame(rng.sample(rows, count), SCHEMA).repartition(4)


@pytest.mark.parametrize("encoding", tokenfiles.ENCODINGS)
def test_round_trip_in_order_of_id(spark, tmp_path, encoding):
    rows, table = made(spark, 500, most=90)
    path = str(tmp_path / "tokens")
    tokenfiles.write(table, path, Layout(tokens_per_part=3000, row_group_bytes=4096, page_bytes=512, page_rows=20, encoding=encoding))
    back = tokenfiles.read(spark, path).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["ids"]) for r in back] == rows
    sizes = [len(ids) for _, ids in rows]
    assert [r["n_tokens"] for r in back] == sizes and [r["start"] for r in back] == list(np.cumsum([0, *sizes[:-1]]))
    files = sorted(glob.glob(path + "/tokens/*.parquet"))
    assert len(files) > 3
    in_files = [i for f in files for i in pq.read_table(f).column("doc_id").to_pylist()]
    assert in_files == [i for i, _ in rows]  # over files and within them
    for f in files:
        meta = pq.ParquetFile(f).metadata
        group = meta.row_group(0)
        columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
        assert all(c.has_offset_index and c.has_column_index for c in columns.values())
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
        ids = columns["ids.list.element"].encodings
        assert ("RLE_DICTIONARY" in ids) == (encoding == "dictionary")
        assert ("DELTA_BINARY_PACKED" in ids) == (encoding == "delta")


def test_selective_reads(spark, tmp_path):
    rows, table = made(spark, 400)
    path = str(tmp_path / "tokens")
    tokenfiles.write(table, path, SMALL)
    whole = [i for _, ids in rows for i in ids]
    for start, stop in [(0, 1), (0, len(whole)), (4000, 4321), (2999, 6001), (len(whole) - 5, len(whole) + 9), (7, 7), (len(whole), len(whole) + 1)]:
        span = tokenfiles.read_span(spark, path, start, stop).orderBy("start").collect()
        assert [i for r in span for i in r["ids"]] == whole[start:stop]
        assert not span or span[0]["start"] == start
    with pytest.raises(ValueError, match="span"):
        tokenfiles.read_span(spark, path, 4, 2)
    few = tokenfiles.read(spark, path).where("doc_id between 300 and 330")
    assert sorted(r["doc_id"] for r in few.collect()) == list(range(300, 331, 3))
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,300)" in plan and "LessThanOrEqual(doc_id,330)" in plan
    sizes = tokenfiles.read(spark, path, ids=False)
    assert "ids" not in sizes.columns and "ids:array" not in sizes._jdf.queryExecution().executedPlan().toString()
    span = tokenfiles.read_span(spark, path, 4000, 4321)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in span and "start_in_part" in span.split("PushedFilters")[1]


def test_repeated_and_null_ids_spread_over_parts(spark, tmp_path):
    rows = [(5, [i % 7, i]) for i in range(3000)] + [(None, [1, 2]), (None, None), (9, None), (1, [])]
    path = str(tmp_path / "tokens")
    tokenfiles.write(spark.createDataFrame(rows, SCHEMA).withColumn("part", F.lit("clash")), path, Layout(tokens_per_part=500))
    back = tokenfiles.read(spark, path).collect()
    assert len(back) == len(rows) and sum(r["n_tokens"] for r in back) == 6002
    assert sorted(tuple(r["ids"]) for r in back if r["doc_id"] == 5) == sorted(tuple(i) for d, i in rows if d == 5)
    order = sorted(back, key=lambda r: (r["start"], r["n_tokens"]))
    assert [r["doc_id"] for r in order][:2] == [1, 5] and {r["doc_id"] for r in order[-2:]} == {None}
    assert len(glob.glob(path + "/tokens/*.parquet")) > 5
    most = max(len(pq.read_table(f)) for f in glob.glob(path + "/tokens/*.parquet"))
    assert most < 1000


def test_empty_table_and_unknown_encoding(spark, tmp_path):
    path = str(tmp_path / "none")
    tokenfiles.write(spark.createDataFrame([], SCHEMA), path)
    assert tokenfiles.checksums(tokenfiles.read(spark, path)).count() == 0
    assert tokenfiles.read_span(spark, path, 0, 10).count() == 0
    with pytest.raises(ValueError, match="encoding"):
        tokenfiles.write(spark.createDataFrame([], SCHEMA), str(tmp_path / "x"), Layout(encoding="plain"))


def brute(rows: list[tuple[int, str | None]]) -> list[tuple]:
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, out = 0, []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query_equals_library(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").orderBy("doc_id").collect()
    found = queries.op12_token_files(spark, sf_dir)
    assert found.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, found.collect())) == brute([(r["doc_id"], r["text"]) for r in texts])


def test_odd_rows(spark, tmp_path):
    path = str(tmp_path / "odd")
    odd = odd_documents(spark)
    tokenfiles.write_documents(odd, public_tokenizers.path("word_bpe_49k.json"), 2, path, Layout(tokens_per_part=30_000))
    found = tokenfiles.checksums(tokenfiles.read(spark, path)).collect()
    expected = brute([(r["doc_id"], r["text"]) for r in odd.collect()])
    key = lambda r: (str(r[0]), r[2], r[3])
    assert sorted(map(key, map(tuple, found))) == sorted(map(key, expected))
    starts = sorted((r["start"], r["n_tokens"]) for r in found)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
