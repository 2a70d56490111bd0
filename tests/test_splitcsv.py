from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from revaudit.catalog import oracles
from revaudit.catalog import queries as registered
from revaudit.sources import splitcsv
from revaudit.sources.readers import read_reviews_csv
from revaudit.sources.writers import write_csv

CELLS = ["plain", "", 'say ""hi""', "two\nlines", "a\r\nb\r\n", 'end ""', ',,""\n""', "é 日本\n\n\nx", "NA", " blank "]


def written(seed: int, rows: int, newline: str, last: bool) -> bytes:
    rng = random.Random(seed)
    lines = ["review_id,text,rating,note"]
    for i in range(rows):
        text = rng.choice(CELLS) * rng.choice([1, 1, 1, 30])
        quoted = f'"{text}"' if rng.random() < 0.8 or set(text) & set('",\n\r') else text
        lines.append(f"R{i},{quoted},{rng.choice(['', '3', '4.5', 'NA'])},{rng.choice(['x', '', chr(34) * 2])}")
        if rng.random() < 0.05:
            lines.append("")
    return (newline.join(lines) + (newline if last else "")).encode()


@pytest.fixture
def small_blocks(spark):
    held = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for c, v in held.items():
        spark.conf.set(c, v)


@pytest.mark.parametrize("newline, last, broadcast", [("\n", True, 100_000), ("\r\n", False, 100_000), ("\n", False, 1)])
def test_blocks_give_the_rows_of_the_whole_file(spark, tmp_path, monkeypatch, small_blocks, newline, last, broadcast):
    monkeypatch.setattr(splitcsv, "BROADCAST_BLOCKS", broadcast)
    for k in (1, 2):
        (tmp_path / f"{k}.csv").write_bytes(written(k, 700, newline, last))
    path = str(tmp_path)
    found = read_reviews_csv(spark, path, split=True)
    assert splitcsv._lines(spark, path).rdd.getNumPartitions() > 10
    order = lambda df: sorted(map(str, df.collect()))
    plain = read_reviews_csv(spark, path)
    assert found.schema == plain.schema and order(found) == order(plain) and found.count() == 1400
    inside = splitcsv.block_starts(splitcsv._lines(spark, path))
    assert inside.where("inside").count() > 3


def test_a_cell_longer_than_many_blocks(spark, tmp_path, small_blocks):
    long = "\n".join(f'line {i} ""q""' for i in range(2000))
    (tmp_path / "one.csv").write_text(f'review_id,text\nR1,"{long}"\nR2,short\nR3,"{long}"')
    rows = read_reviews_csv(spark, str(tmp_path / "one.csv"), split=True).collect()
    assert {r["review_id"]: r["text"] for r in rows} == {"R1": long.replace('""', '"'), "R2": "short", "R3": long.replace('""', '"')}


def test_only_a_header_and_round_trip(spark, tmp_path):
    (tmp_path / "none.csv").write_text("review_id,text\n")
    assert read_reviews_csv(spark, str(tmp_path / "none.csv"), split=True).collect() == []
    df = spark.createDataFrame(
        [("R1", ' a "b"\n, c\r\nd ', 4.5, 3), ("R2", None, None, None)], "review_id string, text string, rating double, useful_votes long"
    ).withColumn("text", F.col("text"))
    write_csv(df, str(tmp_path / "out"))
    assert sorted(read_reviews_csv(spark, str(tmp_path / "out"), split=True).collect()) == sorted(df.collect())


def test_query_equals_sql(spark, sf_dir):
    name = "read_reviews_csv_split"
    found = differences(registered.queries()[name](spark, sf_dir), connect(sf_dir), oracles.oracle_sql()[name])
    assert not found, "\n".join(found)
