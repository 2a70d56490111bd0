from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from helpers import documents, odd_documents, random_texts, words
from revaudit.llm import queries, sketches
from revaudit.llm.common import table


def shingles(text: str) -> set:
    own = words(text)
    return {tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set()


def edited(texts: dict[int, str]) -> dict[int, str]:
    order = sorted(texts)
    out = {}
    for i, after in zip(order, [*order[1:], order[0]], strict=True):
        quarter = len(texts[i]) // 4
        out[i] = texts[i][: len(texts[i]) - quarter] + texts[after][:quarter]
    return out


def likeness(a: set, b: set) -> float:
    return len(a & b) / len(a | b) if a | b else 1.0


def check(rows, texts: dict[int, str], slack: float) -> None:
    changed, order = edited(texts), sorted(texts)
    after = dict(zip(order, [*order[1:], order[0]], strict=True))
    prints: dict[str, str] = {}
    assert len(rows) == len(texts)
    for r in rows:
        i = r["doc_id"]
        assert r["n_chars"] == len(texts[i])
        assert r["edited_sha256"] == hashlib.sha256(changed[i].encode()).hexdigest()
        assert prints.setdefault(texts[i], r["fingerprint"]) == r["fingerprint"]
        assert prints.setdefault(changed[i], r["edited_fingerprint"]) == r["edited_fingerprint"]
        own = shingles(texts[i])
        assert abs(r["near_edited"] - likeness(own, shingles(changed[i]))) <= slack
        assert abs(r["near_next"] - likeness(own, shingles(texts[after[i]]))) <= slack


def test_short_texts_are_exact(spark):
    texts = {i: t for i, t in enumerate(random_texts(1, 300, longest=40))}
    check(sketches.compare_with_edit(documents(spark, texts)).collect(), texts, 1e-9)


@pytest.mark.parametrize("ids", [[-5, 0, 3, 1 << 20, (1 << 20) + 1, 1 << 40, (1 << 62) + 5], [9], [1, 200, 90_000]])
def test_next_over_gaps(spark, ids):
    texts = {i: f"text of {i} é has some words {i} more" for i in ids}
    check(sketches.compare_with_edit(documents(spark, texts)).collect(), texts, 1e-9)


def test_many_groups_of_ids(spark):
    rng = random.Random(2)
    texts = {i: f"{i} " * rng.randint(0, 9) for i in rng.sample(range(400_000), 1500)}
    check(sketches.compare_with_edit(documents(spark, texts).repartition(7)).collect(), texts, 1e-9)


def test_estimates_of_long_texts(spark):
    rng = random.Random(3)
    base = [f"w{rng.randrange(50_000)}" for _ in range(4000)]
    texts = {}
    for i in range(12):
        own = list(base)
        own[: i * 300] = [f"x{i}.{k}" for k in range(i * 300)]
        texts[i] = " ".join(own)
    sketched = documents(spark, texts).select("doc_id", sketches.sketch(F.col("text")).alias("s"))
    first = sketched.where("doc_id = 0").select(F.col("s").alias("t"))
    both = sketched.crossJoin(first).select(
        "doc_id",
        sketches.resemblance(F.col("s"), F.col("t")).alias("j"),
        sketches.containment(F.col("s"), F.col("t")).alias("c"),
        sketches.distinct_shingles(F.col("s")).alias("n"),
    )
    sets = {i: shingles(t) for i, t in texts.items()}
    for r in both.collect():
        own = sets[r["doc_id"]]
        assert abs(r["j"] - likeness(own, sets[0])) < 0.16
        assert abs(r["c"] - len(own & sets[0]) / len(own)) < 0.25
        assert abs(r["n"] / len(own) - 1) < 0.35


def test_parts_merge_to_the_whole(spark):
    rng = random.Random(4)
    parts = [(k % 2, " ".join(f"w{rng.randrange(500)}" for _ in range(90))) for k in range(40)]
    df = spark.createDataFrame(parts, "k int, text string").withColumn("sketch", sketches.sketch(F.col("text")))
    merged = {r["k"]: r["sketch"] for r in sketches.merge_all(df, ["k"]).collect()}
    hashes = df.select("k", F.explode(sketches.shingle_hashes(F.col("text"))).alias("h")).distinct().collect()
    for k in (0, 1):
        assert merged[k] == sorted(r["h"] for r in hashes if r["k"] == k)[:128]
    pair = df.limit(2).agg(F.collect_list("sketch").alias("s")).select(sketches.merge(F.col("s")[0], F.col("s")[1]).alias("m"))
    two = df.limit(2).select(F.explode("sketch").alias("h")).distinct().orderBy("h").limit(128)
    assert pair.first()["m"] == [r["h"] for r in two.collect()]


def test_odd_rows(spark):
    odd = odd_documents(spark)
    rows = sketches.compare_with_edit(odd).collect()
    assert len(rows) == 10
    twins = [r for r in rows if r["doc_id"] == 1]
    assert len(twins) == 2 and twins[0]["fingerprint"] == twins[1]["fingerprint"]
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["n_chars"] == 0 and by_id[2]["fingerprint"] == "" and by_id[2]["near_next"] == 1.0
    assert by_id[5]["near_next"] == 1.0 and by_id[5]["fingerprint"] == by_id[6]["fingerprint"]
    lone = [r for r in rows if r["doc_id"] is None]
    assert {(r["n_chars"], r["near_next"]) for r in lone} == {(10, 1.0), (0, 1.0)}


def test_empty_table(spark):
    out = sketches.compare_with_edit(documents(spark, {}))
    assert out.count() == 0 and "edited_sha256" in out.columns
    assert sketches.compare_with_edit(odd_documents(spark).where("doc_id is null")).count() == 2


def test_query(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}
    check(queries.op4_document_fingerprints(spark, sf_dir).collect(), texts, 0.2)


def test_plan_is_native(spark, sf_dir):
    plan = queries.op4_document_fingerprints(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "SinglePartition" not in plan
