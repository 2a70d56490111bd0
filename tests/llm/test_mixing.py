from __future__ import annotations

import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from helpers import documents, odd_documents, words
from revaudit.llm import mixing, queries


def sources(spark, sizes: dict[str | None, list[int]]):
    rows, i = [], 0
    for source, own in sizes.items():
        for n in own:
            rows.append((i, " ".join(["w"] * n), "en", source, 2 * n))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def targets(sizes: dict[str | None, int]) -> dict[str | None, float]:
    """Reshare the excess again and again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, done = sum(sizes.values()), {}
    while True:
        rest = total - sum(done.values())
        free = {s: w for s, w in weight.items() if s not in done}
        share = {s: rest * w / sum(free.values()) for s, w in free.items()}
        over = {s: 3.0 * sizes[s] for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return done | share
        done |= over


def test_targets_stop_at_three_times_the_source(spark):
    sizes = {"a": [10] * 50, "b": [1], "c": [2, 3], "d": [4] * 30, "é": [5], None: [7] * 3, "z": [0]}
    out = mixing.mix(sources(spark, sizes)).select("source", "source_size", "target").distinct().collect()
    expected = targets({s: sum(n) for s, n in sizes.items()})
    assert {r["source"] for r in out} == set(sizes)
    for r in out:
        assert r["source_size"] == sum(sizes[r["source"]])
        assert math.isclose(r["target"], expected[r["source"]], abs_tol=1e-9)


def test_taken_words_come_near_targets_and_reruns_agree(spark):
    docs = sources(spark, {f"s{k}": [1 + (i * 7 + k) % 40 for i in range(300 + 500 * (k == 0))] for k in range(7)})
    runs = [mixing.mix(docs.repartition(n)) for n in (2, 5)]
    one, two = ({r["doc_id"]: r["places"] for r in m.select("doc_id", "places").collect()} for m in runs)
    assert one == two and max(map(len, one.values())) <= 3
    per = defaultdict(int)
    rows = runs[0].select("source", "target", "text", "places").collect()
    for r in rows:
        per[r["source"], r["target"]] += len(words(r["text"])) * len(r["places"])
    for (_, target), words_taken in per.items():
        assert target - 41 <= words_taken <= target


@pytest.mark.parametrize("few, broadcast", [(10_000, 100_000), (20, 1)])
def test_partial_pass_takes_all_that_still_fits(spark, monkeypatch, few, broadcast):
    monkeypatch.setattr(mixing, "FEW_LEFT", few)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", broadcast)
    sizes = {"a": [900, 700] + [1 + i % 60 for i in range(80)], "b": [400] * 5 + [7] * 60, None: [300, 0, 0, 9, 8, 200, 5], "c": [5000]}
    docs = sources(spark, sizes)
    docs = docs.union(docs.where("doc_id % 9 = 0").withColumn("text", F.lit("one two")))  # ids that repeat, with other texts
    rows = mixing.mix(docs.withColumn("draw", mixing.draw(F.col("doc_id"), 7))).collect()
    groups = defaultdict(list)
    for r in rows:
        groups[r["source"], r["draw"]].append(r)
    left = {r["source"]: r["target"] % r["source_size"] for r in rows}
    for source, at in sorted(groups, key=lambda k: k[1]):
        own = groups[source, at]
        n = sum(len(words(r["text"])) for r in own)
        fits = 0 < n <= left[source]
        left[source] -= n * fits
        copies = int(own[0]["target"] // own[0]["source_size"]) + fits
        assert [len(r["places"]) for r in own] == [copies] * len(own)
    shards = {p["shard"] for r in rows for p in r["places"]}
    assert shards <= set(range(16))


def test_mix_comes_near_targets(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    size = mixing.word_count(F.col("text")) * F.size("places")
    rows = mixing.mix(docs).groupBy("source", "target").agg(F.sum(size).alias("n")).collect()
    shares = [r["n"] / r["target"] for r in rows]
    assert max(shares) <= 1 and min(shares) > 0.9


def test_no_document_is_taken_more_than_three_times(spark):
    """Documents without words in a source at its limit of three passes."""
    docs = sources(spark, {"small": [0] * 40 + [3], "large": [50] * 60, "other": [40] * 60})
    copies = {r["doc_id"]: len(r["places"]) for r in mixing.mix(docs).collect()}
    assert copies[40] == 3 and set(copies[i] for i in range(40)) == {3}


def test_shards_hold_exact_quotas_and_disjoint_blocks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "DOCS_PER_BLOCK", 4)
    docs = sources(spark, {"a": [5] * 400, "b": [3] * 200, "c": [2] * 300})
    plan, _ = mixing.plan_mix(docs, shards=8)
    rows = plan.collect()
    per_shard = [sum(r["offsets"][k + 1] - r["offsets"][k] for r in rows) for k in range(8)]
    total = sum(r["offsets"][-1] for r in rows)
    assert sum(per_shard) == total and max(per_shard) - min(per_shard) <= 3
    for r in rows:
        assert r["offsets"] == sorted(r["offsets"]) and r["offsets"][0] == 0
    placed = mixing.taken(mixing.mix(docs, shards=8)).collect()
    blocks = defaultdict(set)
    mixed = mixing.mix(docs, shards=8).join(plan.select("source", "blocks"), "source")
    for r in mixed.select("source", "places", mixing.block(mixing.draw(F.col("doc_id"), 7), F.col("blocks")).alias("b")).collect():
        for p in r["places"]:
            blocks[r["source"], p["pass"], r["b"]].add(p["shard"])
    assert all(len(s) == 1 for s in blocks.values())  # a block draw is in one shard
    assert len({r["shard"] for r in placed}) == 8


def test_hypergeometric_is_exact(spark):
    total, good, take, n = 60, 22, 17, 4000
    u = (F.col("id") + 0.5) / n
    c = lambda v: F.lit(v).cast("long")
    rows = spark.range(n).select(mixing.hypergeometric(u, c(total), c(good), c(take)).alias("k")).groupBy("k").count().collect()
    found = {r["k"]: r["count"] / n for r in rows}
    for k in range(take + 1):
        p = math.comb(good, k) * math.comb(total - good, take - k) / math.comb(total, take)
        assert abs(found.get(k, 0) - p) < 2 / n
    edge = spark.range(1).select(
        mixing.hypergeometric(F.lit(0.99), c(10), c(10), c(4)).alias("all"),
        mixing.hypergeometric(F.lit(0.01), c(10), c(0), c(4)).alias("none"),
        mixing.hypergeometric(F.lit(0.5), c(2_000_000), c(1_000_000), c(1000)).alias("half"),
    ).first()
    assert (edge["all"], edge["none"]) == (4, 0) and abs(edge["half"] - 500) <= 1


@pytest.mark.parametrize("strata", [2, 4096])
def test_shared_strata_change_only_places(spark, monkeypatch, strata):
    monkeypatch.setattr(mixing, "STRATA", strata)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 3 if strata == 2 else 100_000)
    docs = sources(spark, {f"s{k}": [3] * 40 for k in range(9)})
    mixed = mixing.mix(docs, shards=4).collect()
    assert len(mixed) == 360
    assert Counter(len(r["places"]) for r in mixed) == Counter(
        len(r["places"]) for r in mixing.mix(docs, shards=1).collect()
    )


def test_odd_rows(spark):
    odd = odd_documents(spark).withColumns({c: F.lit(c) for c in ("_plan", "_draw", "_source", "__source", "_twin", "_size", "target")})
    out = mixing.mix(odd)
    assert out.columns == [*odd.columns[:-1], "source_size", "target", "places"]
    assert out.select("_plan", "_draw", "_source", "__source", "_twin", "_size").distinct().count() == 1
    rows = out.collect()
    assert len(rows) == 10
    assert all(len(r["places"]) <= 3 for r in rows)
    twins = [Counter(p["pass"] for p in r["places"]) for r in rows if r["doc_id"] == 1]
    assert twins[0] == twins[1]


def test_empty_and_wordless_tables(spark, tmp_path):
    assert mixing.mix(documents(spark, {})).count() == 0
    blank = mixing.mix(documents(spark, {1: "", 2: None})).collect()
    assert [(r["source_size"], r["target"], r["places"]) for r in blank] == [(0, 0.0, [])] * 2


def test_write_shards(spark, tmp_path):
    docs = sources(spark, {"a": [5] * 90, "b": [3] * 60})
    mixed = mixing.mix(docs, shards=3)
    mixing.write_shards(mixed, str(tmp_path / "mix"))
    back = spark.read.parquet(str(tmp_path / "mix"))
    assert back.count() == sum(len(r["places"]) for r in mixed.collect())
    assert back.select("shard").distinct().count() == 3


def test_query_equals_sql(spark, sf_dir):
    sql = queries.oracle_sql()["op7_source_mixing"]
    found = differences(queries.op7_source_mixing(spark, sf_dir), connect(sf_dir), sql)
    assert not found, "\n".join(found)
