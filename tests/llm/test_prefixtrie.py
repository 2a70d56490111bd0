from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from revaudit.llm import prefixtrie, queries

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows: list[tuple]) -> list[tuple]:
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = sum(saved[x] for x in children[node]) + ((len(members[node]) - 1) * len(node[-1][1]) if node else 0)
    return sorted(
        (
            min(m), len(node), min(members[node[:-1]]) if node else -1, len(m), len(children[node]), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(c for c in m if rebuilt[c] == node))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def found(table) -> list[tuple]:
    out = prefixtrie.trie(table)
    assert out.columns == COLUMNS
    return sorted(tuple(-1 if v is None else v for v in r) for r in out.collect())


@pytest.mark.parametrize("seed, deepest", [(1, 3), (2, 9), (3, 40)])
def test_equals_brute_force(spark, seed, deepest):
    rng = random.Random(seed)
    rows = []
    for conv in rng.sample(range(700), 160):
        for turn in range(rng.randint(1, deepest)):
            rows.append((conv, turn * 2, rng.choice(["user", "assistant", None]), rng.choice(["a", "bb", "", None, "ççç"])))
    table = spark.createDataFrame(rng.sample(rows, len(rows)), SCHEMA).repartition(5)
    assert found(table) == brute(rows)


def test_hot_conversation_hot_turn_and_long_chains(spark):
    rows = [(0, i, "user", f"t{i % 3}") for i in range(500)]  # one conversation holds many of the rows
    rows += [(100 + c, 0, "user", "hello") for c in range(300)]  # one first turn, one whole conversation
    rows += [(1000 + c, t, "user", f"hello {t}") for c in range(40) for t in range(5 + c % 2)]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(6)) == brute(rows)


def test_many_ends_are_joined_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "PIECE_IDS", 7)
    ends = spark.range(2000).select((F.col("id") % 2).alias("x"), F.lit(5).cast("long").alias("y"), F.col("id").alias("conv_id"))
    rows = {r["x"]: r["ends_sha256"] for r in prefixtrie.end_digests(ends.repartition(7)).collect()}
    assert rows == {x: hashlib.sha256(",".join(map(str, range(x, 2000, 2))).encode()).hexdigest() for x in (0, 1)}


def test_few_frequent_parents(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "FREQUENT_PARTS", 4)
    rows = [(c, t, "user", f"{c if t > 1 else t}") for c in range(60) for t in range(4)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_odd_rows_and_empty_table(spark):
    rows = [
        (None, 1, "user", "lost"), (7, None, None, None), (7, None, "user", "b"), (7, 3, "user", "x" * 100_000), (7, 3, "user", "x" * 100_000),
        (8, -1, "", ""), (8, 0, None, None), (100, 5, "user", "z"), (100, 5, "tool", "z"), (100, 5, "tool", "a"), (303, 1, "u", "1:a"), (304, 1, "u1:", "a"),
    ]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("pos", F.lit("clash")).withColumn("x", F.lit(1.5)).withColumn("n", F.lit(None).cast("int"))
    assert found(table) == brute(rows)
    assert found(spark.createDataFrame([], SCHEMA)) == []


def test_turnless_conversations_end_at_the_root(spark):
    rows = [(c, 0, "user", "only") for c in range(1, 60)]  # the base is absent; heads of one turn or more leave nothing
    out = found(spark.createDataFrame(rows, SCHEMA))
    assert out == brute(rows) and out[0][3] == 59


def test_query_equals_sql_and_brute_force(spark, sf_dir):
    out = queries.op13_prefix_trie(spark, sf_dir)
    sql = queries.oracle_sql()["op13_prefix_trie"]
    apart = differences(out, connect(sf_dir), sql)
    assert not apart, "\n".join(apart)
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(tuple(-1 if v is None else v for v in r) for r in out.collect()) == brute(rows)
