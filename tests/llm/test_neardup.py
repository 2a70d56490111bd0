from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import connect, differences
from helpers import documents, odd_documents, random_texts, words
from revaudit.llm import neardup, queries
from revaudit.llm.components import components
from revaudit.llm.words import mixed


def shingles(text: str | None, n: int = 5) -> Counter:
    own = words(text)
    if not own:
        return Counter()
    return Counter(tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1)))


def similarity(a: Counter, b: Counter) -> float:
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def brute(texts: dict[int, str | None], n: int = 5) -> dict[int, int]:
    bags = {i: shingles(t, n) for i, t in texts.items()}
    label = {i: i for i in texts}

    def find(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    for i in sorted(texts):
        for j in sorted(texts):
            same = words(texts[i]) == words(texts[j])
            if i < j and (same or (bags[i] and bags[j] and similarity(bags[i], bags[j]) >= 0.8)):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    return {i: find(i) for i in texts}


def got(df) -> dict[int, int]:
    return {r["doc_id"]: r["class_id"] for r in df.collect()}


def test_signature_is_unbiased():
    rng = random.Random(3)
    for _ in range(5):
        a = {i + 1: rng.randint(1, 9) for i in range(12)}
        b = {k: max(1, v + rng.randint(-3, 3)) for k, v in a.items() if rng.random() < 0.8}
        one, two = (
            neardup.bag_min_hash(
                np.zeros(len(x), np.int64), mixed(np.array(list(x), np.uint64)), np.array(list(x.values())), 1, 20_000
            )[0]
            for x in (a, b)
        )
        assert abs((one == two).mean() - similarity(Counter(a), Counter(b))) < 0.02


def test_signature_of_heavy_and_of_no_shingles():
    none = neardup.bag_min_hash(*(np.zeros(0, np.int64),) * 3, 2, 8)
    assert (none == np.uint64(0xFFFFFFFFFFFFFFFF)).all() and none.shape == (2, 8)
    heavy = neardup.bag_min_hash(np.zeros(1, np.int64), np.ones(1, np.uint64), np.array([1_000_000]), 1, 64)
    assert (heavy < np.uint64(0xFFFFFFFFFFFFFFFF)).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    texts = dict(enumerate(random_texts(seed, 150)))
    assert got(neardup.classes(documents(spark, texts))) == brute(texts)


def test_short_texts_and_copies(spark):
    texts = {1: "a b", 2: "a  b", 3: "b a", 4: None, 5: "", 6: " ", 7: "a", 8: "a b c d e", 9: "a b c d e f"}
    assert got(neardup.classes(documents(spark, texts))) == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 4, 7: 7, 8: 8, 9: 9}


def family(seed: int, size: int, edits: int, length: int = 200) -> list[str]:
    """Texts that all differ from one base in a few words."""
    rng = random.Random(seed)
    base = [f"{seed}w{rng.randrange(10_000)}" for _ in range(length)]
    out = []
    for i in range(size):
        own = list(base)
        for k in range(edits):
            own[rng.randrange(length)] = f"e{seed}.{i}.{k}"
        out.append(" ".join(own))
    return out


def test_large_group_of_different_copies(spark, monkeypatch):
    """No leader is close to all; with `exact` classes must still be those of all pairs."""
    monkeypatch.setattr(neardup, "FEW", 3)
    monkeypatch.setattr(neardup, "LEADER_PARTNERS", 16)
    texts = dict(enumerate(family(1, 120, 3) + family(2, 60, 5) + family(3, 40, 1)))
    assert got(neardup.classes(documents(spark, texts), exact=True)) == brute(texts)


def test_no_link_is_lost_in_a_bucket_of_many_classes(spark, monkeypatch):
    """Buckets that were cut lost links of entries outside their largest class."""
    monkeypatch.setattr(neardup, "FEW", 1)
    monkeypatch.setattr(neardup, "DEPTH", 1)
    texts = dict(enumerate(family(1, 120, 3) + family(2, 60, 5) + family(3, 40, 1)))
    docs, expected = documents(spark, texts), brute(texts)
    assert got(neardup.classes(docs, exact=False)) != expected
    assert got(neardup.classes(docs)) == expected


def test_kept_documents_are_those_of_all_links(spark, monkeypatch):
    monkeypatch.setattr(neardup, "FEW", 1)
    monkeypatch.setattr(neardup, "DEPTH", 1)
    texts = dict(enumerate(family(1, 60, 3) + family(2, 60, 5) + family(3, 40, 1)))
    kept = neardup.keep_one(documents(spark, texts)).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(brute(texts).values()))


def test_no_link_is_lost_among_repeated_shingles(spark):
    """Shingles that occur several times in a text, few different ones, texts of very different lengths."""
    rng, texts = random.Random(9), {}
    for i in range(120):
        own = [f"r{k % 7}" for k in range(rng.choice([20, 40, 43, 47, 90]))]
        for _ in range(rng.randint(0, 2)):
            own[rng.randrange(len(own))] = f"s{rng.randrange(5)}"
        texts[i] = " ".join(own)
    bags = {i: shingles(t) for i, t in texts.items()}
    found = got(neardup.classes(documents(spark, texts)))
    near = [(i, j) for i in texts for j in texts if i < j and similarity(bags[i], bags[j]) >= 0.8]
    assert len(near) > 500 and all(found[i] == found[j] for i, j in near)


def edited(seed: int, size: int, length: int = 150) -> list[str]:
    """Copies of one text or of an earlier copy with one to four words changed: a tree of edits, mostly below 0.8 of each other."""
    rng = random.Random(seed)
    out = [[f"b{k}" for k in range(length)]]
    while len(out) < size:
        own = list(out[min(rng.randrange(len(out)), rng.randrange(40))])
        for _ in range(rng.randint(1, 4)):
            own[rng.randrange(length)] = f"e{rng.randrange(10**9)}"
        out.append(own)
    return [" ".join(w) for w in out]


def test_comparisons_grow_with_the_group_and_links_are_found(spark, monkeypatch):
    counted, settle = [], neardup.settle

    def counting(df, label):
        out = settle(df, label)
        if label == "neardup-pairs":
            counted[-1] += out.count()
        return out

    monkeypatch.setattr(neardup, "settle", counting)
    for size in (500, 2000):
        counted.append(0)
        texts = edited(7, size)
        found = got(neardup.classes(documents(spark, dict(enumerate(texts))).repartition(8)))
        bags = [shingles(t) for t in texts]
        shared = [s for s, n in Counter(s for b in bags for s in b).items() if n > 1]
        place = {s: i for i, s in enumerate(shared)}
        held = np.zeros((size, len(shared)), np.float32)
        for i, b in enumerate(bags):
            held[i, [place[s] for s in b if s in place]] = 1
        common, weight = held @ held.T, np.array([sum(b.values()) for b in bags])
        linked = np.triu(common / (weight[:, None] + weight[None] - common) >= 0.8, 1)
        label = np.array([found[i] for i in range(size)])
        recall = (label[:, None] == label[None])[linked].mean()
        print(size, "links", linked.sum(), "recall", recall, "compared", counted[-1])
        assert recall >= 0.99 and linked.sum() > 4 * size
    assert counted[1] <= 6 * counted[0] and counted[1] < 60 * 2000


def group(seed: int, size: int, length: int = 150) -> list[str]:
    """Copies of one text with one to nine words replaced, some with words left out or added: many are in no link."""
    rng = random.Random(seed)
    out = []
    for i in range(size):
        own = [f"b{k}" for k in range(length)]
        for k in range(rng.randint(1, 9)):
            own[rng.randrange(len(own))] = f"e{i}.{k}"
        for k in range(rng.choice([0, 0, 3, 9])):
            own.append(f"a{i}.{k}") if rng.random() < 0.5 else own.pop(rng.randrange(len(own)))
        out.append(" ".join(own))
    return out


def test_rows_out_of_reach_do_not_meet(spark, monkeypatch):
    """In a large group all rows of a shingle met before; few of them are in reach, and classes are still those of all pairs."""
    counts, roles = [], neardup._roles

    def counting(ranked, threshold):
        light, heavy = roles(ranked, threshold)
        other = ranked.select("shingle", F.col("entry").alias("b"), F.col("label").alias("label_b"), F.col("asks").alias("asks_b"))
        once = ~F.col("asks_b") | (F.col("entry") < F.col("b"))
        before = ranked.where("asks").join(other, "shingle").where((F.col("label") != F.col("label_b")) & once)
        counts.append((before.count(), light.join(heavy, neardup.ROLE_KEYS).count()))
        return light, heavy

    monkeypatch.setattr(neardup, "_roles", counting)
    texts = dict(enumerate(group(11, 400)))
    found = got(neardup.classes(documents(spark, texts).repartition(8)))
    assert found == brute(texts) and len(set(found.values())) > 40
    ((before, met),) = counts
    print("rows that met before", before, "now", met)
    assert 0 < met < 10 * 400 < 40 * 400 < before


@pytest.mark.parametrize("threshold", [0.5, 0.8])
def test_no_similar_pair_is_out_of_reach(spark, threshold):
    """Each entry is its own class, so that all similar pairs have to be found."""
    rng = random.Random(3)
    texts = group(5, 30) + edited(6, 50) + [" ".join(f"r{rng.randrange(3)}" for _ in range(rng.choice([9, 30]))) for _ in range(40)]
    bags = [shingles(t) for t in texts]
    rows = [(i, i, sum(b.values())) for i, b in enumerate(bags)]
    rest = spark.createDataFrame(rows, "entry long, label long, weight long")
    held = spark.createDataFrame(list(enumerate(texts)), "entry long, text string")
    pairs = {(r["a"], r["b"]) for r in neardup._shingle_pairs(rest, held, threshold, 5).collect()}
    near = {(i, j) for i in range(120) for j in range(i + 1, 120) if similarity(bags[i], bags[j]) >= threshold}
    assert len(near) > 60 and near <= pairs and len(pairs) < 120 * 119 / 2


def test_one_id_with_different_texts_is_one_document(spark):
    one, two = (" ".join(f"{c}{k}" for k in range(40)) for c in "xy")
    near = one + " more"
    rows = [(5, one), (5, two), (6, two), (7, near), (7, near), (8, two + " end"), (3, "other words here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    runs = [Counter((r["doc_id"], r["class_id"]) for r in neardup.classes(docs.repartition(k)).collect()) for k in (1, 4)]
    assert runs[0] == runs[1] and sum(runs[0].values()) == len(rows)
    assert runs[0][5, 5] == 2 and runs[0][6, 5] == 1 and runs[0][3, 3] == 1
    assert runs[0][7, 5] + runs[0][8, 5] in (1, 2, 3)  # near the one of its texts that is compared


def test_chain_is_one_class(spark):
    own, texts = [f"w{i}" for i in range(120)], {}
    for i in range(25):
        texts[i] = " ".join(own)
        own = [*own[4:], *(f"n{i}.{k}" for k in range(4))]
    assert set(got(neardup.classes(documents(spark, texts))).values()) == {0}


def test_odd_rows(spark):
    odd = odd_documents(spark)
    rows = neardup.classes(odd).collect()
    assert len(rows) == 10
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[6]["class_id"] == 5 and by_id[5]["class_size"] == 2
    assert by_id[1]["class_id"] == 1 and by_id[1]["class_size"] == 2
    assert by_id[None]["class_id"] is None
    assert [by_id[i]["class_id"] for i in (2, 3, 4)] == [2, 2, 2]
    kept = neardup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or -1 for r in kept.collect()) == [-1, -1, 1, 1, 2, 5, 7]


def test_empty_table(spark):
    assert neardup.classes(documents(spark, {})).count() == 0
    assert neardup.keep_one(documents(spark, {})).count() == 0


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 160)]
    rows = components(spark.createDataFrame(links + [(7, 7), (None, 3), links[0]], "a long, b long")).collect()
    label: dict[int, int] = {}
    for a, b in links:
        x, y = sorted((label.get(a, a), label.get(b, b)))
        label |= {n: x for n in [*label, a, b] if label.get(n, n) in (x, y)}
    assert {r["node"]: r["label"] for r in rows} == {n: m for n, m in label.items() if Counter(label.values())[m] > 1}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_equals_sql(spark, sf_dir):
    sql = queries.oracle_sql()["op3_minhash_near_dedup"]
    found = differences(queries.op3_minhash_near_dedup(spark, sf_dir), connect(sf_dir), sql)
    assert not found, "\n".join(found)
