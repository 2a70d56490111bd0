"""Quality rules, the quality classifier and toxicity: brute-force statistics and held-out accuracy."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from helpers import documents, odd_documents, random_texts, words
from revaudit.llm import quality, queries, rules, toxicity
from revaudit.llm.common import labelled_sample, table

#: Where enough documents are labelled to measure anything.
LABELLED = "/root/testdata/sf0.1"


def statistics(text: str | None) -> dict[str, int]:
    own, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    grams = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    times, covered = Counter(grams), set()
    for i, gram in enumerate(grams):
        if times[gram] > 1:
            covered |= {i, i + 1, i + 2}
    return {
        "n_words": len(own),
        "word_chars": sum(map(len, own)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_distinct": len(set(own)),
        "n_lines": len(lines),
        "n_letters": len(re.findall("[A-Za-z]", text or "")),
        "n_upper": len(re.findall("[A-Z]", text or "")),
        "n_marks": len(re.findall("[!?]", text or "")),
    }


def test_statistics_equal_brute_force(spark, sf_dir):
    texts = [r["text"] for r in table(spark, sf_dir, "documents").select("text").collect()]
    texts += [None, "", " ", "\n\n", "a\n a\na\n\na", "a a a a", "x é ü x é ü x", *random_texts(3, 200, vocabulary=5)]
    found = rules.count_text(pa.array(texts))
    for i, text in enumerate(texts):
        assert {k: int(v[i]) for k, v in found.items()} == statistics(text), repr(text)[:200]


def test_decision_list_finds_planted_rules():
    rng = np.random.default_rng(1)
    x = {k: rng.random(3000) for k in ("symbol_share", "upper_share", "word_length")}
    bad = (x["symbol_share"] > 0.8) | ((x["upper_share"] > 0.7) & (x["word_length"] < 0.4))
    learned = rules.learn(x, bad)
    assert learned and all(learned)
    hit = np.zeros(3000, bool)
    for rule in learned:
        hit |= rules._covers(rule, x)
    assert (hit == bad).mean() > 0.98
    assert rules.learn(x, np.zeros(3000, bool)) == [] == rules.learn(x, np.ones(3000, bool))[1:]
    assert rules.learn({k: v[:0] for k, v in x.items()}, bad[:0]) == []


def test_rules_emit_an_ordered_expression(spark):
    first = [rules.Condition("n_words", False, 2.0)]
    second = [rules.Condition("n_words", False, 4.0), rules.Condition("upper_share", True, 0.5)]
    rows = rules.judge(documents(spark, {1: "a b", 2: "A B C", 3: "a b c", 4: "A B C D E"}), [first, second])
    assert {r["doc_id"]: r["rule"] for r in rows.collect()} == {1: 1, 2: 2, 3: 0, 4: 0}


def test_base_rules(spark):
    enough = " ".join(f"w{i}" for i in range(50))
    texts = {1: enough, 2: " ".join(f"w{i}" for i in range(49)), 3: "a b c " * 30, 4: None}
    rows = {r["doc_id"]: r for r in rules.judge(documents(spark, texts), []).collect()}
    assert {i: (r["base_failed"], r["kept"]) for i, r in rows.items()} == {
        1: (False, True), 2: (True, False), 3: (True, False), 4: (True, False),
    }


def test_rules_on_held_out_rows(spark):
    labels = table(spark, LABELLED, "labels").where("quality is not null").select("doc_id", "quality")
    got = queries.op2_quality_rules(spark, LABELLED).join(labels, "doc_id").where("not base_failed")
    rows = got.select("doc_id", "kept", "quality").collect()
    test = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(test) > 100
    assert sum(r["kept"] == bool(r["quality"]) for r in test) / len(test) > 0.97


def _accuracy(spark, query, label):
    labels = {r["doc_id"]: r[label] for r in table(spark, LABELLED, "labels").collect()}
    rows = query(spark, LABELLED).collect()
    assert len(rows) == table(spark, LABELLED, "documents").count()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    pairs = Counter((labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels)
    return pairs


def test_quality_on_held_out_rows(spark):
    pairs = _accuracy(spark, queries.op8_quality_classifier, "quality")
    assert pairs[1, 1] / (pairs[1, 1] + pairs[1, 0]) > 0.98
    assert pairs[0, 0] / (pairs[0, 0] + pairs[0, 1]) > 0.95


def test_toxicity_on_held_out_rows(spark):
    """So few labels teach only the frequent offences; none of the clean texts may fall."""
    pairs = _accuracy(spark, queries.op9_toxicity, "toxic")
    assert pairs[0, 1] / (pairs[0, 0] + pairs[0, 1]) < 0.01
    assert pairs[1, 1] / (pairs[1, 1] + pairs[1, 0]) > 0.6


def test_noisy_or_and_sentences():
    column = pa.array(["Good one. Bad idiot here! And\nmore", None, "", "3.5 is. no", "one"])
    s = toxicity.split_sentences(column)
    cut = [column[int(t)].as_py().encode()[a:b].decode() for t, a, b in zip(s.text, s.start, s.end, strict=True)]
    assert cut == ["Good one.", "Bad idiot here!", "And", "more", "3.5 is.", "no", "one"]
    z = np.array([0.0, -1.0, 2.0])
    p = 1 / (1 + np.exp(-z))
    assert np.allclose(toxicity.noisy_or(z, np.array([0, 0, 2]), 3), [1 - (1 - p[0]) * (1 - p[1]), 0, p[2]])


def test_toxicity_finds_sentence(spark):
    clean = ["the sky is blue today.", "we went home early.", "nothing to see here."]
    rows, labels = [], []
    for i in range(200):
        text = " ".join(clean[(i + k) % 3] for k in range(4))
        rows.append((i, text + " you stupid fool." if i % 4 == 0 else text))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = toxicity.score(docs, model).collect()
    texts = dict(rows)
    assert all(r["predicted"] == int(r["doc_id"] % 4 == 0) for r in got)
    for r in got:
        spans = [texts[r["doc_id"]].encode()[s["start"] : s["end"]].decode() for s in r["offences"]]
        assert spans == (["you stupid fool."] if r["predicted"] else [])
    assert toxicity.reject(docs, model).count() == 150


@pytest.mark.parametrize("op", [rules, quality, toxicity])
def test_odd_rows_and_tables(spark, op):
    odd = odd_documents(spark)
    kind = "doc_id long, quality int, toxic int, text string"
    labels = spark.createDataFrame([(1, 1, 0, "x"), (1, 1, 0, "x"), (5, 0, 1, None), (None, 1, 1, ""), (6, None, None, "")], kind)
    apply = op.judge if op is rules else op.score
    for table_of_labels in (labels, labels.limit(0)):
        for rows in (odd, odd.limit(0)):
            out = apply(rows, op.train(rows, table_of_labels))
            assert out.count() == rows.count()
            if op is not rules:
                assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in out.collect())
    if op is toxicity:
        kept = toxicity.reject(odd, toxicity.train(odd, labels.limit(0)))
        assert kept.columns == odd.columns and kept.count() == 10


def test_sample_leaves_out_held_out_rows_and_unclear_labels(spark):
    docs = documents(spark, {i: f"text {i}" for i in range(100)})
    rows = [(i, i % 2, 0) for i in range(100)] + [(1, 0, 0)]
    sample = labelled_sample(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"), "quality", 1000)
    ids = [r["doc_id"] for r in sample.collect()]
    assert sorted(ids) == [i for i in range(100) if zlib.crc32(str(i).encode()) % 5 and i != 1]
    few = labelled_sample(docs, spark.createDataFrame(rows, "doc_id long, quality int, toxic int"), "quality", 10)
    assert sorted(r["label"] for r in few.collect()) == [0] * 5 + [1] * 5


def test_follow_the_leader_equals_dictionaries():
    """The same updates one coordinate at a time, over dictionaries."""
    rng = np.random.default_rng(3)
    examples = []
    for _ in range(40):
        places = np.sort(rng.choice(30, rng.integers(0, 8), replace=False)) * 7919 % quality.PLACES
        examples.append((places, rng.random(len(places)), int(rng.integers(2))))
    alpha, beta, l1, l2 = 0.7, 0.5, 0.01, 0.02
    model = quality.follow_the_leader(examples, passes=4, alpha=alpha, beta=beta, l1=l1, l2=l2)
    z, n = {}, {}

    def weight(i):
        held = z.get(i, 0.0)
        if abs(held) <= l1:
            return 0.0
        return -(held - (l1 if held > 0 else -l1)) / ((beta + n[i] ** 0.5) / alpha + l2)

    order = np.random.default_rng(5)
    for _ in range(4):
        for k in order.permutation(len(examples)):
            places, values, label = examples[k]
            row = {**dict(zip(places.tolist(), values.tolist())), "bias": 1.0}
            own = {i: weight(i) for i in row}
            p = 1 / (1 + np.exp(-sum(own[i] * x for i, x in row.items())))
            for i, x in row.items():
                g = (p - label) * x
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * own[i]
                n[i] = n.get(i, 0.0) + g * g
    assert np.isclose(model.bias, weight("bias"))
    want = np.zeros(quality.PLACES)
    for i in z:
        if i != "bias":
            want[i] = weight(i)
    assert np.allclose(model.weights, want) and np.count_nonzero(want) > 10


def test_noisy_or_steps_equal_finite_differences():
    """The fit's steps with gradients of the written-out loss by finite differences."""
    rng = np.random.default_rng(4)
    label, weight = np.array([1, 0, 1, 0, 0]), np.array([1.0, 2.0, 0.5, 1.0, 1.0])
    text = np.array([0, 0, 0, 1, 1, 2, 3, 3, 4])
    of = np.sort(rng.integers(0, len(text), 40))
    place = rng.integers(0, 6, 40)
    passes, rate, l1, start = 8, 0.3, 1e-3, -1.0
    model = toxicity.fit(of, place, text, label, weight, passes, rate, l1, start)

    def loss(w):
        total = 0.0
        for t in range(len(label)):
            clean = 1.0
            for s in np.flatnonzero(text == t):
                clean *= 1 - 1 / (1 + np.exp(-(w[-1] + sum(w[p] for p in place[of == s]))))
            total -= weight[t] * np.log(1 - clean if label[t] else clean)
        return total / weight.sum()

    w, past = np.append(np.zeros(6), start), np.full(7, 1e-8)
    for _ in range(passes):
        g = np.array([(loss(w + d) - loss(w - d)) / 2e-6 for d in np.eye(7) * 1e-6])
        past += g * g
        step = rate / np.sqrt(past)
        moved = w[:6] - step[:6] * g[:6]
        w = np.append(np.sign(moved) * np.maximum(abs(moved) - step[:6] * l1, 0), w[6] - 0.2 * step[6] * g[6])
    assert np.allclose(model.weights[:6], w[:6], atol=1e-5) and np.isclose(model.bias, w[6], atol=1e-5)
    assert np.count_nonzero(model.weights) == np.count_nonzero(w[:6]) > 3
