"""The pipeline's stages take effect on what the stage before has kept."""

from __future__ import annotations

import hashlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from helpers import words
from revaudit.llm.common import table
from test_linedup import brute as without_repeats
from test_neardup import brute as classes


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs, out = table(spark, sf_dir, "documents"), {}
    out["documents"] = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, sf_dir)
        out[name] = made.collect()
        docs = spark.createDataFrame(out[name], made.schema)
    return out


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "mixing", "bpe"]


def test_toxic_documents_go_and_clean_ones_stay(spark, sf_dir, steps):
    toxic = {r["doc_id"]: r["toxic"] for r in table(spark, sf_dir, "labels").collect()}
    before, after = ({r["doc_id"] for r in steps[k]} for k in ("documents", "toxicity"))
    assert after < before
    clean = {i for i in before if toxic.get(i) == 0}
    assert len(clean & after) >= 0.98 * len(clean)
    assert {r["doc_id"]: r for r in steps["toxicity"]} == {r["doc_id"]: r for r in steps["documents"] if r["doc_id"] in after}


def test_repeats_are_cut(steps):
    texts = {r["doc_id"]: r["text"] for r in steps["toxicity"]}
    expected = without_repeats(texts, 50)
    assert {r["doc_id"]: r["text"] for r in steps["line dedup"]} == {i: t for i, (t, _) in expected.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in steps["line dedup"])


def test_one_of_each_class_stays(steps):
    label = classes({r["doc_id"]: r["text"] for r in steps["line dedup"]})
    assert sorted(r["doc_id"] for r in steps["near dedup"]) == sorted(set(label.values()))


def test_mix_and_encoding(steps):
    assert steps["near dedup"][0].__fields__ == steps["mixing"][0].__fields__ == steps["documents"][0].__fields__
    copies = Counter(r["doc_id"] for r in steps["mixing"])
    assert max(copies.values()) <= 3
    before = sum(len(words(r["text"])) for r in steps["near dedup"])
    assert abs(sum(len(words(r["text"])) for r in steps["mixing"]) / before - 1) < 0.15
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    texts = {r["doc_id"]: r["text"] for r in steps["mixing"]}
    assert Counter(r["doc_id"] for r in steps["bpe"]) == copies
    for r in steps["bpe"]:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        text = library.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_run(spark, sf_dir, steps):
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    key = lambda r: (r["doc_id"], r["n_tokens"], r["decoded_sha256"])
    assert sorted(map(key, rows)) == sorted(map(key, steps["bpe"]))
