from __future__ import annotations

import re

import pyarrow as pa
import pytest

from compare import connect, differences
from helpers import WORD, documents, odd_documents, random_texts, words
from revaudit.llm import linedup, queries
from revaudit.llm.words import gram_hashes, split_words


def brute(texts: dict[int, str], run: int) -> dict[int, tuple[str, int]]:
    """Every window in order; all words of a window that was seen before go."""
    seen, out = set(), {}
    for i in sorted(texts):
        own = words(texts[i])
        gone = [False] * len(own)
        for at in range(len(own) - run + 1):
            window = tuple(own[at : at + run])
            if window in seen:
                gone[at : at + run] = [True] * run
            seen.add(window)
        pieces = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", texts[i])
        tail = re.search(r"[\x20\x09-\x0D]*\Z", texts[i]).group()
        out[i] = ("".join(p for p, g in zip(pieces, gone, strict=True) if not g) + tail, sum(gone))
    return out


def test_words_and_grams():
    texts = ["a b  c\nd", None, "", " x ", "b c d e", "é ü\x0ba b", "y", "\x85 z"]
    got = split_words(pa.array(texts))
    cut = [bytes(got.data[s:e]).decode() for s, e in zip(got.start, got.end, strict=True)]
    assert cut == [w for t in texts for w in WORD.findall(t or "")]
    assert got.counts.tolist() == [len(WORD.findall(t or "")) for t in texts]
    by_hash = {int(h): w for h, w in zip(got.hash, cut, strict=True)}
    assert len(by_hash) == len(set(cut)) and all(by_hash[int(h)] == w for h, w in zip(got.hash, cut, strict=True))
    grams, whole = gram_hashes(got, 2)
    pairs = {(cut[i], cut[i + 1]): int(grams[i]) for i in range(len(cut)) if whole[i]}
    assert len(set(pairs.values())) == len(pairs)
    assert [bool(w) for w in whole] == [
        got.text_of[i] == got.text_of[i + 1] if i + 1 < len(cut) else False for i in range(len(cut))
    ]
    assert int(grams[1]) == int(grams[cut.index("x") + 1])  # "b c" in both texts


@pytest.mark.parametrize("run, piece, seed", [(6, 3, 1), (5, 5, 2), (8, 1, 3), (1, 1, 4)])
def test_equals_brute_force(spark, run, piece, seed):
    texts = dict(enumerate(random_texts(seed, 150, vocabulary=6 if seed == 2 else 40)))
    got = linedup.remove_repeats(documents(spark, texts), run, piece).collect()
    assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in got} == brute(texts, run)


def test_passages_inside_lines_go(spark):
    passage = " ".join(f"p{i}" for i in range(55))
    texts = {1: f"start {passage} end.", 2: f"other words\nbefore {passage}\nafter", 3: "clean text stays", 4: passage}
    got = {r["doc_id"]: r["text"] for r in linedup.remove_repeats(documents(spark, texts)).collect()}
    assert got == {1: texts[1], 2: "other words\nbefore\nafter", 3: texts[3], 4: ""}


def test_common_passage_in_many_documents(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    texts = {i: f"own{i} words{i} {passage}" for i in range(400)}
    got = linedup.remove_repeats(documents(spark, texts)).collect()
    assert sum(r["n_removed"] for r in got) == 399 * 60
    assert all(r["text"] == f"own{r['doc_id']} words{r['doc_id']}" for r in got if r["doc_id"])


def test_odd_rows(spark):
    odd = odd_documents(spark)
    out = linedup.remove_repeats(odd)
    assert out.columns == [c for c in odd.columns if c not in ("n_words",)] + ["n_words", "n_removed"]
    rows = out.collect()
    assert len(rows) == 10
    assert [r["text"] for r in rows if r["doc_id"] == 1] == ["one two three four five six"] * 2
    assert {r["text"] for r in rows if r["doc_id"] is None} == {"lost words", None}
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["text"] is None and by_id[2]["n_words"] == 0
    assert by_id[6]["text"] == "" and by_id[6]["n_removed"] == 60_000
    assert by_id[6]["copy"] is True and by_id[6]["marks"] == "y"


def test_empty_table(spark):
    out = linedup.remove_repeats(documents(spark, {}))
    assert out.count() == 0 and "n_removed" in out.columns


def test_query_equals_sql(spark, sf_dir):
    found = differences(queries.op1_line_dedup(spark, sf_dir), connect(sf_dir), queries.oracle_sql()["op1_line_dedup"])
    assert not found, "\n".join(found)
