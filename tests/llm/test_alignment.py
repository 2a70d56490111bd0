from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from helpers import documents, odd_documents, random_texts
from revaudit.llm import alignment, queries
from revaudit.llm.bpe import byte_letters

A, B = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute(texts: list[str | None]) -> list[tuple]:
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(A)
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=B)
    byte = {c: b for b, c in byte_letters().items()}
    rows = []
    for text in texts:
        a = one.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = two.encode(text) if text else []
        spans = [
            [bytes(byte[c] for c in one.id_to_token(i)) for i in a],
            [
                bytes([int(two.id_to_piece(i)[3:5], 16)]) if two.is_byte(i) else two.id_to_piece(i).replace("▁", " ").encode()
                for i in b
            ],
        ]
        if any(b"".join(s) != (" " + (text or "")).encode() for s in spans):
            rows.append(([], [], []))
            continue
        ends = [list(np.cumsum([len(x) for x in s])) for s in spans]
        at = [{e: i for i, e in enumerate(own)} for own in ends]
        cuts = sorted(at[0].keys() & at[1].keys())
        links = [(a[at[0][c]], b[at[1][c]]) for c in cuts]
        written, low = [], (-1, -1)
        for c in cuts:
            high = (at[0][c], at[1][c])
            sides = [ids[i + 1 : j + 1] for ids, i, j in zip((a, b), low, high, strict=True)]
            written.append("|".join(",".join(map(str, s)) for s in sides))
            low = high
        rows.append((a, b, links, ";".join(written)))
    counts = Counter(link for r in rows for link in r[2])
    best: dict[int, int] = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (
            len(r[0]), len(r[1]), len(r[2]), len(r[2]), sum(counts[x] == best[x[1]] for x in r[2]), sum(counts[x] for x in r[2]),
            hashlib.sha256(r[3].encode()).hexdigest() if r[0] else "",
        )
        for r in rows
    ]


TEXTS = [
    None, "", " ", "  two  spaces ", "\n\nlines\t and\ttabs \r\n", "<|endoftext|> and <s> </s> <unk>", "▁ piece sign ▁▁",
    "naïve café ﬁne Ω≈ç√", "日本語のテキスト", "emoji 👩‍👩‍👧 flags 🇩🇪", "x" * 700, "á combined é", "123456789 3.14 1,000", "\x00 zero",
    *random_texts(3, 40),
]


@pytest.mark.parametrize("known", [alignment.KNOWN_PAIRS, 3])
def test_equals_brute_force(spark, known):
    docs = documents(spark, dict(enumerate(TEXTS))).repartition(5)
    rows = {r["doc_id"]: r for r in alignment.digests(docs, A, B, known).collect()}
    found = [tuple(rows[i][c] for c in COLUMNS) for i in range(len(TEXTS))]
    assert found == brute(TEXTS)


def test_query_equals_brute_force(spark, sf_dir):
    texts = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    rows = {r["doc_id"]: r for r in queries.op11_token_alignment(spark, sf_dir).collect()}
    found = [tuple(rows[r["doc_id"]][c] for c in COLUMNS) for r in texts]
    assert len(rows) == len(texts) and found == brute([r["text"] for r in texts])


def test_pointers_reach_the_last_token_of_long_chains():
    """Tokens that overlap without a common end but the last are one group."""
    rng = random.Random(1)
    for length in (1, 2, 3, 1000):
        ends_a, ends_b = np.arange(2, 2 * length + 1, 2), np.append(np.arange(1, 2 * length - 1, 2), 2 * length)
        a, b, partner = alignment.terminals(ends_a, ends_b)
        assert set(a) == set(b) == {len(ends_b) - 1} and partner[-1] == len(ends_a) - 1
    for _ in range(50):
        total = rng.randint(1, 60)
        ends = [np.array(sorted(set(rng.sample(range(1, total + 1), rng.randint(1, total))) | {total})) for _ in "ab"]
        a, b, partner = alignment.terminals(*ends)
        cuts = np.intersect1d(*ends)
        for own, groups in zip(ends, (a, b), strict=True):
            assert np.array_equal(ends[1][groups], cuts[np.searchsorted(cuts, own)])
        assert np.array_equal(ends[1][partner >= 0], cuts)


def test_odd_rows_and_empty_table(spark):
    odd = odd_documents(spark)
    out = alignment.digests(odd, A, B)
    rows = out.collect()
    assert out.columns == ["doc_id", *COLUMNS] and len(rows) == 10
    expected = Counter((r["doc_id"], *x) for r, x in zip(odd.collect(), brute([r["text"] for r in odd.collect()]), strict=True))
    assert Counter((r["doc_id"], *(r[c] for c in COLUMNS)) for r in rows) == expected
    assert alignment.digests(documents(spark, {}), A, B).count() == 0
