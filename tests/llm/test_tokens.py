"""Token counts and BPE against the libraries whose files they read."""

from __future__ import annotations

import hashlib
import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from helpers import documents, odd_documents
from revaudit.llm import bpe, merging, queries, rounds

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")

LETTERS = [
    *"abcdefgh   \n\t\r.,!'0123456789<s>_-", "▁", "ß", "日", "本", "\x00", "\x1c", " ", " ",
    " ", "　", "\x85", "    ", "the", "ing", "\U0001f600", "é", "ABC", "Σ", "İ", "ſ", "K",
    "<|endoftext|>", "<|startoftext|>", "'s", "'LL", "’", "Ⅷ", "½", "²", "한", "Ǆ", "µ",
    "ﬁ", "א", "\U0001d400", "٣", "\u0000" "7",
]


def strange_texts(seed: int, count: int) -> list[str]:
    rng = random.Random(seed)
    own = ["".join(rng.choices(LETTERS, k=rng.randint(0, 120))) for _ in range(count)]
    return [*own, "a" * 700, "ab" * 2000, " " * 100, "▁" * 33, "<s></s><unk><0x0A>", "\n\n", "日" * 300, "<|endoftext|>"]


@pytest.fixture(scope="module")
def strange(spark):
    return dict(enumerate(strange_texts(1, 600)))


def test_counts_equal_library(spark, strange):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = merging.token_counts(documents(spark, strange), PIECES, most=50).collect()
    assert len(rows) == len(strange)
    for r in rows:
        text = strange[r["doc_id"]]
        n = len(library.encode(text))
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(text.encode()), n > 50), repr(text)


def one_at_a_time(symbols: list[int], rows: list[tuple[int, int, int, int]]) -> list[int]:
    """The leftmost pair of the lowest rank merges until there is none."""
    table = {(a, b): (rank, product) for a, b, rank, product in rows}
    symbols = list(symbols)
    while True:
        found = [(*table[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in table]
        if not found:
            return symbols
        _, product, i = min(found, key=lambda x: (x[0], x[2]))
        symbols[i : i + 2] = [product]


@pytest.mark.parametrize("seed", range(60))
def test_rounds_equal_one_merge_at_a_time(seed, monkeypatch):
    """Tables in any order: products may be in pairs of lower or equal rank, or made in several ways."""
    rng = random.Random(seed)
    names = ["a", "b", "c"]
    rows: dict[tuple[int, int], tuple[int, int, int, int]] = {}
    for _ in range(rng.randint(0, 25)):
        a, b = rng.randrange(len(names)), rng.randrange(len(names))
        if len(names[a] + names[b]) > 6:
            continue
        if names[a] + names[b] not in names:
            names.append(names[a] + names[b])
        rows[a, b] = (a, b, rng.randrange(12), names.index(names[a] + names[b]))
    begin, end = (np.array([names.index(n[k]) for n in names]) for k in (0, -1))
    pairs = rounds.pair_table(len(names), list(rows.values()), begin, end)
    monkeypatch.setattr(rounds, "_BLOCK", 50)
    words = [[rng.choice([0, 0, 1, 2, -1]) for _ in range(rng.choice([1, 2, 7, 40, 200]))] for _ in range(30)]
    left, counts = rounds.merge(np.array(sum(words, [])), np.array([len(w) for w in words]), pairs)
    want = [one_at_a_time(w, list(rows.values())) for w in words]
    assert counts.tolist() == [len(w) for w in want] and left.tolist() == sum(want, [])


def test_texts_without_blanks_equal_libraries(spark):
    rng = random.Random(5)
    han = [chr(c) for c in range(0x4E00, 0x9FA0)]
    texts = {
        1: "".join(rng.choices("etaoinshrdlu", k=20_000)),
        2: "".join(rng.choices(han[:400], k=8_000)),
        3: "".join(rng.choices(han, k=8_000)) + "。" * 999,
        4: "the" * 9_000 + "x" * 20_001,
        5: "".join(rng.choices("ABCDEFabcdef+/", k=20_000)),
        6: "<|endoftext|>".join(["ab" * 400] * 5),
    }
    pieces, library = sentencepiece.SentencePieceProcessor(model_file=PIECES), Tokenizer.from_file(WORDS)
    counted = {r["doc_id"]: r["n_tokens"] for r in merging.token_counts(documents(spark, texts), PIECES).collect()}
    assert counted == {i: len(pieces.encode(t)) for i, t in texts.items()}
    for r in bpe.encode(documents(spark, texts), WORDS).collect():
        assert r["ids"] == library.encode(texts[r["doc_id"]], add_special_tokens=False).ids


def test_ids_equal_library(spark, strange):
    library = Tokenizer.from_file(WORDS)
    rows = bpe.encode(documents(spark, strange), WORDS, decoded=True).collect()
    assert len(rows) == len(strange)
    for r in rows:
        ids = library.encode(strange[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == ids, repr(strange[r["doc_id"]])
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_a_large_batch_is_encoded_in_little_memory():
    """Eight MB of texts in one batch, as a worker gets them: what it holds doesn't grow with the batch."""
    text = "".join(random.Random(6).choices(["the ", "cat's ", "über ", "12 ", "<|endoftext|> ", "lights "], k=1_000))
    batch = pa.RecordBatch.from_pydict({"doc_id": range(1600), "text": [text + str(i) for i in range(1600)]})
    shared = SimpleNamespace(value=bpe.read_tokenizer(WORDS))
    library = Tokenizer.from_file(WORDS)
    rows = 0
    tracemalloc.start()
    for made in bpe._encode_batches(shared, True)(iter([batch])):
        for i in (0, made.num_rows - 1):
            ids = library.encode(text + str(rows + i), add_special_tokens=False).ids
            assert made.column("doc_id")[i].as_py() == rows + i and made.column("ids")[i].as_py() == ids
            assert made.column("decoded")[i].as_py() == library.decode(ids, skip_special_tokens=False)
        rows += made.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 1600 and peak < 64 << 20


def test_decode_is_what_encode_decodes(spark, strange):
    both = bpe.encode(documents(spark, strange), WORDS, decoded=True)
    again = bpe.decode(both, WORDS).withColumnRenamed("decoded", "again")
    assert both.join(again, "doc_id").where("decoded <> again").count() == 0
    none = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in bpe.decode(none, WORDS).collect()] == ["", ""]


def test_plain_texts_round_trip(spark):
    texts = {1: "hello world 12", 2: "grüße an alle"}
    rows = bpe.encode(documents(spark, texts), WORDS, decoded=True).collect()
    end = "</w>"
    letters = bpe.byte_letters()
    for r in rows:
        spelled = r["decoded"].replace(end + " ", "\n").replace(end, "").replace(" ", "").replace("\n", " ")
        back = {c: b for b, c in letters.items()}
        text = " ".join(bytes(back[c] for c in w).decode() for w in spelled.split(" "))
        assert text == texts[r["doc_id"]].replace("12", "1 2")


def test_odd_rows_and_empty_tables(spark):
    odd = odd_documents(spark)
    counts = merging.token_counts(odd, PIECES)
    assert counts.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and counts.count() == 10
    by_id = {r["doc_id"]: r for r in counts.collect()}
    assert (by_id[2]["n_tokens"], by_id[2]["n_bytes"], by_id[3]["n_tokens"]) == (0, 0, 0)
    assert by_id[5]["over_limit"] is True and by_id[1]["over_limit"] is False
    ids = {r["doc_id"]: r for r in bpe.encode(odd, WORDS, decoded=True).collect()}
    assert ids[2]["ids"] == ids[3]["ids"] == ids[4]["ids"] == [] and ids[2]["decoded"] == ""
    library = Tokenizer.from_file(WORDS)
    assert ids[7]["ids"] == library.encode("x" * 20_000, add_special_tokens=False).ids
    assert merging.token_counts(documents(spark, {}), PIECES).count() == 0
    assert bpe.encode(documents(spark, {}), WORDS).count() == 0


def test_queries_equal_libraries(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    pieces = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    counted = {r["doc_id"]: r["n_tokens"] for r in queries.op5_token_counts(spark, sf_dir).collect()}
    assert counted == {i: len(pieces.encode(t)) for i, t in texts.items()}
    library = Tokenizer.from_file(WORDS)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    rows = queries.op6_bpe_round_trip(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), digest(" ".join(map(str, ids))), digest(decoded),
        )


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
