"""Token counts (2) and byte-level BPE (7) against the public libraries."""

import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from growthledger.llm import byte_bpe, token_counts
from tokenizers import Tokenizer

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = [
    "a", "b", "the", "é", "ß", " ", "  ", "\n", "\t", "\x1c", "1", "23", "!", "?!", "'s", "'ll", "漢字", "😀",
    "\r\n", "<|endoftext|>", "٣", "½", "_", "\x85", "Ａ", "aaaa", "　",
]


def odd_texts():
    rng = random.Random(5)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25))) for _ in range(1500)]
    return [*texts, None, "", " ", "x" * 5000, "the quick brown fox " * 2000, " lead", "trail "]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "clash", 7) for i, t in enumerate(odd_texts())]
    rows += [(None, "no id", "clash", 7), (3, "same id", "clash", 7), (3, "same id", "clash", 7)]
    # n_tokens and ids are names of result columns as well
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens int").repartition(3)


def test_token_counts_equal_the_library(spark, docs):
    library = Tokenizer.from_file(JSON)
    result = token_counts.token_counts(docs, JSON)
    assert result.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = sorted(
        (
            str(r.doc_id), len((r.text or "").encode()),
            n := len(library.encode(r.text or "", add_special_tokens=False)), n > 512,
        )
        for r in docs.collect()
    )
    assert sorted((str(r[0]), *r[1:]) for r in result.collect()) == want


def test_memory_turnover_changes_nothing(monkeypatch):
    texts = [t or "" for t in odd_texts()]
    want = token_counts.MergeCounter.from_json(JSON).counts(texts)
    monkeypatch.setattr(token_counts, "MEMORY", 5)
    counter = token_counts.MergeCounter.from_json(JSON)
    assert [n for i in range(0, len(texts), 7) for n in counter.counts(texts[i : i + 7])] == want


def test_byte_bpe_equals_the_library_and_comes_back(spark, docs):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    result = byte_bpe.round_trip(docs, RANKS)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def sha(data):
        return hashlib.sha256(data).hexdigest()

    want = []
    for r in docs.collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((str(r.doc_id), len(ids), sha(" ".join(map(str, ids)).encode()), sha((r.text or "").encode())))
    assert sorted((str(r[0]), *r[1:]) for r in result.collect()) == sorted(want)


def test_offsets_and_split_characters(spark):
    docs = spark.createDataFrame([(1, "a 😀é x"), (2, None)], "doc_id long, text string")
    row, empty = sorted(byte_bpe.encode(docs, RANKS, offsets=True).collect(), key=lambda r: r.doc_id)
    data = "a 😀é x".encode()
    assert row.byte_ends[-1] == len(data) and row.char_ends[-1] == 6
    assert empty.ids == [] and empty.byte_ends == []
    starts = [0, *row.byte_ends[:-1]]
    parts = spark.createDataFrame([(i, [t]) for i, t in enumerate(row.ids)] + [(99, None)], "doc_id long, ids array<int>")
    found = {r.doc_id: bytes(r.decoded) for r in byte_bpe.decode(parts, RANKS).collect()}
    # The emoji's bytes are spread over tokens; each decodes to its own bytes.
    assert [found[i] for i in range(len(row.ids))] == [data[a:b] for a, b in zip(starts, row.byte_ends, strict=True)]
    assert found[99] == b""


def test_empty_table(spark, docs):
    none = docs.limit(0)
    assert token_counts.token_counts(none, JSON).count() == 0
    assert byte_bpe.round_trip(none, RANKS).count() == 0
