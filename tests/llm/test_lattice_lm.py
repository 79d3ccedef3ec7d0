"""LM scoring (5): the lattice against all segmentations, the base against plain counting."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from growthledger.llm import lattice_lm, registry
from growthledger.llm.lattice_lm import Lattice, lm_scores, start_weights

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def segmentations(word, pieces):
    if not word:
        yield []
    for k in range(1, len(word) + 1):
        if word[:k] in pieces:
            for rest in segmentations(word[k:], pieces):
                yield [word[:k], *rest]


@pytest.fixture(scope="module")
def toy():
    rng = random.Random(2)
    pieces = [b" ", b" a", b" ab", b"a", b"b", b"ab", b"ba", b"bab", b"c"]
    weights = np.array([rng.random() for _ in pieces])
    return Lattice(pieces, np.log(weights / weights.sum()), -1.0)


def test_forward_sums_all_segmentations(toy):
    weight = dict(zip(toy.pieces, np.exp(toy.log_weight), strict=True))
    words = [b"a", b"ab", b"babab", b"cab", b"abbabc", b""]
    want = [sum(math.prod(weight[p] for p in s) for s in segmentations(b" " + w, weight)) for w in words]
    assert np.allclose(toy.log10(words), np.log10(want))
    assert np.allclose([toy._long(b" " + w) / math.log(10) for w in words], np.log10(want))


def test_expected_pieces_over_all_segmentations(toy):
    weight = dict(zip(toy.pieces, np.exp(toy.log_weight), strict=True))
    words, counts = [b"ab", b"babab", b"ab"], np.array([3, 2, 1])
    want = Counter()
    for word, n in zip(words, counts, strict=True):
        every = list(segmentations(b" " + word, weight))
        mass = [math.prod(weight[p] for p in s) for s in every]
        for s, m in zip(every, mass, strict=True):
            for p in s:
                want[p] += n * m / sum(mass)
    assert np.allclose(toy.expected(words, counts), [want[p] for p in toy.pieces])


def test_long_words_go_both_ways():
    start = start_weights(MODEL)
    lattice = Lattice(list(start), np.log(np.array(list(start.values()))), -1.0)
    word = ("thé token " * 24).replace(" ", "").encode()
    assert len(word) < lattice_lm.LONG
    assert lattice.log10([word])[0] == pytest.approx(lattice._long(b" " + word) / math.log(10))
    assert np.isfinite(lattice.log10([b"x" * 100_000])[0])


def plain(rows):
    """(id, held_out, n_tokens, n_known, train_tokens, base_score) by counting words."""
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for i, t in rows]
    fold = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for (_, words), out in zip(split, fold, strict=True) if not out for w in [*words, None])
    n, v = counts.total(), len(counts)
    return [
        (i, out, len(words) + 1, sum(counts[w] > 0 for w in [*words, None]), n,
         sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*words, None]))
        for (i, words), out in zip(split, fold, strict=True)
    ]


@pytest.mark.parametrize("head", [1 << 20, 20])
def test_base_equals_plain_counting(spark, monkeypatch, head):
    monkeypatch.setattr(lattice_lm, "HEAD_WORDS", head)
    monkeypatch.setattr(lattice_lm, "PARTIAL", 50)
    monkeypatch.setattr(lattice_lm, "MEMORY", 30)
    monkeypatch.setattr(lattice_lm, "ROUNDS", 1)
    rng = random.Random(1)
    vocabulary = ["The", "the", "É", "é", "ab c", "x" * 300, *[f"w{k}" for k in range(300)]]
    rows = [(i, rng.choice(["\n", " ", "\t "]).join(rng.choices(vocabulary, [1 / (k + 1) for k in range(306)], k=rng.randint(0, 80)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \n"), (None, "no id"), (None, "no id"), (3, rows[3][1]), (203, "w1 " * 50_000)]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, n int, word string")
    found = lm_scores(df.repartition(3), MODEL)
    assert found.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got, want = sorted(map(tuple, found.collect()), key=str), sorted(plain(rows), key=str)
    got.sort(key=lambda r: (str(r[0]), r[2]))
    want.sort(key=lambda r: (str(r[0]), r[2]))
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-12)


def test_held_out_texts_are_likelier_than_by_bytes_or_unfitted(spark):
    """The base isn't a distribution over texts (each unseen word has the whole unseen share), so no measure."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = registry.QUERIES["op5_lattice_lm"](spark, "/root/testdata/sf0.01").toPandas()
    assert len(found) == docs.count() and np.isfinite(found["score"]).all()
    held = found[found["held_out"]]
    rows = [(r.doc_id, b" ".join(lattice_lm.words_of(r.text)) + b" ") for r in docs.collect()]
    out = set(held["doc_id"])
    bytes_of = [np.bincount(np.frombuffer(b"".join(t for i, t in rows if (i in out) == side), np.uint8), minlength=256) for side in (False, True)]
    by_bytes = (bytes_of[1] * np.log10((bytes_of[0] + 1) / (bytes_of[0].sum() + 256))).sum()
    start = start_weights(MODEL)
    unfitted = Lattice(list(start), np.log(np.array(list(start.values()))), -5.0)
    counts = Counter(w for i, t in rows if i in out for w in t.split())
    before = (unfitted.log10(list(counts)) * np.array(list(counts.values()))).sum()
    assert held["score"].sum() > 0.75 * by_bytes
    assert held["score"].sum() > 0.75 * before


def test_empty_table_and_only_held_out_rows(spark):
    df = spark.createDataFrame([(i, "a b") for i in range(60)], "doc_id long, text string")
    assert lm_scores(df.limit(0), MODEL).count() == 0
    rows = lm_scores(df.where(lattice_lm.held_out("doc_id")), MODEL).collect()
    assert rows and all(r.train_tokens == r.n_known == 0 and r.base_score == 0 and r.score < 0 for r in rows)
