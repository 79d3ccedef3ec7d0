"""Phrase mining (11) against plain counting, and its SQL."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import TESTDATA
from oracle import compare, connect

from growthledger.llm import phrases as module
from growthledger.llm import registry
from growthledger.llm.phrases import add_up, phrases, unary_paths

SF_SMALL = f"{TESTDATA}/sf0.001"


def brute(rows, min_count, cover=50, top=2000):
    """rows: (text, lang). Every phrase is counted by itself."""
    counts = {}
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = re.findall("[^ \t]+", piece)
            mine = counts.setdefault("und" if lang is None else lang, Counter())
            mine.update(tuple(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        kept = []
        for p, a in found.items():
            if any(len(q) > len(p) and 100 * b >= cover * a and p in (q[:2], q[1:]) for q, b in found.items()):
                continue
            score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, l, r, n, -score))
    return sorted(out)


def found(spark, rows, schema="text string, lang string", **options):
    columns = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    result = phrases(spark.createDataFrame(rows, schema), **options).select(columns)
    return sorted(tuple(r) for r in result.collect())


@pytest.mark.parametrize("seed", [0, 1])
def test_equals_plain_counting(spark, seed):
    rng = random.Random(seed)
    words = ["a", "B", "ba", "é", "ça", "x y", "Ü", "z" * 300]
    rows = []
    for _ in range(200):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ". ", ",", "\n"]) for _ in range(rng.randrange(40)))
        rows.append((text, rng.choice(["en", "de", "", None, "und"])))
    rows += [(None, "en"), ("", None), (" \t.;", "fr"), ("one two three", "fr")] + rows[:20]
    assert found(spark, rows, min_count=3) == brute(rows, 3)
    assert found(spark, rows, min_count=3, top=5, cover_percent=90) == brute(rows, 3, 90, 5)


def test_rings_and_long_paths(spark):
    ring, path = " ".join(["la"] * 50), " ".join(f"w{i}" for i in range(1400))
    rows = [(ring, "x")] * 2 + [(path, "x")] * 3 + [("a b c a b c a b c a", "y")] * 4
    assert found(spark, rows, min_count=3) == brute(rows, 3)


def test_unary_paths(spark):
    edges = [("x", i, i + 1, i + 2, 5) for i in range(1, 1100)] + [("x", 5001, 5002, 5001, 7), ("x", 5002, 5001, 5002, 7)]
    paths = unary_paths(spark.createDataFrame(edges, "lang string, w1 long, w2 long, w3 long, n long")).collect()
    assert sorted(len(p.edges) for p in paths) == [1, 1, 1099 - 2 * module.PATH_EDGES, module.PATH_EDGES, module.PATH_EDGES]
    longest = sorted((p for p in paths if p.edges[0].w1 < 5000), key=lambda p: p.part)
    assert [e.w1 for p in longest for e in p.edges] == list(range(1, 1100))


def test_add_up_splits_nothing():
    words = np.array([[1, 2, 1, 1], [3, 3, 3, 4]], np.uint64)
    total, n = add_up(words, np.array([1, 2, 3, 4]))
    assert {(*map(int, w), int(c)) for w, c in zip(total.T, n, strict=True)} == {(1, 3, 4), (2, 3, 2), (1, 4, 4)}


def test_odd_tables(spark):
    assert found(spark, [], min_count=1) == []
    assert found(spark, [(None, None), ("", "x"), (" . ", "x"), ("one", "x")], min_count=1) == []
    schema = "`w1` int, text string, lang string, n int, `a.b` int, rank int"
    rows = [(1, "p q", "x", 2, 3, None)] * 3
    assert found(spark, rows, schema, min_count=3) == [("x", 1, "p q", 3, 3, 3, 6, 1000000)]
    long = "ab cd " * 400_000  # one text without any piece end
    assert found(spark, [(long, "x")], min_count=10) == brute([(long, "x")], 10)


def test_words_are_joined_when_many(spark, monkeypatch):
    monkeypatch.setattr(module, "BROADCAST_WORDS", 0)
    rows = [("p q r", "x"), ("q r s", "y"), (None, "x")] * 3
    assert found(spark, rows, min_count=3) == brute(rows, 3)


def test_exact_beyond_64_bits(spark):
    big = 4_000_000_000_000
    frame = spark.createDataFrame([(big, big + 1, big + 2)], "a long, l long, r long")
    score = frame.select(module._score(frame.a, frame.l, frame.r)).first()[0]
    assert score == 10**6 * big * big // ((big + 1) * (big + 2))


def test_query_equals_its_sql(spark):
    name = "op11_phrase_graph"
    ours, theirs = compare(spark, connect(SF_SMALL), registry.QUERIES[name], registry.ORACLE_SQL[name], SF_SMALL)
    assert ours == theirs


def test_a_task_that_counts_holds_little_beside_its_buffer(spark, monkeypatch):
    docs = spark.createDataFrame([("a b c", "en")], "text string, lang string")
    steps = []
    plain = type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, f, *a, **b: steps.append(f) or plain(self, f, *a, **b))
    module.word_graph(docs.select("lang", "text"), 2)
    rng = np.random.default_rng(0)
    words = int(2.1 * module.BUFFER)
    texts = [" ".join(map(str, rng.integers(0, 3000, 50_000))) for _ in range(-(-words // 50_000))]
    batches = [pa.RecordBatch.from_arrays([pa.array(["en"]), pa.array([t])], ["lang", "text"]) for t in texts]
    total = 0
    tracemalloc.start()
    for out in steps[0](iter(batches)):
        total += sum(int(module._unpacked(r["words"], r["edges"], r["n"])[1].sum()) for r in out.to_pylist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == 50_000 * len(texts)
    assert peak < 2.5 * 4 * 8 * module.BUFFER, f"{peak / 1e6:.0f} MB"
