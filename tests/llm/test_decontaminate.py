"""Benchmark decontamination (10): planted passages, paraphrases, and the given tables."""

import random

import numpy as np
import pyarrow as pa
import pytest
from growthledger.llm import decontaminate as module
from growthledger.llm import registry
from growthledger.llm.decontaminate import Passage, Searcher, decontaminate, find_leaks, latent_axes, passages_of


def words_of(text):
    return " ".join("".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower()).split())


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(7)
    common = ["the", "of", "and", "to", "in", "that", "is"]
    rare = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 9))) for _ in range(3000)]

    def prose(n):
        return [rng.choice(common) if rng.random() < 0.4 else rng.choice(rare) for _ in range(n)]

    items = {i: prose(rng.choice([5, 12, 20, 33, 48, 64, 150])) for i in range(60)}
    texts = {i: " ".join(w + rng.choice(["", "", ".", ",", "\n"]) for w in items[i]) for i in items}
    docs = [(d, " ".join(prose(rng.randint(0, 400)))) for d in range(300)]
    planted = set()
    for k in range(60):
        around = prose(60)
        docs.append((1000 + k, " ".join(around[: k % 23]) + "\n" + texts[k].upper() + " " + " ".join(around[k % 23 :])))
        planted.add((1000 + k, k))
    benchmark = spark.createDataFrame([(*x, "clash") for x in texts.items()] + [(None, "no id at all here now", "c"), (90, None, "c"), (91, "too short", "c")], "item_id long, text string, leaks string")
    return items, docs, planted, benchmark, prose


def test_planted_passages_are_found_and_nothing_else(spark, corpus, monkeypatch):
    items, docs, planted, benchmark, _ = corpus
    docs = docs + [(2000, None), (2001, ""), (None, docs[-1][1]), docs[-1]]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, leaks int").repartition(3)
    for at_once in (20_000, 20):  # in one pass, and in several
        monkeypatch.setattr(module, "PASSAGES_AT_ONCE", at_once)
        found = find_leaks(df, benchmark).collect()
        assert len(found) == len(docs)
        assert {(r.doc_id, x.item_id) for r in found if r.doc_id is not None for x in r.leaks} == planted
        assert [[x.item_id for x in r.leaks] for r in found if r.doc_id is None] == [[59]]
    kept = decontaminate(df, benchmark)
    assert kept.columns == ["doc_id", "text"]
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs if d is not None and not 1000 <= d < 2000}


def test_paraphrases_with_the_answer_kept(spark, corpus):
    items, docs, _, _, prose = corpus
    rng = random.Random(1)
    question, answer = prose(30), [f"answer{k}" for k in range(6)]
    item = " ".join(question) + ". " + " ".join(answer) + "."
    changed = [w if rng.random() > 0.2 else "other" for w in question]
    rows = [
        (1, " ".join(prose(50) + changed + answer + prose(50))),
        (2, " ".join(prose(50) + changed + prose(50))),  # its answer isn't there
        (3, " ".join(prose(50) + ["other" if k % 2 else w for k, w in enumerate(question)] + prose(50))),
    ]
    df = spark.createDataFrame(docs + [(d + 5000, t) for d, t in rows], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, item), *[(i + 2, " ".join(w)) for i, w in items.items() if i < 5]], "item_id long, text string")
    found = find_leaks(df.where("doc_id >= 5000 OR doc_id < 300"), benchmark)
    assert {r.doc_id for r in found.where("size(leaks) > 0").collect()} == {5001}


def test_common_subsequence_equals_the_table_method():
    rng = random.Random(5)
    for _ in range(100):
        a, b = ([rng.randint(0, 6) for _ in range(rng.randint(5, 30))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        passage = Passage(1, np.array(a, np.uint64), 3)
        searcher = Searcher([passage], np.ones(module.FEATURES), np.array([0]), np.ones((1, 1)), 0.5, 0.9, 0.6)
        share, answered = searcher.overlap(b, 0)
        assert share == table[-1, -1] / len(a)
        assert answered == (table[-1, -1] - table[len(a) - 3, -1]) / 3


def test_axes_equal_the_singular_vectors(spark, monkeypatch):
    monkeypatch.setattr(module, "DIMS", 3)
    monkeypatch.setattr(module, "ROUNDS", 12)
    rng = random.Random(3)
    texts = [" ".join(rng.choices([f"t{k % 4}w{j}" for j in range(12)], k=40)) for k in range(30)]
    rarity = np.linspace(1, 2, module.FEATURES)
    features, axes = latent_axes(spark.createDataFrame(list(enumerate(texts)), "item_id long, text string").repartition(4), rarity, 5)
    place = {f: k for k, f in enumerate(features.tolist())}
    matrix = np.zeros((30, len(features)))
    for row, text in zip(matrix, texts, strict=True):
        for f in module._features(next(module._words(pa.array([text])))).tolist():
            row[place[f]] += rarity[f]
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    _, _, want = np.linalg.svd(matrix, full_matrices=False)
    assert np.allclose(np.abs((axes.T * want[:3]).sum(axis=1)), 1, atol=1e-3)


def test_passages_cover_long_items():
    text = " ".join(f"w{k}" for k in range(150)) + ". The last one is short."
    parts = passages_of(1, text, 5)
    assert [len(p.words) for p in parts] == [52, 52, 51] and [p.answer for p in parts] == [0, 0, 5]
    assert passages_of(1, "a b c", 5) == [] == passages_of(1, "", 1)


def test_given_tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = {(r.doc_id, r.item_id) for r in registry.QUERIES["op10_decontaminate"](spark, sf_dir).collect()}
    docs = [(r.doc_id, f" {words_of(r.text)} ") for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, f" {words_of(r.text)} ") for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert found == {(d, i) for d, text in docs for i, item in items if item in text}


def test_empty_tables(spark, corpus):
    _, docs, _, benchmark, _ = corpus
    df = spark.createDataFrame(docs[:5], "doc_id long, text string")
    assert find_leaks(df.limit(0), benchmark).count() == 0
    assert decontaminate(df, benchmark.limit(0)).count() == 5


def test_short_items_are_found_as_exact_copies_only(spark, corpus):
    _, docs, _, _, _ = corpus
    rng = random.Random(3)
    letters = ["x1", "x2", "x3", "x4"]
    items = {k: rng.choices(letters, k=1 + k % 4) for k in range(24)}
    items[24] = ["x1"] * 6
    texts = [(k, rng.choices([*letters, "and", "so"], k=rng.randint(0, 9))) for k in range(300)]
    benchmark = spark.createDataFrame(
        [*[(k, " ".join(w) + ".") for k, w in items.items()], (90, ""), (91, " ... ")], "item_id long, text string"
    )
    for longer in (True, False):  # also where no item is long
        wanted = items if longer else {k: w for k, w in items.items() if len(w) < 5}
        rows = texts + [(d + 5000, t.split()) for d, t in docs[:20]]
        df = spark.createDataFrame([(d, ", ".join(w).upper()) for d, w in rows], "doc_id long, text string").repartition(3)
        asked = benchmark if longer else benchmark.where("item_id <> 24")
        found = {(r.doc_id, x.item_id) for r in find_leaks(df, asked).collect() for x in r.leaks if x.item_id != 24}
        assert found == {
            (d, k) for d, w in rows for k, item in wanted.items() if k != 24
            and any(w[a : a + len(item)] == item for a in range(len(w) - len(item) + 1))
        }


def test_every_verbatim_copy_of_thousands_of_items_is_found(spark):
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(3000)]
    weights = [1 / (k + 1) for k in range(3000)]
    items = [rng.choices(vocabulary, weights, k=rng.choice([5, 6, 8, 11, 14, 15, 24, 40, 59, 90])) for _ in range(2500)]
    docs = []
    for k, item in enumerate(items):
        around = rng.choices(vocabulary, weights, k=60)
        cut = rng.randint(0, 60)
        docs.append((k, " ".join(around[:cut] + item + around[cut:])))
    docs += [(10_000 + k, " ".join(rng.choices(vocabulary, weights, k=80))) for k in range(500)]
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    found = {r.doc_id: {x.item_id for x in r.leaks} for r in find_leaks(df, benchmark).collect()}
    assert [k for k in range(len(items)) if k not in found[k]] == []


def test_edited_copies_of_a_thousand_items_are_found(spark):
    rng = random.Random(12)
    vocabulary = [f"w{k}" for k in range(20_000)]
    items = [rng.choices(vocabulary, k=rng.randint(40, 59)) for _ in range(1000)]
    docs = []
    for k, item in enumerate(items):
        copy = [w for j, w in enumerate(item) if j % 20 != k % 20]  # a word in twenty is gone
        docs.append((k, " ".join(rng.choices(vocabulary, k=30) + copy + rng.choices(vocabulary, k=30))))
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)], "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    found = {r.doc_id: [x.item_id for x in r.leaks] for r in find_leaks(df, benchmark).collect()}
    assert found == {k: [k] for k in range(1000)}
