"""N-gram Jaccard join (1) against all pairs."""

import random
import re

import pytest
from growthledger.llm import ngram_join, shingle_sets
from growthledger.llm.components import components

WORDS = [f"w{i}" for i in range(400)]


def brute(rows, n=3, percent=90):
    """{(id, n_shingles, component)} as a list, from all pairs of sets."""
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        width = min(n, len(words))
        sets.append({tuple(words[k : k + width]) for k in range(len(words) - width + 1)} if words else set())
    owner = list(range(len(rows)))

    def root(k):
        while owner[k] != k:
            k = owner[k]
        return k

    for i, (a, _) in enumerate(rows):
        for j in range(i):
            both = len(sets[i] & sets[j])
            union = len(sets[i]) + len(sets[j]) - both
            linked = sets[i] and sets[j] and 100 * both >= percent * union
            if a is not None and rows[j][0] is not None and (linked or (rows[j][0] == a and sets[i] and sets[j])):
                owner[root(i)] = root(j)
    low = {}
    for k, (a, _) in enumerate(rows):
        low[root(k)] = min(low.get(root(k), a), a) if a is not None else None
    return sorted(str((a, len(s), low[root(k)])) for k, ((a, _), s) in enumerate(zip(rows, sets, strict=True)))


def near_copies(rng):
    """Families of texts at all distances around the threshold, short texts, odd texts."""
    rows = []
    for _ in range(12):
        base = [rng.choice(WORDS) for _ in range(rng.choice([9, 10, 11, 30, 60, 120]))]
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            rows.append(" ".join(copy))
    line = " ".join(rng.choice(WORDS) for _ in range(12))
    rows += [line + " " + " ".join(rng.choice(WORDS) for _ in range(k)) for k in (0, 1, 2, 3, 20, 30, 30, 30)]
    rows += ["a", "A", "a b", "a  B\n", "a b c", None, "", " \n", "a b c a b c", "a b c a b c a b c"]
    rows += [line.upper(), "é" * 3, "É" * 3]
    return rows


@pytest.mark.parametrize("seed, block", [(1, 2048), (2, 3)])
def test_equals_all_pairs(spark, monkeypatch, seed, block):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block)
    monkeypatch.setattr(ngram_join, "TILE_SETS", block)
    monkeypatch.setattr(ngram_join, "PREFIX_SETS", block)
    rng = random.Random(seed)
    rows = list(enumerate(near_copies(rng)))
    rng.shuffle(rows)
    rows += [(5, dict(rows)[5]), (7, "one id with two texts"), (None, dict(rows)[5]), (None, "x y z")]
    docs = spark.createDataFrame([(a, t, 1, 2) for a, t in rows], "doc_id long, text string, rep int, token int")
    result = ngram_join.ngram_jaccard_join(docs.repartition(5))
    assert result.columns[:3] == ["doc_id", "n_shingles", "component_id"]
    assert sorted(str(tuple(r)[:3]) for r in result.collect()) == brute(rows)


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(shingle_sets, "BROADCAST_IDS", 0)
    rows = list(enumerate(near_copies(random.Random(3))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(str(tuple(r)[:3]) for r in ngram_join.ngram_jaccard_join(docs).collect()) == brute(rows)


def test_other_parameters(spark):
    rows = list(enumerate(near_copies(random.Random(4))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    result = ngram_join.ngram_jaccard_join(docs, n=5, threshold=0.8)
    assert sorted(str(tuple(r)[:3]) for r in result.collect()) == brute(rows, 5, 80)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_join.ngram_jaccard_join(docs).count() == 0


@pytest.mark.parametrize("task_links", [1 << 18, 7])
def test_components_of_a_chain_and_a_hub(spark, monkeypatch, task_links):
    monkeypatch.setattr("growthledger.llm.components.TASK_LINKS", task_links)
    chain = [(i, i + 1) for i in range(100, 140)]
    hub = [(7, i) for i in range(8, 60)] + [(9, 9), (None, 3), (8, 7), (60, 59)]
    found = components(spark.createDataFrame(chain + hub, "a long, b long")).collect()
    assert {(r.node, r.component) for r in found} == {(i, 100) for i in range(100, 141)} | {(i, 7) for i in range(7, 61)}
    assert len(found) == 41 + 54


def test_link_counts_and_pairs_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 5)
    rows = list(enumerate(near_copies(random.Random(6))))
    base = [f"b{k}" for k in range(200)]
    rows += [(1000 + k, " ".join(w if j != k else "x" for j, w in enumerate(base))) for k in range(12)]  # all alike
    rows += [(2000, rows[-1][1]), (2001, rows[-1][1].upper())]
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        width = min(3, len(words))
        sets[i] = frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1)) if words else frozenset()
    linked = {(i, j) for i in sets for j in sets if i != j and sets[i] and sets[j] and 10 * len(sets[i] & sets[j]) >= 9 * len(sets[i] | sets[j])}
    again = [*rows, rows[3], (None, rows[3][1])]
    docs = spark.createDataFrame(again, "doc_id long, text string").repartition(4)
    found = ngram_join.ngram_jaccard_join(docs).collect()
    assert len(found) == len(again)
    assert {r.doc_id: r.n_links for r in found} == {i: sum(a == i for a, _ in linked) for i in sets} | {None: 0}
    low = {i: min(j for j in sets if sets[j] == sets[i]) for i in sets}
    pairs = ngram_join.similar_pairs(docs).collect()
    want = {frozenset((low[a], low[b])) for a, b in linked if sets[a] != sets[b]}
    assert len(pairs) == len(want) and {frozenset((r.a, r.b)) for r in pairs} == want
    assert all(r.a_docs == sum(low[i] == r.a for i in low if sets[i]) for r in pairs)
