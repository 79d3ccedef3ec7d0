"""MinHash near-dedup (13) against all pairs, and its SQL."""

import random

import numpy as np
import pytest
from helpers import TESTDATA
from oracle import compare, connect
from test_ngram_join import brute, near_copies

from growthledger.llm import minhash_dedup as module
from growthledger.llm import registry, shingle_sets
from growthledger.llm.minhash_dedup import BANDS, ROWS, band_hashes, bin_orders, minhash_dedup, signature

SF_SMALL = f"{TESTDATA}/sf0.001"


def got(spark, rows, schema="doc_id long, text string", **options):
    result = minhash_dedup(spark.createDataFrame(rows, schema).repartition(3), **options)
    return sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in result.collect())


def test_equals_all_pairs(spark):
    rows = list(enumerate(near_copies(random.Random(1))))
    rows += [(5, dict(rows)[5]), (7, "one id with two texts"), (None, dict(rows)[5]), (None, "x y z"), (None, None)]
    assert got(spark, rows) == brute(rows, 4, 80)
    assert got(spark, rows, n=3, threshold=0.9) == brute(rows, 3, 90)


def chained(rng, n):
    """Texts around the threshold: each changes a few words of one of the texts before it."""
    texts = [[f"w{rng.randrange(5000)}" for _ in range(60)]]
    while len(texts) < n:
        copy = list(rng.choice(texts))
        for _ in range(rng.randrange(1, 4)):
            copy[rng.randrange(60)] = f"w{rng.randrange(5000)}"
        texts.append(copy)
    return [(10 + i, " ".join(t)) for i, t in enumerate(texts)]


def test_large_group_around_the_threshold_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_SETS", 16)
    monkeypatch.setattr(module, "STAR_ROWS", 8)
    monkeypatch.setattr(shingle_sets, "BROADCAST_IDS", 0)
    rows = chained(random.Random(3), 150)
    assert got(spark, rows) == brute(rows, 4, 80)


def test_rest_finds_every_component_that_is_near(spark):
    """The blocks alone, without any star before."""
    rng, t = random.Random(4), module.Fraction("0.8")
    base = rng.sample(range(1, 10**6), 40)
    sets = {k: np.array(sorted({*base[:-6], *rng.sample(base[-6:], 4), 10**7 + k // 3}), np.uint64) for k in range(60)}
    mixed = spark.createDataFrame([(1, k, len(s), k) for k, s in sets.items()], "bucket long, rep long, n_shingles long, component long")
    packed = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in sets.items()], "rep long, hashes binary")
    module.prepare(spark)
    links = {frozenset((r.a, r.b)) for r in module._rest(mixed, packed, t).collect()}
    near = {
        frozenset((a, b)) for a in sets for b in sets
        if a < b and 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))
    }
    assert near and links == near


def test_rows_of_a_result(spark):
    long = " ".join(f"t{i}" for i in range(200_000))
    rows = [(3, long), (2, long.upper()), (9, long + " end"), (4, None), (5, ""), (6, " \n\t"), (None, "p q"), (8, "p q"), (8, "p q")]
    schema = "doc_id long, text string, rep int, component int, `a.b` int"
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in rows], schema)
    found = sorted(map(tuple, minhash_dedup(docs).collect()), key=str)
    assert found == sorted(
        [
            (3, 199_997, 2, 2, False), (2, 199_997, 2, 2, True), (9, 199_998, 2, 9, False), (4, 0, 4, 4, True), (5, 0, 5, 5, True),
            (6, 0, 6, 6, True), (None, 1, None, None, True), (8, 1, 8, 8, True), (8, 1, 8, 8, True),
        ],
        key=str,
    )
    assert minhash_dedup(docs.where("doc_id < 0")).collect() == []


@pytest.mark.parametrize("size", [5, 40, 1000])
def test_signatures_agree_as_often_as_sets_are_alike(size):
    rng, orders = np.random.default_rng(size), bin_orders(BANDS * ROWS)
    agree, met = [], 0
    for _ in range(200):
        both = rng.integers(1, 2**63, size * 4 // 5, dtype=np.uint64)
        more = rng.integers(1, 2**63, size - len(both), dtype=np.uint64)
        a, b = signature(np.unique(both), orders), signature(np.unique(np.concatenate([both, more])), orders)
        agree.append((a == b).mean())
        met += bool((band_hashes(a, BANDS) == band_hashes(b, BANDS)).any())
    assert abs(np.mean(agree) - 0.8) < 0.02
    assert met == 200


def test_query_equals_its_sql(spark):
    name = "op13_minhash_dedup"
    ours, theirs = compare(spark, connect(SF_SMALL), registry.QUERIES[name], registry.ORACLE_SQL[name], SF_SMALL)
    assert ours == theirs
