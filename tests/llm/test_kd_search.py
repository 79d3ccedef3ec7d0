"""Exact top-k search (9) against brute force and its SQL."""

import math
import random

import numpy as np
import pytest
from growthledger.llm import kd_search, registry
from growthledger.llm.kd_search import build, search, top_k
from oracle import compare, connect


def brute(rows, k, every):
    vectors = [
        (i, [math.floor(1024 * x) for x in v]) for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    scored = {}
    for q, a in vectors:
        if q % every == 0:
            scored.setdefault(q, []).extend(
                (-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in vectors if i != q and len(a) == len(b)
            )
    return sorted((q, r + 1, i, -s) for q, hits in scored.items() for r, (s, i) in enumerate(sorted(hits)[:k]))


def vectors(seed, dims=6):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([rng.gauss(0, 1), 0.0, 0.5]) for _ in range(dims)]) for i in range(600)]
    rows += [(i, [0.5] * dims) for i in range(600, 900)]  # one very common vector
    rows += [(1000, None), (1001, [None] * dims), (1002, [float("nan")] * dims), (1003, [float("inf")] + [0.0] * (dims - 1))]
    rows += [(1010, [1.0, 2.0]), (1020, [1.0, -2.0]), (1030, []), (None, [0.5] * dims), (-10, [0.25] * dims)]
    # Ids that come back, with the same vector and with others.
    return rows + [rows[5], rows[10], rows[10], (20, [9.0] * dims), (21, [9.0] * dims), (21, [-8.0] * dims), (-10, [2.0] * dims)]


@pytest.mark.parametrize("sizes", [(8192, 8192, 128), (100, 20, 4)])
def test_equals_brute_force(spark, monkeypatch, sizes):
    for name, value in zip(("SHARD_ROWS", "QUERY_ROWS", "LEAF_ROWS"), sizes, strict=True):
        monkeypatch.setattr(kd_search, name, value)
    rows = vectors(1)
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    found = top_k(df.repartition(4), every=10)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 10, 10)


def test_few_candidates_huge_components_and_empty_table(spark):
    rows = [(0, [1e9, 2.0]), (1, [-1e9, 3.0]), (2, [5e8, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    with pytest.raises(Exception):  # noqa: B017 - such a score is no long
        top_k(df.withColumn("embedding", kd_search.F.transform("embedding", lambda x: x * 1e9))).collect()
    rows = [(i, [x / 1e3 for x in v]) for i, v in rows]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in top_k(df).collect()) == brute(rows, 10, 100)
    assert top_k(df.limit(0)).count() == 0


def test_bounds_prune_and_lose_nothing():
    rng = np.random.default_rng(2)
    points = np.floor(rng.standard_normal((4000, 3)) * 1024)
    tree = build(points, np.arange(4000))
    assert all((tree.low[i] <= tree.points[a:b].min(axis=0)).all() for i, (a, b) in enumerate(zip(tree.start, tree.end, strict=True)))
    scores = points @ points[7]
    want = sorted(((int(s), i) for i, s in enumerate(scores) if i != 7), key=lambda h: (-h[0], h[1]))[:5]
    assert search(tree, points[7], 7, 5, None) == want
    assert search(tree, points[7], 7, 5, want[2]) == want[:2]


def test_query_equals_its_sql(spark):
    name, sf_dir = "op9_kd_search", "/root/testdata/sf0.01"
    ours, theirs = compare(spark, connect(sf_dir), registry.QUERIES[name], registry.ORACLE_SQL[name], sf_dir)
    assert ours == theirs
