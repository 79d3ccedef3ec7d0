"""Exact top-k search by inner product over KD-trees, one per shard.

Vectors are dealt into shards of bounded size by a hash of their id. A shard's tree splits
at the median of the widest dimension and keeps a tight box per node. The most a
query can score inside a box is reached at one of its corners, so nodes are visited best
first and a search ends when no box can beat the kth hit. Each query first searches its home
shard; the kth hit found there goes with it to all others, which return only what beats it.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import prepare, table

SHARD_ROWS = 8192
#: Queries that meet a shard in one group; more are dealt into several groups.
QUERY_ROWS = 8192
LEAF_ROWS = 128

_HITS = "query_id long, vec_id long, score long"


@dataclass
class Tree:
    """Points in tree order; node i holds rows start[i] to end[i] and has children left[i], right[i] or -1."""

    points: np.ndarray
    ids: np.ndarray
    start: list[int]
    end: list[int]
    left: list[int]
    right: list[int]
    low: np.ndarray
    high: np.ndarray
    least_id: list[int]


def build(points: np.ndarray, ids: np.ndarray) -> Tree:
    order = np.arange(len(ids))
    start, end, left, right, low, high, least = [], [], [], [], [], [], []

    def add(a: int, b: int) -> int:
        rows = points[order[a:b]]
        node = len(start)
        for values, value in (
            (start, a), (end, b), (left, -1), (right, -1), (low, rows.min(axis=0)), (high, rows.max(axis=0)),
            (least, int(ids[order[a:b]].min())),
        ):
            values.append(value)
        return node

    todo = [add(0, len(ids))]
    while todo:
        node = todo.pop()
        a, b = start[node], end[node]
        width = high[node] - low[node]
        if b - a <= LEAF_ROWS or not len(width) or width.max() == 0:
            continue  # small, or all vectors are the same
        at = order[a:b]
        middle = (b - a) // 2
        order[a:b] = at[np.argpartition(points[at, int(width.argmax())], middle)]
        left[node], right[node] = add(a, a + middle), add(a + middle, b)
        todo += [left[node], right[node]]
    return Tree(points[order], ids[order], start, end, left, right, np.array(low), np.array(high), least)


def search(tree: Tree, query: np.ndarray, own_id: int, k: int, bound: tuple[int, int] | None) -> list[tuple[int, int]]:
    """The k best (score, id) of the tree, highest score first, then least id.

    ``bound``: the kth hit found elsewhere; only what beats it is returned.
    """
    plus, minus = np.maximum(query, 0), np.minimum(query, 0)
    most = tree.high @ plus + tree.low @ minus
    heap = [(-most[0], tree.least_id[0], 0)]
    hits: list[tuple[int, int]] = []  # heap of (score, -id): the worst on top
    worst = (bound[0], -bound[1]) if bound else None
    while heap:
        top, least, node = heapq.heappop(heap)
        if worst is not None and (-top, -least) <= worst:
            break  # neither this box nor any after it can beat the kth hit
        if tree.left[node] >= 0:
            for child in (tree.left[node], tree.right[node]):
                heapq.heappush(heap, (-most[child], tree.least_id[child], child))
            continue
        a, b = tree.start[node], tree.end[node]
        scores = tree.points[a:b] @ query
        at = np.flatnonzero(scores >= worst[0]) if worst is not None else np.arange(b - a)
        for score, vec_id in zip(scores[at].tolist(), tree.ids[a:b][at].tolist(), strict=True):
            hit = (int(score), -vec_id)
            if vec_id == own_id or (worst is not None and hit <= worst):
                continue
            heapq.heappush(hits, hit)
            if len(hits) > k:
                heapq.heappop(hits)
            if len(hits) == k:
                worst = hits[0] if worst is None else max(worst, hits[0])
    return [(score, -minus_id) for score, minus_id in sorted(hits, reverse=True)]


def _matrix(column: pd.Series, exact: bool) -> np.ndarray:
    rows = np.array(column.tolist(), np.int64)
    # Products of doubles are exact while they stay below 2**53; larger ones use Python's integers.
    return rows.astype(np.float64) if exact else rows.astype(object)


def _search_shard(k: int):
    def searched(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int]] = []
        if len(vectors) and len(queries):
            largest = [max((abs(x) for v in t for x in v), default=0) for t in (vectors["vector"], queries["query"])]
            exact = largest[0] * largest[1] * max(1, len(vectors["vector"].iat[0])) < 1 << 53
            tree = build(_matrix(vectors["vector"], exact), vectors["vec_id"].to_numpy(np.int64))
            points = _matrix(queries["query"], exact)
            scores, ids = queries["bound_score"].tolist(), queries["bound_id"].tolist()
            for i, query_id in enumerate(queries["query_id"].tolist()):
                bound = None if pd.isna(scores[i]) else (int(scores[i]), int(ids[i]))
                found += [(query_id, v, s) for s, v in search(tree, points[i], query_id, k, bound)]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"], dtype=np.int64)

    return searched


def integer_vectors(df: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector array<long>): floor(scale * x) of the rows that take part."""
    fits = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(fits)
    vector = F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return usable.select(F.col(id_col).cast("long").alias("vec_id"), vector.alias("vector"))


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def top_k(
    df: DataFrame, k: int = 10, every: int = 100, scale: int = 1024, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each row whose id ``every`` divides.

    Scores are inner products of the vectors floor(scale * x), ties go to the smaller id.
    Vectors that are null or hold a null or non-finite component, and rows without id, take no part. Rows that
    repeat an id are candidates each, and queries each; the queries of an id share its ranks. Vectors of another length than the query's are no
    candidates; fewer candidates than ``k`` are all returned, none gives no rows.
    """
    prepare(df.sparkSession)
    vectors = table(integer_vectors(df, scale, id_col, vector_col), "vectors")
    of_queries = F.col("vec_id") % every == 0
    n, n_queries = vectors.agg(F.count("*"), F.count_if(of_queries)).first()
    shards, parts = max(1, -(-n // SHARD_ROWS)), max(1, -(-n_queries // QUERY_ROWS))

    key = ["length", "shard", "part"]
    dealt = vectors.select("vec_id", "vector", F.size("vector").alias("length"), _shard(F.col("vec_id"), shards).alias("shard"))
    dealt = dealt.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    queries = vectors.where(of_queries).select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.size("vector").alias("length"),
        _shard(F.col("vec_id"), shards).alias("home"),
        F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(parts)).cast("int").alias("part"),
    )

    def hits(asked: DataFrame) -> DataFrame:
        groups = dealt.groupBy(*key).cogroup(asked.groupBy(*key))
        return groups.applyInPandas(_search_shard(k), _HITS)

    none = F.lit(None).cast("long")
    at_home = queries.withColumn("shard", F.col("home")).withColumn("bound_score", none).withColumn("bound_id", none)
    first = table(hits(at_home), "hits")

    # The kth hit at home, where there are k.
    worst = F.min(F.struct("score", (-F.col("vec_id")).alias("id"))).alias("worst")
    bounds = first.groupBy("query_id").agg(F.count("*").alias("n"), worst).where(F.col("n") >= k).select(
        "query_id", F.col("worst.score").alias("bound_score"), (-F.col("worst.id")).alias("bound_id")
    )
    away = queries.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
    second = hits(away.join(bounds, "query_id", "left"))

    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = first.unionByName(second).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


#: The query's rows in SQL.
ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
