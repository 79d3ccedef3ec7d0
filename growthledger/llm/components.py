"""Connected components of a link table by rounds of joins; no link or node reaches the driver."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, table

#: Links of one task when each task first contracts its own.
TASK_LINKS = 1 << 18


def lowest_reachable(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node reachable over the links a-b), for every node of a link."""
    node, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    low = np.arange(len(node))
    while len(a):
        # The smallest nodes of both sides' parts are tied, then every node looks its part up again.
        x, y = low[a], low[b]
        apart = x != y
        if not apart.any():
            break
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while (low[low] != low).any():
            low = low[low]
    return node, node[low]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, u): the task's nodes, each tied to the smallest that the task's links reach."""
    held = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches]
    if held:
        node, low = lowest_reachable(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))
        other = node != low
        yield pa.RecordBatch.from_arrays([pa.array(node[other]), pa.array(low[other])], ["v", "u"])


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``links`` (a, b), for every linked node.

    Each task first contracts at most TASK_LINKS links to stars. Where these are all, they are the
    result; else two steps alternate until nothing changes. Each ties neighbours of a node to its
    smallest neighbour: first the larger ones, then the node itself with the smaller ones. A node with very
    many links is reduced by a minimum that combines on the map side, and its join is left to adaptive
    skew handling. Repeated links, loops and links with a null end are harmless.
    """
    links = links.where("a <> b").select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    links = table(links, "links")
    tasks = max(1, -(-links.count() // TASK_LINKS))
    dealt = links.coalesce(1) if tasks == 1 else links.repartition(tasks)
    edges = table(dealt.mapInArrow(_contracted, "v long, u long"), "stars")
    release(links)
    if tasks == 1:
        return _with_roots(edges)
    edges = table(edges.distinct(), "links")
    before = None
    while True:
        # Large step: everything around a node that is larger than it points to the node's smallest neighbour.
        around = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = around.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = around.where("v > u").join(low, "u").select("v", F.col("low").alias("u")).distinct()
        # Small step: a node and its smaller neighbours point to the smallest of them.
        low = large.groupBy("v").agg(F.min("u").alias("low"))
        joined = large.join(low, "v")
        small = joined.select(F.col("u").alias("v"), F.col("low").alias("u")).where("v <> u")
        own = low.select("v", F.col("low").alias("u"))
        earlier, edges = edges, table(small.unionByName(own).distinct(), "links")
        release(earlier)
        state = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == before:
            return _with_roots(edges)
        before = state


def _with_roots(stars: DataFrame) -> DataFrame:
    roots = stars.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return stars.select(F.col("v").alias("node"), F.col("u").alias("component")).unionByName(roots)
