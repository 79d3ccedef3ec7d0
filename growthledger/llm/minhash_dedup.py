"""Near duplicates by one-permutation MinHash: bands, stars of candidates, checks on full sets.

One permutation of the hash space is cut into bins; a set's signature is its least value in each bin. A bin without
any takes the value of a bin that the set fills, chosen by an order of the bins that is the bin's own and the same
for all sets (optimal densification), so two sets agree there as often as elsewhere. Sets that
agree in a whole band of bins share a bucket. With 30 bands of 5, two sets at a similarity of 0.8 miss each other
with a probability of 7 in a million, more similar ones less.

A bucket of n sets gives n - 1 candidate edges, from its hub to the others, not n * n. Each candidate pair is
checked on the full sets. Two rounds of stars with different hubs leave few buckets with several
components; their sets are then compared group by group in blocks of bounded size, and each set reports one link
per component that it reaches, so nothing that shares a bucket stays unchecked and no pairs are written.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import mix, prepare, release, table
from .components import components
from .shingle_sets import SET_KEY, full_sets, sets_of, sums

BANDS, ROWS = 30, 5
#: Sets that are checked against one copy of a hub's set.
STAR_ROWS = 512
#: Sets and shingles of one block when what is left of a group is compared.
BLOCK_SETS, BLOCK_SHINGLES = 1024, 1 << 20

def bin_orders(bins: int) -> np.ndarray:
    """Row e: the rank of each bin in the order in which bin e borrows."""
    cells = np.arange(bins * bins, dtype=np.uint64).reshape(bins, bins)
    return np.argsort(np.argsort(mix(cells * np.uint64(0x9E3779B97F4A7C15)), axis=1), axis=1)


def signature(hashes: np.ndarray, orders: np.ndarray) -> np.ndarray:
    """One value per bin; bins that ``hashes`` (distinct, at least one) leave empty borrow."""
    bins = len(orders)
    spread = np.sort(mix(hashes ^ np.uint64(0x2545F4914F6CDD1D)))
    # Bins follow the order of the values, so the first of each is its least.
    which = ((spread >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    filled, first = np.unique(which.astype(np.int64), return_index=True)
    values = np.zeros(bins, np.uint64)
    values[filled] = spread[first]
    if len(filled) < bins:
        empty = np.ones(bins, bool)
        empty[filled] = False
        values[empty] = values[filled[np.argmin(orders[empty][:, filled], axis=1)]]
    return values


def band_hashes(values: np.ndarray, bands: int) -> np.ndarray:
    rows = values.reshape(bands, -1)
    total = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(rows.shape[1]):
        total = mix(total + rows[:, k] * np.uint64(0xA0761D6478BD642F))
    return total.view(np.int64)


def signed(docs: DataFrame, n: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, sum1, sum2, bands) per text; equal sums stand for equal sets."""

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = bin_orders(bands * rows)
        for batch in batches:
            size, sum1, sum2, found = [], [], [], []
            for hashes in sets_of(batch.column(1), n):
                a, b = sums(hashes)
                size.append(len(hashes))
                sum1.append(a)
                sum2.append(b)
                found.append(band_hashes(signature(hashes, orders), bands) if len(hashes) else np.zeros(0, np.int64))
            ends = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
            flat = np.concatenate(found) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(size, pa.int64()), pa.array(np.array(sum1, np.int64)),
                    pa.array(np.array(sum2, np.int64)), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                ],
                ["doc_id", *SET_KEY, "bands"],
            )

    return docs.mapInArrow(described, "doc_id long, n_shingles long, sum1 long, sum2 long, bands array<long>")


def _similar(both: np.ndarray, m: np.ndarray, n: np.ndarray, t: Fraction) -> np.ndarray:
    return both * t.denominator >= (m + n - both) * t.numerator


def _checked(pairs: DataFrame, sets: DataFrame, t: Fraction) -> DataFrame:
    """The ``pairs`` (a, b) that are similar. The sets of the b are sent once per STAR_ROWS pairs, those of the a once per pair."""
    hubs = pairs.groupBy("b").agg(F.ceil(F.count("*") / STAR_ROWS).alias("salts"))
    salted = pairs.join(hubs, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("salts")).alias("salt"))
    members = salted.join(sets.withColumnRenamed("rep", "a"), "a").select("b", "salt", F.lit(1).alias("member"), "a", "hashes")
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("salt")
    centres = hubs.select("b", copies).join(sets.withColumnRenamed("rep", "b"), "b")
    centres = centres.select("b", "salt", F.lit(0).alias("member"), F.col("b").alias("a"), "hashes")
    dealt = centres.unionByName(members).repartition("b", "salt").sortWithinPartitions("b", "salt", "member")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, centre = None, np.zeros(0, np.uint64)
        for batch in batches:
            found: list[tuple[int, int]] = []
            columns = (batch.column(k).to_pylist() for k in ("b", "member", "a"))
            for b, member, a, packed in zip(*columns, batch.column("hashes"), strict=True):
                hashes = np.frombuffer(packed.as_buffer(), np.uint64)
                if not member:
                    hub, centre = b, hashes.copy()
                elif hub == b:
                    at = np.searchsorted(centre, hashes)
                    both = np.count_nonzero(centre[np.minimum(at, len(centre) - 1)] == hashes)
                    if _similar(both, len(hashes), len(centre), t):
                        found.append((a, b))
            a, b = ([p[k] for p in found] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return dealt.mapInArrow(compared, "a long, b long")


def _stars(rows: DataFrame, salt: Column, t: Fraction) -> DataFrame:
    """Distinct pairs (a, b): each set and its bucket's hub, where they are not connected yet and sizes allow it."""
    hub = F.min(F.struct(F.xxhash64("rep", salt).alias("h"), "rep", "n_shingles", "component")).alias("hub")
    paired = rows.join(rows.groupBy("bucket").agg(hub), "bucket").where("component <> hub.component")
    m, n = F.col("n_shingles"), F.col("hub.n_shingles")
    near = (F.least(m, n) * t.denominator) >= (F.greatest(m, n) * t.numerator)
    return paired.where(near).select(F.col("rep").alias("a"), F.col("hub.rep").alias("b")).distinct()


def _mixed(rows: DataFrame, state: DataFrame) -> DataFrame:
    """The rows of buckets in which several components meet."""
    rows = rows.drop("component").join(state, "rep")
    ends = rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return rows.join(ends.where("low <> high").select("bucket"), "bucket", "leftsemi")


def _state(rows: DataFrame, links: DataFrame) -> DataFrame:
    """(rep, component) of all sets in buckets."""
    reached = components(links).select(F.col("node").alias("rep"), F.col("component").alias("found"))
    reps = rows.select("rep").distinct().join(reached, "rep", "left")
    return table(reps.select("rep", F.coalesce("found", "rep").alias("component")), "state")


def _rest(mixed: DataFrame, sets: DataFrame, t: Fraction) -> DataFrame:
    """Links (a, b) between components in the buckets ``mixed`` (bucket, rep, n_shingles, component).

    Sets that are connected over such buckets form a group. A group is dealt into blocks and each pair of blocks is
    compared by itself; a set gives one link to each component that it is similar to.
    """
    tied = mixed.join(mixed.groupBy("bucket").agg(F.min("rep").alias("b")), "bucket").select(F.col("rep").alias("a"), "b")
    groups = components(tied).select(F.col("node").alias("rep"), F.col("component").alias("group"))
    members = mixed.select("rep", "n_shingles", "component").distinct().join(groups, "rep")
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES))
    members = members.join(members.groupBy("group").agg(blocks.alias("n_blocks")), "group")
    own = F.pmod(F.xxhash64("rep"), F.col("n_blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    dealt = members.withColumn("own", own).withColumn("other", other)
    dealt = dealt.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    key = ["group", "low", "high"]
    dealt = dealt.select(*key, "rep", "component").join(sets, "rep").repartition(*key).sortWithinPartitions(*key, "rep")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, reps, ties, held = None, [], [], []
        for batch in batches:
            keys = zip(*(batch.column(k).to_pylist() for k in key), strict=True)
            rows = zip(batch.column("rep").to_pylist(), batch.column("component").to_pylist(), batch.column("hashes"), strict=True)
            for block, (rep, component, packed) in zip(keys, rows, strict=True):
                if block != now:
                    if now is not None:
                        yield _block_links(reps, ties, held, t)
                    now, reps, ties, held = block, [], [], []
                reps.append(rep)
                ties.append(component)
                held.append(np.frombuffer(packed.as_py(), np.uint64))
        if now is not None:
            yield _block_links(reps, ties, held, t)

    return dealt.mapInArrow(compared, "a long, b long")


def _block_links(reps: list[int], ties: list[int], held: list[np.ndarray], t: Fraction) -> pa.RecordBatch:
    """Links (a, b) between the components of a block, one per set and component it reaches."""
    rep, component = np.array(reps, np.int64), np.array(ties, np.int64)
    size = np.array([len(h) for h in held], np.int64)
    shingle = np.concatenate(held)
    owner = np.repeat(np.arange(len(held)), size)
    order = np.argsort(shingle, kind="stable")
    shingle, owner = shingle[order], owner[order]
    names, counts = np.unique(component, return_counts=True)
    largest = names[np.argmax(counts)]  # its sets are reached from the others
    a, b = [], []
    for k in np.flatnonzero(component != largest):
        low, high = np.searchsorted(shingle, held[k], "left"), np.searchsorted(shingle, held[k], "right")
        spans = high - low
        ends = np.cumsum(spans)
        met = owner[np.arange(ends[-1]) - np.repeat(ends - spans - low, spans)]
        both = np.bincount(met, minlength=len(held))
        near = np.flatnonzero(_similar(both, size[k], size, t) & (component != component[k]))
        if len(near):
            _, one = np.unique(component[near], return_index=True)
            a += [int(rep[k])] * len(one)
            b += rep[near[one]].tolist()
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def minhash_dedup(
    docs: DataFrame, n: int = 4, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id, class_id, kept) per row of ``docs``.

    Words are runs of characters other than space and 0x09 to 0x0D, with A-Z lower-cased; a text
    with fewer than ``n`` words is one shingle. ``class_id``: the smallest id with the same set; ``component_id``: the smallest
    id reachable over links, itself included; ``kept``: the row's id is its component's.

    Null, empty and blank texts have no shingles, are linked with nothing and kept. A row without id is linked with
    nothing, has null ids and is kept. Repeated rows come back as often as they came; the texts of an id
    that has several are linked with one another. An empty table gives no row. Ids must be integers; other columns are not looked at,
    whatever their names.
    """
    t = Fraction(str(threshold))
    prepare(docs.sparkSession)
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    described = table(signed(docs, n), "signed").withColumn("rep", F.when(F.col("n_shingles") > 0, F.xxhash64(*SET_KEY)))
    filled = described.where("rep IS NOT NULL AND doc_id IS NOT NULL")
    classes = table(filled.groupBy("rep").agg(F.min("doc_id").alias("class_id")), "classes")

    # Buckets with several sets.
    one_each = classes.withColumnRenamed("class_id", "doc_id")
    named = filled.select("rep", "doc_id", "n_shingles", "bands").join(one_each, ["rep", "doc_id"], "leftsemi")
    rows = named.select("rep", "n_shingles", F.explode("bands").alias("bucket")).distinct()
    shared = rows.groupBy("bucket").agg(F.count("*").alias("sets")).where("sets > 1").select("bucket")
    rows = table(rows.join(shared, "bucket", "leftsemi"), "buckets")
    buckets = rows
    rows = rows.withColumn("component", F.col("rep"))
    sets = table(full_sets(docs, rows.select("rep").distinct().join(one_each, "rep"), n), "sets")

    # The texts of an id are linked; so are sets that two rounds of stars find similar.
    several = filled.select("doc_id", "rep").distinct()
    several = several.join(several.groupBy("doc_id").agg(F.count("*").alias("c"), F.min("rep").alias("b")).where("c > 1"), "doc_id")
    links = table(several.select(F.col("rep").alias("a"), "b"), "linked")
    tried = None
    for salt in (F.lit(0), F.col("bucket")):
        pairs = _stars(rows, salt, t)
        pairs = table(pairs if tried is None else pairs.join(tried, ["a", "b"], "leftanti"), "stars")
        tried = pairs
        links = table(links.unionByName(_checked(pairs, sets, t)), "linked")
        rows = table(_mixed(rows, _state(rows, links)), "mixed")
    if not rows.isEmpty():
        links = table(links.unionByName(_rest(rows, sets, t)), "linked")

    reached = components(links).select(F.col("node").alias("rep"), "component")
    named = classes.join(reached, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    lowest = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
    named = table(named.join(lowest, "component").select("rep", "class_id", "component_id"), "named")
    release(buckets, sets, links, classes)
    # Rows without a set or an id are not looked for.
    ided = F.col("doc_id").isNotNull()
    looked = described.select("doc_id", "n_shingles", F.when(ided, F.col("rep")).alias("rep")).join(named, "rep", "left")
    component = F.when(ided, F.coalesce("component_id", "doc_id"))
    return looked.select(
        F.col("doc_id").alias(id_col),
        "n_shingles",
        component.alias("component_id"),
        F.when(ided, F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
