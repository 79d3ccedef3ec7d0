"""N-gram Jaccard join of whole texts: rare-first prefixes, filters, one check per pair.

Sets are the distinct word shingles of a text, held as 64-bit hashes. Two sets of sizes m
and n reach similarity t only with an overlap of t / (1 + t) * (m + n), hence

* their sizes differ by less than t (length filter);
* when both are ordered alike, their prefixes of n - ceil(t * n) + 1 shingles share one;
* at a shared shingle, what comes before and after it must suffice (positional filter);
* counted over fixed parts of the hash space, the differences add up to no more than the
  symmetric difference allows (suffix filter; the parts are fixed ones of the whole set
  instead of halves found per pair, so that the counts can be stored with the set).

The order is rare first: by the frequency of the shingle's cell among 2**18 counted over
all documents, then by hash. Any order that all sets share finds every pair; counting
cells instead of shingles bounds the table that every task needs.

Texts with equal sets are one class, told by size and two independent sums of the hashes, and
only class representatives are joined. Sets that share a prefix shingle are compared in blocks of
bounded size, by size, up to the length limit; what passes the filters ties sets to groups, and a task reports a spanning forest of its
ties, not the pairs. A group is dealt into tiles, pairs of blocks of its sets, and these are joined in memory: first with the
prefixes alone, where the number of shared prefix shingles rules out most long texts and leaves small groups, then with the full
sets, where each pair that passes the filters is checked once. A tile returns sums of links and a spanning
forest, so a group of n near copies costs n * n checks (it has as many links) but never n * n rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import counts_of, mix, prepare, release, table
from .components import components, lowest_reachable
from .shingle_sets import SET_KEY, full_sets, sets_of, sums

CELLS = 1 << 18
PARTS = 64
#: Rows of one block when a large prefix group is compared pair by pair.
BLOCK_ROWS = 2048
#: Pairs that a task collects before it contracts them.
BUFFER = 1 << 19
#: Sets and shingles of one side of a tile of prefixes, and of a tile of sets.
PREFIX_SETS, PREFIX_SHINGLES = 4096, 1 << 23
TILE_SETS, TILE_SHINGLES = 1024, 1 << 20


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 18)).astype(np.int64)


def cell_frequencies(docs: DataFrame, n: int) -> np.ndarray:
    """Number of (text, shingle) pairs in each cell, over all texts."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for hashes in sets_of(batch.column(0), n):
                np.add.at(total, _cells(hashes), 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["cell", "n"])

    rows = docs.select("text").mapInArrow(counted, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    return counts_of(rows, CELLS)


def prefix_length(size: int, threshold: Fraction) -> int:
    return size - -(-size * threshold.numerator // threshold.denominator) + 1


def _rarest(hashes: np.ndarray, threshold: Fraction, frequencies: np.ndarray) -> np.ndarray:
    """The prefix of a set, rarest first."""
    order = np.argsort(frequencies[_cells(hashes)], kind="stable")  # hashes are sorted
    return hashes[order[: prefix_length(len(hashes), threshold)]].view(np.int64)


def _spread(hashes: np.ndarray) -> np.ndarray:
    counts = np.bincount((mix(hashes) >> np.uint64(58)).astype(np.int64), minlength=PARTS)
    return np.minimum(counts, 255).astype(np.uint8)


def describe(docs: DataFrame, n: int, threshold: Fraction, frequencies: np.ndarray) -> DataFrame:
    """(doc_id, n_shingles, sum1, sum2, prefix, parts) per text.

    ``prefix``: the rarest shingles in order, none where only an equal set could be
    similar. ``parts``: shingles in each part of the hash space, a byte each (at most
    255, which keeps the filter a lower bound).
    """
    # Below this size no other size is within the threshold.
    least = int(threshold / (1 - threshold))

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, sum1, sum2, prefixes, parts = [], [], [], [], []
            for hashes in sets_of(batch.column(1), n):
                size.append(len(hashes))
                a, b = sums(hashes)
                sum1.append(a)
                sum2.append(b)
                if len(hashes) < least:
                    prefixes.append(np.zeros(0, np.int64))
                    parts.append(b"")
                    continue
                prefixes.append(_rarest(hashes, threshold, frequencies))
                parts.append(_spread(hashes).tobytes())
            ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(size, pa.int64()),
                    pa.array(np.array(sum1, np.int64)), pa.array(np.array(sum2, np.int64)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), pa.array(parts, pa.binary()),
                ],
                ["doc_id", "n_shingles", "sum1", "sum2", "prefix", "parts"],
            )

    schema = "doc_id long, n_shingles long, sum1 long, sum2 long, prefix array<long>, parts binary"
    return docs.mapInArrow(described, schema)


def _ties(rows: DataFrame, t: Fraction) -> DataFrame:
    """Links (a, b) that connect the same sets as all the pairs that share a prefix shingle and pass all filters.

    ``rows``: (token, rep, n_shingles, place, group_rows, parts). A group of many rows is dealt into blocks,
    and each pair of blocks is compared by itself, so what has to be held at once is bounded. The 64 bytes of parts
    travel with the rows: in a large group, pairs would need them far more often.
    """
    n_blocks = F.ceil(F.col("group_rows") / BLOCK_ROWS)
    own, other = F.pmod(F.xxhash64("rep"), n_blocks), F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1))
    dealt = rows.withColumn("own", own).withColumn("other", other)
    dealt = dealt.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    key = ["token", "low", "high"]
    dealt = dealt.select(*key, "rep", "n_shingles", "place", "own", "parts")
    dealt = dealt.repartition(*key).sortWithinPartitions(*key, "n_shingles")

    def whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
        held: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            group = _group_numbers(held)
            last = int(np.searchsorted(group, group[-1]))  # it may go on in the next batch
            yield held[:last], group[:last]
            held = held[last:].combine_chunks()
        if held is not None:
            yield held, _group_numbers(held)

    def tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        size = 0
        for rows, group in whole_groups(batches):
            if not len(group):
                continue
            rep, n, place, own, low, high = (
                rows.column(c).to_numpy().astype(np.int64) for c in ("rep", "n_shingles", "place", "own", "low", "high")
            )
            parts = _parts(rows.column("parts").to_pylist())
            for x, y in _pairs_of(group, n, place, np.where(low == high, -1, own), parts, t):
                a, b = np.concatenate([a, rep[x]]), np.concatenate([b, rep[y]])
                if len(a) >= size + BUFFER:
                    a, b = lowest_reachable(a, b)
                    size = len(a)
        if len(a):
            a, b = lowest_reachable(a, b)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return dealt.mapInArrow(tied, "a long, b long").distinct()


def _parts(column: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint8).reshape(-1, PARTS).astype(np.int16)


def _group_numbers(rows: pa.Table) -> np.ndarray:
    """0, 1, ... for the runs of equal (token, low, high)."""
    key = np.stack([rows.column(k).to_numpy() for k in ("token", "low", "high")])
    return np.concatenate([[0], np.cumsum((key[:, 1:] != key[:, :-1]).any(axis=0))])


def _meetings(group: np.ndarray, size: np.ndarray, side: np.ndarray, t: Fraction) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of whole groups in order of size that pass the length filter: each row with the next of its group, the next but one, and so on.

    Rows of the same ``side`` are not paired, unless it is -1.
    """
    left = np.arange(len(group))
    for step in range(1, len(group)):
        left = left[left + step < len(group)]
        # Later rows are no smaller: beyond the length limit there is nothing more for a row.
        left = left[(group[left] == group[left + step]) & (size[left] * t.denominator >= size[left + step] * t.numerator)]
        if not len(left):
            return
        apart = (side[left] < 0) | (side[left] != side[left + step])
        yield left[apart], left[apart] + step


def _need(m: np.ndarray, n: np.ndarray, t: Fraction) -> np.ndarray:
    """The least overlap with which sizes m and n are similar."""
    return -(-(m + n) * t.numerator // (t.numerator + t.denominator))


def _parts_allow(a: np.ndarray, b: np.ndarray, size: np.ndarray, parts: np.ndarray, t: Fraction) -> np.ndarray:
    """Suffix filter: do the part counts leave room for a similar pair?"""
    room = size[a] + size[b] - 2 * _need(size[a], size[b], t)
    keep = np.zeros(len(a), bool)
    for k in range(0, len(a), 1 << 16):  # the differences of all pairs at once would be large
        some = slice(k, k + (1 << 16))
        keep[some] = np.abs(parts[a[some]] - parts[b[some]]).sum(axis=1) <= room[some]
    return keep


def _pairs_of(
    group: np.ndarray, size: np.ndarray, place: np.ndarray, side: np.ndarray, parts: np.ndarray, t: Fraction
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The meetings that pass the positional and the suffix filter."""
    for a, b in _meetings(group, size, side, t):
        m, n = size[a], size[b]
        reach = np.minimum(place[a], place[b]) + 1 + np.minimum(m - place[a] - 1, n - place[b] - 1)
        ok = reach >= _need(m, n, t)
        a, b = a[ok], b[ok]
        keep = _parts_allow(a, b, size, parts, t)
        if keep.any():
            yield a[keep], b[keep]


def _tile_pairs(
    prefixes: list[np.ndarray], size: np.ndarray, side: np.ndarray, parts: np.ndarray, t: Fraction, frequencies: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile's sets that pass all filters, each once.

    Up to the last shingle of the prefix that ends first, both sets are known, so the number of shared prefix shingles and what the
    other prefix's set has left bound the overlap.
    """
    length = np.array([len(p) for p in prefixes], np.int64)
    token, owner = np.concatenate(prefixes), np.repeat(np.arange(len(prefixes)), length)
    order = np.lexsort((size[owner], token))
    token, owner = token[order], owner[order]
    group = np.concatenate([[0], np.cumsum(token[1:] != token[:-1])])
    # Rows and columns of the counts: the two blocks of the tile, or one block twice.
    second = (side == side.max()) & (side >= 0)
    at = np.where(second, np.cumsum(second) - 1, np.cumsum(~second) - 1)
    rows, columns = (np.flatnonzero(~second), np.flatnonzero(second)) if second.any() else (np.arange(len(size)),) * 2
    shared = np.zeros((len(rows), len(columns)), np.int32)
    for x, y in _meetings(group, size[owner], side[owner], t):
        a, b = owner[x], owner[y]
        swap = second[a] if second.any() else a > b
        np.add.at(shared, (at[np.where(swap, b, a)], at[np.where(swap, a, b)]), 1)
    a, b = np.nonzero(shared)
    count, a, b = shared[a, b], rows[a], columns[b]
    last = np.array([p[-1] if len(p) else 0 for p in prefixes], np.int64)
    end = np.empty(len(last), np.int64)
    end[np.lexsort((last.view(np.uint64), frequencies[_cells(last.view(np.uint64))]))] = np.arange(len(last))
    # Equal last shingles end together; either bound holds then.
    rest = np.where(end[a] <= end[b], (size - length)[a], (size - length)[b])
    ok = count + rest >= _need(size[a], size[b], t)
    a, b = a[ok], b[ok]
    keep = _parts_allow(a, b, size, parts, t)
    return a[keep], b[keep]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The prefixes of described texts as bytes."""
    for batch in batches:
        prefixes = [np.asarray(p, np.int64).tobytes() for p in batch.column("prefix").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("rep"), pa.array(prefixes, pa.binary()), batch.column("parts")], ["rep", "prefix", "parts"]
        )


def _dealt(ties: DataFrame, classes: DataFrame, most_sets: int, most_shingles: int) -> DataFrame:
    """(group, low, high, own, rep, n_shingles, n_docs): the sets of each tile.

    ``ties``: (a, b); ``classes``: (rep, n_shingles, n_docs). What the ties connect is a group, cut into blocks of bounded
    size; a tile is a pair of blocks.
    """
    groups = components(ties).select(F.col("node").alias("rep"), F.col("component").alias("group")).join(classes, "rep")
    blocks = F.greatest(F.ceil(F.count("*") / most_sets), F.ceil(F.sum("n_shingles") / most_shingles)).alias("n_blocks")
    dealt = groups.join(groups.groupBy("group").agg(blocks), "group").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("n_blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    tile = ["group", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")]
    return table(dealt.select(*tile, "own", "rep", "n_shingles", "n_docs"), "dealt")


def _by_tile(dealt: DataFrame, found, schema: str) -> DataFrame:
    """``found`` of every tile, a list of its rows without repeated ones."""
    ordered = dealt.repartition("group", "low", "high").sortWithinPartitions("group", "low", "high", "n_shingles", "rep")

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for row in range(batch.num_rows):
                one = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                tile = (one["group"], one["low"], one["high"])
                if tile != now:
                    yield from found(held)
                    now, held = tile, []
                if not held or held[-1]["rep"] != one["rep"]:
                    held.append(one)
        yield from found(held)

    return ordered.mapInArrow(tiles, schema)


def _sides(tile: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([s["n_shingles"] for s in tile], np.int64)
    within = tile[0]["low"] == tile[0]["high"]
    return size, np.array([-1 if within else s["own"] for s in tile], np.int64)


def _closer(tiles: DataFrame, t: Fraction, frequencies: np.ndarray) -> DataFrame:
    """Links (a, b) that connect the same sets as the pairs that pass all filters of whole prefixes.

    ``tiles``: as of ``_dealt``, with (prefix, parts), both binary.
    """

    def found(tile: list[dict]) -> Iterator[pa.RecordBatch]:
        if len(tile) < 2:
            return
        size, side = _sides(tile)
        prefixes = [np.frombuffer(s["prefix"], np.int64) for s in tile]
        a, b = _tile_pairs(prefixes, size, side, _parts([s["parts"] for s in tile]), t, frequencies)
        rep = np.array([s["rep"] for s in tile], np.int64)
        a, b = lowest_reachable(rep[a], rep[b])
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return _by_tile(tiles, found, "a long, b long").where("a <> b").distinct()


def _verified(tiles: DataFrame, t: Fraction, frequencies: np.ndarray, as_pairs: bool) -> DataFrame:
    """(a, b, near): the similar pairs (a, b, null), or what follows from them.

    That is, per tile, links (a, b, null) that connect the same sets, and (a, null, near): the ids of all sets
    similar to a. ``tiles``: as of ``_dealt``, with hashes.
    """

    def found(tile: list[dict]) -> Iterator[pa.RecordBatch]:
        if len(tile) < 2:
            return
        size, side = _sides(tile)
        sets = [np.frombuffer(s["hashes"], np.uint64) for s in tile]
        prefixes = [_rarest(h, t, frequencies) for h in sets]
        linked = []
        pairs = _tile_pairs(prefixes, size, side, np.stack([_spread(h) for h in sets]).astype(np.int16), t, frequencies)
        for a, b in zip(*(ends.tolist() for ends in pairs), strict=True):
            x, y = (sets[a], sets[b]) if size[a] <= size[b] else (sets[b], sets[a])
            both = np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x)
            if both * t.denominator >= (len(x) + len(y) - both) * t.numerator:
                linked.append((a, b))
        if linked:
            rep, weight = (np.array([s[c] for s in tile], np.int64) for c in ("rep", "n_docs"))
            yield _pair_rows(rep, *np.array(linked).T) if as_pairs else _sum_rows(rep, weight, *np.array(linked).T)

    return _by_tile(tiles, found, "a long, b long, near long")


def _pair_rows(rep: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(rep[a]), pa.array(rep[b]), pa.nulls(len(a), pa.int64())], ["a", "b", "near"])


def _sum_rows(rep: np.ndarray, weight: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    near = np.zeros(len(rep), np.int64)
    np.add.at(near, a, weight[b])
    np.add.at(near, b, weight[a])
    some = np.flatnonzero(near)
    node, low = lowest_reachable(rep[a], rep[b])
    tied = np.flatnonzero(node != low)
    rows = [
        np.concatenate([node[tied], rep[some]]).tolist(),
        [*low[tied].tolist(), *[None] * len(some)],
        [*[None] * len(tied), *near[some].tolist()],
    ]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in rows], ["a", "b", "near"])


def _joined(docs: DataFrame, n: int, t: Fraction, as_pairs: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts (doc_id, n_shingles, rep), classes (rep, class_id, n_docs), and what ``_verified`` found.

    ``docs``: (doc_id, text). ``rep`` is a hash of the set's key, null without shingles.
    """
    frequencies = cell_frequencies(docs, n)
    described = table(describe(docs, n, t, frequencies), "shingled")
    described = described.withColumn("rep", F.when(F.col("n_shingles") > 0, F.xxhash64(*SET_KEY)))
    filled = described.where("rep IS NOT NULL AND doc_id IS NOT NULL")
    ids = filled.groupBy("rep", "doc_id").agg(F.min("n_shingles").alias("n_shingles"))
    classes = ids.groupBy("rep").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("n_docs"), F.min("n_shingles").alias("n_shingles")
    )
    classes = table(classes, "classes")

    # Prefix groups of at least two sets. A row that is repeated joins more than once, which does no harm.
    one_each = classes.select("rep", F.col("class_id").alias("doc_id"))
    reps = filled.where(F.size("prefix") > 0).join(one_each, ["rep", "doc_id"], "leftsemi")
    tokens = reps.select("rep", "n_shingles", F.posexplode("prefix").alias("place", "token"))
    groups = tokens.groupBy("token").agg(F.count("*").alias("group_rows")).where("group_rows > 1")
    rows = table(tokens.join(groups, "token"), "prefixes")
    ties = table(_ties(rows.join(reps.select("rep", "parts").dropDuplicates(["rep"]), "rep"), t), "ties")
    release(rows)

    # Sets that are tied by whole prefixes, then by whole sets.
    tied = _dealt(ties, classes.drop("class_id"), PREFIX_SETS, PREFIX_SHINGLES)
    pack = reps.select("rep", "prefix", "parts").mapInArrow(_packed, "rep long, prefix binary, parts binary")
    closer = table(_closer(tied.join(pack, "rep"), t, frequencies), "closer")
    dealt = _dealt(closer, classes.drop("class_id"), TILE_SETS, TILE_SHINGLES)
    wanted = dealt.select("rep").distinct().join(one_each, "rep")
    sets = table(full_sets(docs, wanted, n), "sets")
    found = table(_verified(dealt.join(sets, "rep"), t, frequencies, as_pairs), "linked")
    release(ties, tied, closer, dealt, sets)
    return described.select("doc_id", "n_shingles", "rep"), classes, found


def similar_pairs(
    docs: DataFrame, n: int = 3, threshold: float = 0.9, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(a, b, a_docs, b_docs) per pair of similar classes of different sets: their class ids and numbers of ids.

    With ``class_id`` of ``ngram_jaccard_join`` as membership these are all links.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    _, classes, pairs = _joined(docs, n, Fraction(str(threshold)), as_pairs=True)
    a, b = (classes.select(F.col("rep").alias(s), F.col("class_id").alias(f"{s}_id"), F.col("n_docs").alias(f"{s}_docs")) for s in "ab")
    named = pairs.select("a", "b").join(a, "a").join(b, "b")
    return named.select(F.col("a_id").alias("a"), F.col("b_id").alias("b"), "a_docs", "b_docs")


def ngram_jaccard_join(
    docs: DataFrame, n: int = 3, threshold: float = 0.9, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id, class_id, n_links) per row of ``docs``.

    Words are runs of characters other than space and 0x09 to 0x0D, with A-Z lower-cased; a
    text with fewer than ``n`` words is one shingle. ``class_id``: the smallest id with the
    same set; ``component_id``: the smallest id reachable over links, itself included; ``n_links``: the other ids
    with the same or a similar set.

    Null, empty and blank texts have no shingles and are linked with nothing. A row
    without id is linked with nothing and has null ids. Repeated rows come back as often as
    they came; an id with several texts is linked when one of them is, and counts once for each of its sets.
    An empty table gives no row. Ids must be integers; other columns are not looked at, whatever their names.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    described, classes, found = _joined(docs, n, Fraction(str(threshold)), as_pairs=False)

    several = described.where("rep IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "rep").distinct()
    texts = several.groupBy("doc_id").agg(F.count("*").alias("texts"), F.min("rep").alias("b")).where("texts > 1")
    same_id = several.join(texts, "doc_id").select(F.col("rep").alias("a"), "b")
    links = found.where("b IS NOT NULL").select("a", "b").unionByName(same_id)
    reached = components(links).select(F.col("node").alias("rep"), "component")
    near = found.where("near IS NOT NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("near").alias("near"))
    named = classes.join(reached, "rep", "left").join(near, "rep", "left")
    named = named.withColumn("component", F.coalesce("component", "rep"))
    lowest = named.groupBy("component").agg(F.min("class_id").alias("component_id"))
    n_links = (F.col("n_docs") - 1 + F.coalesce("near", F.lit(0))).alias("n_links")
    named = table(named.join(lowest, "component").select("rep", "class_id", "component_id", n_links), "named")
    release(classes, found)

    # Rows without a set or an id are not looked for.
    ided = F.col("doc_id").isNotNull()
    looked = described.withColumn("rep", F.when(ided, F.col("rep"))).join(named, "rep", "left")
    return looked.select(
        F.col("doc_id").alias(id_col),
        "n_shingles",
        F.when(ided, F.coalesce("component_id", "doc_id")).alias("component_id"),
        F.when(ided, F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )
