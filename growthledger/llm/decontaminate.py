"""Benchmark decontamination by latent semantic retrieval and subsequence checks.

Benchmark items are parted into passages. Passages are TF-IDF vectors over hashed words, with frequencies
counted over all documents, and a randomised SVD of each group of at most DIMS of them, run over Spark
(each round sums rows of A'(A Q) by group and feature), gives the group's latent space, which holds
all of its passages however many there are. A document is
looked at in windows of whole blocks of BLOCK words, as many as surely contain a passage of
a given length; a window is a candidate for the passages that are near by cosine and of which it holds as much
weight as any match does. Verbatim copies are candidates whatever the cosine. A
candidate counts when the longest common subsequence of words covers nearly all of the
passage, or much of it together with its answer, which is its last sentence: that is how
paraphrases are told from chance.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import counts_of, lower_table, mix, prepare, space_table, type_of, words_by_text

FEATURES = 1 << 16
BLOCK = 8
PASSAGE = 64
#: Passages that are looked for at once; more are looked for in several passes.
PASSAGES_AT_ONCE = 20_000
#: Axes of a latent space, and passages that share one.
DIMS = 64
SPARE_DIMS = 16
ROUNDS = 2
#: Latent spaces that are found together.
SPACES_AT_ONCE = 16
#: Words of the texts that are looked through together, and windows compared at once.
CHUNK_WORDS = 50_000
WINDOWS = 4096

LOWERED = "lower-cased text"  # a column while it works
LEAKS = "array<struct<item_id: bigint, similarity: double, overlap: double>>"


def _space() -> np.ndarray:
    """Words end at white space and ASCII punctuation, so that neither decides about a match."""
    out = space_table()
    out[:128] |= [not chr(b).isalnum() for b in range(128)]
    return out


def _words(column: pa.Array) -> Iterator[np.ndarray]:
    for _, words in words_by_text(column, lower_table(), _space()):
        yield words


def _features(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(48)).astype(np.int64)


@dataclass(frozen=True)
class Passage:
    item_id: int
    words: np.ndarray
    answer: int


def passages_of(item_id: int, text: str, min_words: int) -> list[Passage]:
    """Passages of at most PASSAGE words, alike in length; none for a shorter item than ``min_words``.

    ``answer``: words of the last sentence, if it is not all of the passage; only the last passage has it.
    """
    words = next(_words(pa.array([text])))
    if len(words) < min_words:
        return []
    parts = np.array_split(words, -(-len(words) // PASSAGE))
    sentences = [s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if s]
    last = len(next(_words(pa.array([sentences[-1]])))) if len(sentences) > 1 else 0
    answers = [0] * (len(parts) - 1) + [last if last < len(parts[-1]) else 0]
    return [Passage(item_id, p, a) for p, a in zip(parts, answers, strict=True)]


def rarities(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of each feature, over all of ``docs`` (text)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES + 1, np.int64)
        for batch in batches:
            for words in _words(batch.column(0)):
                total[np.unique(_features(words))] += 1
                total[FEATURES] += 1
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["feature", "n"])

    rows = docs.mapInArrow(counted, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    total = counts_of(rows, FEATURES + 1).astype(float)
    return np.log((1 + total[FEATURES]) / (1 + total[:FEATURES])) + 1e-3


def _signs(features: np.ndarray, width: int) -> np.ndarray:
    """Random signs, always the same for a feature."""
    return np.stack([np.random.default_rng(int(f)).integers(0, 2, width) * 2.0 - 1 for f in features])


def group_axes(passages: DataFrame, rarity: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(features, axes) by group: right singular vectors of a group's TF-IDF matrix, a row per used feature.

    ``passages``: (group, words). What is summed and collected is at most a row per group and feature.
    """
    width = DIMS + SPARE_DIMS
    columns = [f"c{k}" for k in range(width)]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, *rows = (c.to_numpy() for c in batch.columns)
            both = [key.astype(np.int64).tobytes(), np.stack(rows, axis=1).tobytes()]
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in both], ["keys", "images"])

    basis: tuple[np.ndarray, np.ndarray] | None = None  # sorted group * FEATURES + feature, and their rows
    for _ in range(ROUNDS + 1):

        def summed(batches: Iterator[pa.RecordBatch], basis: tuple | None = basis) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, images = [np.zeros(0, np.int64)], [np.zeros((0, width))]
                for group, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    used, times = np.unique(_features(np.frombuffer(words, np.uint64)), return_counts=True)
                    row = times * rarity[used]
                    row /= np.linalg.norm(row)
                    key = group * FEATURES + used
                    at = _signs(used, width) if basis is None else basis[1][np.searchsorted(basis[0], key)]
                    keys.append(key)
                    images.append(np.outer(row, row @ at))
                key, place = np.unique(np.concatenate(keys), return_inverse=True)
                total = np.zeros((len(key), width))
                np.add.at(total, place, np.concatenate(images))
                yield pa.RecordBatch.from_arrays([pa.array(key), *map(pa.array, total.T)], ["key", *columns])

        schema = "key long, " + ", ".join(f"{c} double" for c in columns)
        sums = passages.mapInArrow(summed, schema).groupBy("key").agg(*[F.sum(c).alias(c) for c in columns])
        found = sums.mapInArrow(packed, "keys binary, images binary").collect()
        keys = np.frombuffer(b"".join(r["keys"] for r in found), np.int64)
        order = np.argsort(keys)
        images = np.frombuffer(b"".join(r["images"] for r in found), np.float64).reshape(-1, width)[order]
        keys = keys[order]
        spaces, following = {}, np.zeros(images.shape)
        for group in np.unique(keys // FEATURES).tolist():
            mine = slice(*np.searchsorted(keys, [group * FEATURES, (group + 1) * FEATURES]))
            if basis is not None:
                last = basis[1][mine]
                values, turn = np.linalg.eigh(last.T @ images[mine])
                axes = last @ turn[:, ::-1][:, : min(DIMS, int((values > 1e-9).sum()))]
                spaces[group] = (keys[mine] % FEATURES, axes.astype(np.float32))
            square, _ = np.linalg.qr(images[mine])
            following[mine, : square.shape[1]] = square
        basis = keys, following
    return spaces


def latent_axes(items: DataFrame, rarity: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(features, axes) of one space for all ``items`` (item_id, text)."""

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
            words = [p.words.tobytes() for item_id, text in rows for p in passages_of(item_id, text or "", min_words)]
            columns = [pa.array([0] * len(words), pa.int64()), pa.array(words, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["group", "words"])

    spaces = group_axes(items.mapInArrow(parted, "group long, words binary"), rarity)
    return spaces.get(0, (np.zeros(0, np.int64), np.zeros((0, 1), np.float32)))


def _blocks(passage: Passage) -> int:
    """The number of blocks that surely contain the passage wherever it begins."""
    return (len(passage.words) + BLOCK - 2) // BLOCK + 1


Group = tuple[list[Passage], np.ndarray, np.ndarray]


def groups_of(spark: SparkSession, passages: list[Passage], rarity: np.ndarray) -> list[Group]:
    """The passages, alike in length, in groups of at most DIMS, each with its (features, axes)."""
    passages = sorted(passages, key=lambda p: (_blocks(p), p.item_id, p.words.tobytes()))
    groups = [passages[k : k + DIMS] for k in range(0, len(passages), DIMS)]
    found: list[Group] = []
    for k in range(0, len(groups), SPACES_AT_ONCE):
        some = groups[k : k + SPACES_AT_ONCE]
        rows = [(g, p.words.tobytes()) for g, group in enumerate(some) for p in group]
        group, words = zip(*rows, strict=True)
        # An Arrow table needs no Python workers on its way in.
        given = pa.table({"group": pa.array(group, pa.int64()), "words": pa.array(words, pa.binary())})
        spaces = group_axes(spark.createDataFrame(given), rarity)
        found += [(group, *spaces[g]) for g, group in enumerate(some)]
    return found


Best = list[dict[int, tuple[float, float]]]


class Chunk:
    """Texts that are looked through together, in blocks."""

    def __init__(self, texts: list[np.ndarray]):
        held = [(i, words) for i, words in enumerate(texts) if len(words)]
        self.texts = texts
        self.number = np.array([i for i, _ in held], np.int64)
        self.first = np.cumsum([0] + [len(words) for _, words in held])  # first word of each text, and the end
        self.words = np.concatenate([words for _, words in held]) if held else np.zeros(0, np.uint64)
        self.feature = _features(self.words)
        self.counts = np.array([-(-len(words) // BLOCK) for _, words in held], np.int64)
        before = np.cumsum(self.counts) - self.counts
        self.of_block = np.repeat(np.arange(len(held)), self.counts)
        self.inside = np.arange(len(self.of_block)) - before[self.of_block]
        size = np.diff(self.first)
        place = np.arange(len(self.words)) - np.repeat(self.first[:-1], size)
        # Each word's place among all blocks' first words, then all their second words, and so on.
        self.slot = place % BLOCK * len(self.of_block) + np.repeat(before, size) + place // BLOCK


class Verbatim:
    """Finds exact copies of passages by the hash of their first words."""

    def __init__(self, passages: list[Passage]):
        self.passages = passages
        self.width = min(len(p.words) for p in passages)
        heads = np.stack([p.words[: self.width] for p in passages])
        self.hashes, which = np.unique(self._hash(heads.T), return_inverse=True)
        order = np.argsort(which, kind="stable")
        self.of_hash = np.split(order, np.flatnonzero(np.diff(which[order])) + 1)
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    @staticmethod
    def _hash(columns) -> np.ndarray:
        total = np.uint64(0)
        for column in columns:
            total = total * np.uint64(0x9E3779B97F4A7C15) + column
        return mix(total)

    def look(self, chunk: Chunk, best: Best) -> None:
        n = len(chunk.words) - self.width + 1
        if n <= 0:
            return
        heads = self._hash([chunk.words[k : k + n] for k in range(self.width)])
        at = np.flatnonzero(self.seen[(heads >> np.uint64(48)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.hashes, heads[at]), len(self.hashes) - 1)
        same = self.hashes[place] == heads[at]
        at, place = at[same], place[same]
        text = np.searchsorted(chunk.first, at, "right") - 1
        for h in np.unique(place).tolist():
            mine = place == h
            starts, of = at[mine], text[mine]
            for k in self.of_hash[h].tolist():
                words = self.passages[k].words
                fits = starts + len(words) <= chunk.first[of + 1]
                found, where = starts[fits], of[fits]
                for j in range(len(words)):
                    equal = chunk.words[found + j] == words[j]
                    found, where = found[equal], where[equal]
                for t in np.unique(where).tolist():
                    best[chunk.number[t]][self.passages[k].item_id] = (1.0, 1.0)


class Searcher:
    """Finds the passages of one latent space in texts."""

    def __init__(
        self, passages: list[Passage], rarity: np.ndarray, features: np.ndarray, axes: np.ndarray,
        near: float, most: float, much: float,
    ):
        self.passages, self.near, self.most, self.much = passages, near, most, much
        # Words of no passage have the zero row 0.
        self.place = np.zeros(FEATURES, np.uint16)  # a group uses at most DIMS * PASSAGE features
        self.place[features] = np.arange(len(features)) + 1
        weighted = axes * rarity[features][:, None]
        self.rows = np.vstack([np.zeros((1, axes.shape[1])), weighted]).astype(np.float32)
        latent = np.stack([self.rows[self.place[_features(p.words)]].sum(axis=0) for p in passages])
        latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)
        self.masks: list[dict[int, int]] = []
        for p in passages:
            masks: dict[int, int] = {}
            for k, w in enumerate(p.words.tolist()):
                masks[w] = masks.get(w, 0) | 1 << k
            self.masks.append(masks)
        floor = np.array([self._floor(p, rarity) for p in passages], np.float32)
        blocks = np.array([_blocks(p) for p in passages])
        self.groups = [
            (int(n), np.flatnonzero(blocks == n), latent[blocks == n].T.copy(), floor[blocks == n])
            for n in np.unique(blocks)
        ]

    def _floor(self, passage: Passage, rarity: np.ndarray) -> float:
        """The least product of a window that matches the passage with the passage's unit vector.

        A match has a certain number of the passage's words; at the least they are its most frequent ones.
        """
        features = _features(passage.words)
        _, times = np.unique(features, return_counts=True)
        norm = np.linalg.norm(rarity[np.unique(features)] * times)
        least = self.most if len(features) < BLOCK else min(self.most, self.much)
        need = int(np.ceil(least * len(features) - 1e-9))
        return 0.99 * float(np.sort(rarity[features] ** 2)[:need].sum() / norm)

    def _block_sums(self, place: np.ndarray, chunk: Chunk) -> np.ndarray:
        """The sum of the words' rows in each block: its first words, its second words and so on are added at once."""
        n = len(chunk.of_block)
        words = np.zeros(BLOCK * n, np.intp)
        words[chunk.slot] = place
        words = words.reshape(BLOCK, n)
        sums = np.empty((n, self.rows.shape[1]), np.float32)
        more = np.empty((min(n, WINDOWS), self.rows.shape[1]), np.float32)
        for k in range(0, n, WINDOWS):
            part = sums[k : k + WINDOWS]
            np.take(self.rows, words[0, k : k + WINDOWS], axis=0, out=part, mode="clip")
            for j in range(1, BLOCK):
                part += np.take(self.rows, words[j, k : k + WINDOWS], axis=0, out=more[: len(part)], mode="clip")
        return sums

    def candidates(self, chunk: Chunk) -> Iterator[tuple[int, int, int, int, float]]:
        """(text, first word, end word, passage, similarity) of the windows that are near a passage."""
        if not len(chunk.words):
            return
        counts, of_block, inside = chunk.counts, chunk.of_block, chunk.inside
        place = self.place[chunk.feature]
        if not place.any():
            return
        # Running sums over the blocks, with room after each text for windows that reach past its end.
        room = max(n for n, _, _, _ in self.groups)
        begin = np.cumsum(counts + room) - counts - room
        at = begin[of_block] + inside
        latent = np.zeros((int(begin[-1] + counts[-1] + room) + 1, self.rows.shape[1]))
        latent[at + 1] = self._block_sums(place, chunk)
        np.cumsum(latent, axis=0, out=latent)
        for n, which, vectors, floor in self.groups:
            starts = np.flatnonzero((inside + n <= counts[of_block]) | (inside == 0))
            for k in range(0, len(starts), WINDOWS):
                some = starts[k : k + WINDOWS]
                low = at[some]
                window = (latent[low + n] - latent[low]).astype(np.float32)
                size = np.sqrt(np.einsum("ij,ij->i", window, window))
                # A product is at most the window's size.
                kept = np.flatnonzero(size >= floor.min())
                product = window[kept] @ vectors
                near = (product >= floor) & (product >= self.near * size[kept, None])
                for i, j in np.argwhere(near).tolist():
                    block = some[kept[i]]
                    first = int(inside[block]) * BLOCK
                    cosine = float(product[i, j] / size[kept[i]])
                    yield int(chunk.number[of_block[block]]), first, first + n * BLOCK, int(which[j]), cosine

    def overlap(self, words: list[int], k: int) -> tuple[float, float]:
        """Shares of passage ``k`` and of its answer in the longest common subsequence with ``words``."""
        masks, size, answer = self.masks[k], len(self.passages[k].words), self.passages[k].answer
        full = (1 << size) - 1
        state = full
        for w in words:
            mask = masks.get(w)
            if mask:
                both = state & mask
                state = ((state + both) | (state - both)) & full
        common = size - state.bit_count()
        if not answer:
            return common / size, 1.0
        question = size - answer
        before = question - (state & ((1 << question) - 1)).bit_count()
        return common / size, (common - before) / answer

    def look(self, chunk: Chunk, best: Best) -> None:
        """Adds the items found in each text, with their best match, to ``best``."""
        for text, first, end, k, similarity in self.candidates(chunk):
            item = self.passages[k].item_id
            if best[text].get(item) == (1.0, 1.0):
                continue
            share, answered = self.overlap(chunk.texts[text][first:end].tolist(), k)
            if share >= self.most or (share >= self.much and answered >= 0.5 and len(self.passages[k].words) >= BLOCK):
                best[text][item] = max(best[text].get(item, (0.0, 0.0)), (share, similarity))


def _leaks(texts: list[np.ndarray], searchers: list[Verbatim | Searcher]) -> list[list[dict]]:
    """The items found in each text, with their best match, by item."""
    best: Best = [{} for _ in texts]
    chunk = Chunk(texts)
    for searcher in searchers:
        searcher.look(chunk, best)
    return [[{"item_id": i, "similarity": s, "overlap": o} for i, (o, s) in sorted(b.items())] for b in best]


def _chunks(texts: Iterator[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Texts of about CHUNK_WORDS words together."""
    held: list[np.ndarray] = []
    size = 0
    for words in texts:
        held.append(words)
        size += len(words)
        if size >= CHUNK_WORDS:
            yield held
            held, size = [], 0
    yield held


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, near: float = 0.75, most: float = 0.9, much: float = 0.65,
    exact_under: int = 5, text_col: str = "text",
) -> DataFrame:
    """``docs`` with leaks: the benchmark items found in each text, an empty list if none.

    ``near``: cosine from which a window is checked; verbatim copies are found whatever it is. A passage is found when the common
    subsequence covers ``most`` of it, or ``much`` of it and half of its answer. Long
    items are found by any of their passages. Items of fewer than ``exact_under`` words are found where all their words follow each
    other, as with gaps between them most texts hold them. Items without id, null items and items without words
    are not looked for. Null texts are empty. Rows are independent; a column called leaks is replaced.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.drop("leaks")
    lowered = LOWERED
    while lowered in docs.columns:  # a column of the user's stays
        lowered += "_"
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text")).distinct()
    rarity = rarities(docs.select(F.lower(text_col).alias("text")))

    def looked_through(rows: DataFrame, part: DataFrame) -> DataFrame:
        """``rows`` with the leaks of a bounded part of the items added."""
        wanted = [p for r in part.collect() for p in passages_of(r.item_id, r.text, 1)]
        if not wanted:
            return rows
        short: dict[int, list[Passage]] = {}
        for p in wanted:
            if len(p.words) < exact_under:
                short.setdefault(len(p.words), []).append(p)
        longer = [p for p in wanted if len(p.words) >= exact_under]
        shared = spark.sparkContext.broadcast((list(short.values()), groups_of(spark, longer, rarity), rarity))
        names = rows.columns

        def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            short, groups, rarity = shared.value
            # Those of one length together, so that their hashes take in all of their words.
            exact = [*short, [p for group, _, _ in groups for p in group]]
            searchers: list[Verbatim | Searcher] = [Verbatim(passages) for passages in exact if passages]
            searchers += [Searcher(group, rarity, *space, near, most, much) for group, *space in groups]
            kind = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("overlap", pa.float64())]))
            for batch in batches:
                texts = _words(batch.column(names.index(lowered)))
                found = [leaks for chunk in _chunks(texts) for leaks in _leaks(chunk, searchers)]
                found = [a + b for a, b in zip(batch.column(names.index("leaks")).to_pylist(), found, strict=True)]
                columns = [pa.array(found, kind) if n == "leaks" else c for n, c in zip(names, batch.columns, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

        schema = ", ".join(f"`{n}` {type_of(rows, n)}" for n in names)
        return rows.mapInArrow(searched, schema)

    size = F.octet_length("text") / F.lit(2) / PASSAGE + 1  # at least the number of an item's passages
    parts = max(1, int((items.agg(F.coalesce(F.sum(size), F.lit(0.0))).first()[0]) // PASSAGES_AT_ONCE) + 1)
    found = docs.withColumns({lowered: F.lower(text_col), "leaks": F.expr(f"CAST(array() AS {LEAKS})")})
    for k in range(parts):
        found = looked_through(found, items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k))
    return found.drop(lowered)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows in which a benchmark item is found."""
    return find_leaks(docs, benchmark, **options).where(F.size("leaks") == 0).drop("leaks")
