"""Language-model scores from a subword lattice, next to a word-count base.

The model is a unigram model over the pieces of an existing public vocabulary: a text is
a sequence of pieces, each word beginning with a space, and one end. All segmentations of
a word count: the forward recursion over its lattice, in log space, gives the marginal
probability, and a text's is the product over its words and the end.

The vocabulary's own scores are merge ranks and no probabilities. They give the starting
weights (by Zipf's law); expectation maximisation over the lattices of all training words, weighted by
their counts, then fits the weights. Pieces are never added.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, table, type_of

#: Words with at least this share of all training tokens are known to every task: at most 2**20.
HEAD_WORDS = 1 << 20
#: Words that a task remembers, in each of two generations.
MEMORY = 300_000
#: Partial counts that a task holds before it passes them on.
PARTIAL = 500_000
#: Longer words are fitted in slices, and scored one by one.
LONG = 256
ROUNDS = 3
#: Weight of the starting distribution, in pieces.
PRIOR = 1000.0

_BASE = 0x9E3779B97F4A7C15 | 1
_LN10 = math.log(10)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words; bytes.split and lower know ASCII only."""
    return (text or "").encode().lower().split()


def start_weights(model_path: str) -> dict[bytes, float]:
    """Pieces that lower-cased words can hold, with starting weights; a space stands for a word's begin.

    All single bytes are among them, so that every word has a segmentation.
    """
    from sentencepiece import SentencePieceProcessor

    vocabulary = SentencePieceProcessor(model_file=model_path)
    weights: dict[bytes, float] = {}
    for k in range(vocabulary.get_piece_size()):
        if vocabulary.is_control(k) or vocabulary.is_unknown(k) or vocabulary.is_unused(k):
            continue
        if vocabulary.is_byte(k):
            piece = bytes([int(vocabulary.id_to_piece(k)[3:5], 16)])
            weights[piece] = weights.get(piece, 0.0) + 1e-5
            continue
        piece = vocabulary.id_to_piece(k).replace("▁", " ").encode()
        if b" " not in piece[1:] and piece == piece.lower() and len(piece.split()) == bool(piece.strip()):
            weights[piece] = weights.get(piece, 0.0) + 1 / (10 - vocabulary.get_score(k))
    for b in range(256):
        weights.setdefault(bytes([b]), 1e-6)
    total = sum(weights.values())
    return {piece: w / total for piece, w in sorted(weights.items())}


@dataclass
class Lattice:
    """Piece weights, and lookup of pieces and of their beginnings by hash."""

    pieces: list[bytes]
    log_weight: np.ndarray
    log_end: float

    def __getstate__(self):
        return self.pieces, self.log_weight, self.log_end

    def __setstate__(self, state):
        self.pieces, self.log_weight, self.log_end = state

    @cached_property
    def powers(self) -> np.ndarray:
        out = np.full(max(map(len, self.pieces)), _BASE, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    @cached_property
    def index(self) -> dict[bytes, int]:
        """Each piece's number; -1 for what is only the beginning of pieces."""
        found = {piece[:k]: -1 for piece in self.pieces for k in range(1, len(piece))}
        return found | {piece: k for k, piece in enumerate(self.pieces)}

    @cached_property
    def hashed(self) -> tuple[np.ndarray, np.ndarray]:
        keys = np.array(
            [((np.frombuffer(b, np.uint8).astype(np.uint64) + np.uint64(1)) * self.powers[: len(b)]).sum() for b in self.index],
            np.uint64,
        )
        order = np.argsort(keys)
        return keys[order], np.array(list(self.index.values()))[order]

    def forward(self, block: np.ndarray) -> tuple[np.ndarray, list]:
        """Log weight of reaching each place of words of one length, and the arcs (from, length, rows, pieces)."""
        n, size = block.shape
        keys, numbers = self.hashed
        reach = np.full((size + 1, n), -np.inf)
        reach[0] = 0
        arcs = []
        for i in range(size):
            rows, h = np.arange(n), np.zeros(n, np.uint64)
            for m in range(1, min(len(self.powers), size - i) + 1):
                h = h + (block[rows, i + m - 1].astype(np.uint64) + np.uint64(1)) * self.powers[m - 1]
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[at] == h
                rows, h, number = rows[hit], h[hit], numbers[at[hit]]
                if not len(rows):
                    break
                whole = number >= 0
                on, piece = rows[whole], number[whole]
                reach[i + m, on] = np.logaddexp(reach[i + m, on], reach[i, on] + self.log_weight[piece])
                arcs.append((i, m, on, piece))
        return reach, arcs

    def _long(self, word: bytes) -> float:
        """The same for one long word, with a window of places."""
        index, weight, longest = self.index, self.log_weight, len(self.powers)
        reach = [-math.inf] * (len(word) + 1)
        reach[0] = 0.0
        for i in range(len(word)):
            for m in range(1, min(longest, len(word) - i) + 1):
                number = index.get(word[i : i + m])
                if number is None:
                    break
                if number >= 0:
                    a, b = reach[i + m], reach[i] + weight[number]
                    top = max(a, b)
                    reach[i + m] = top + math.log1p(math.exp(min(a, b) - top)) if min(a, b) > -math.inf else top
        return reach[-1]

    def log10(self, words: list[bytes]) -> np.ndarray:
        """Marginal log10 probability of each word, its leading space included."""
        found = np.zeros(len(words))
        for rows, block in _by_length([b" " + w for w in words], range(LONG + 1)):
            found[rows] = self.forward(block)[0][-1]
        for k, word in enumerate(words):
            if len(word) >= LONG:
                found[k] = self._long(b" " + word)
        return found / _LN10

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """Expected number of each piece in words that occur ``counts`` times."""
        total = np.zeros(len(self.pieces))
        parts, weights = [], []
        for word, count in zip(words, counts, strict=True):
            word = b" " + word
            cut = [word[k : k + LONG] for k in range(0, len(word), LONG)]
            parts += cut
            weights += [count] * len(cut)
        weights = np.array(weights, float)
        for rows, block in _by_length(parts, range(LONG + 1)):
            reach, arcs = self.forward(block)
            rest = np.full(reach.shape, -np.inf)
            rest[-1] = 0
            for i, m, on, piece in reversed(arcs):
                after = self.log_weight[piece] + rest[i + m, on]
                share = np.exp(reach[i, on] + after - reach[-1, on]) * weights[rows[on]]
                total += np.bincount(piece, share, len(total))
                rest[i, on] = np.logaddexp(rest[i, on], after)
        return total


def _by_length(words: list[bytes], lengths: range, most: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, byte matrix) of the words of each length, of bounded size."""
    size = np.array([len(w) for w in words])
    for length in np.unique(size):
        if length in lengths:
            places = np.flatnonzero(size == length)
            step = max(1, most // int(length))
            for k in range(0, len(places), step):
                part = places[k : k + step]
                data = b"".join(words[p] for p in part)
                yield part, np.frombuffer(data, np.uint8).reshape(len(part), length)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over all rows of ``texts`` (text)."""

    def batch_of(counts: Counter) -> pa.RecordBatch:
        words = pa.array(list(counts), pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(words_of(text))
                if len(counts) >= PARTIAL:
                    yield batch_of(counts)
                    counts = Counter()
        yield batch_of(counts)

    return texts.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def fit(counts: DataFrame, n_texts: int, start: dict[bytes, float], rounds: int = ROUNDS) -> Lattice:
    """Piece weights after ``rounds`` of expectation maximisation over all counted words."""
    pieces, prior = list(start), np.array(list(start.values()))
    n_words = counts.agg(F.sum("n")).first()[0] or 0
    log_end = math.log((n_texts + 1) / (2 * n_words + n_texts + 2))
    lattice = Lattice(pieces, np.log(prior * (1 - math.exp(log_end))), log_end)
    for _ in range(rounds):

        def expected(batches: Iterator[pa.RecordBatch], lattice: Lattice = lattice) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(lattice.pieces))
            for batch in batches:
                words = batch.column("word").cast(pa.binary()).to_pylist()
                total += lattice.expected(words, batch.column("n").to_numpy())
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "n"])

        rows = counts.mapInArrow(expected, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n"))
        seen = PRIOR * prior
        for piece, n in rows.collect():  # at most as many rows as the vocabulary has pieces
            seen[piece] += n
        total = seen.sum() + n_texts + 1
        lattice = Lattice(pieces, np.log(seen / total), math.log((n_texts + 1) / total))
    return lattice


def held_out(id_col: str) -> Column:
    """The fold that is not learned from: crc32 of the id's text modulo 7 is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _scored(docs: DataFrame, lattice: Lattice, head: dict[bytes, int]) -> DataFrame:
    """Per text what a task knows alone, and the words it has to look up."""
    logs = {word: math.log10(n + 1) for word, n in head.items()}
    schema = (
        f"doc_id {type_of(docs, 'doc_id')}, held_out boolean, n_words long, head_known long, head_sum double, "
        "score double, words array<string>, times array<int>"
    )

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, float] = {}
        older: dict[bytes, float] = {}
        for batch in batches:
            if len(known) > MEMORY:
                known, older = {}, known
            texts = [words_of(t) for t in batch.column("text").to_pylist()]
            new = set(chain.from_iterable(texts)) - known.keys()
            known |= {w: older[w] for w in new & older.keys()}
            new = list(new - older.keys())
            known |= dict(zip(new, lattice.log10(new).tolist(), strict=True))
            columns: list[list] = [[], [], [], [], [], []]
            for words in texts:
                values = [logs.get(w, 0.0) for w in words]
                rest = Counter(w for w, v in zip(words, values, strict=True) if not v)
                row = (
                    len(words), len(words) - rest.total(), math.fsum(values),
                    math.fsum(map(known.__getitem__, words)) + lattice.log_end / _LN10,
                    [w.decode() for w in rest], list(rest.values()),
                )
                for column, value in zip(columns, row, strict=True):
                    column.append(value)
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.int32())]
            made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), *made],
                ["doc_id", "held_out", "n_words", "head_known", "head_sum", "score", "words", "times"],
            )

    return docs.select("doc_id", "held_out", "text").mapInArrow(scored, schema)


def lm_scores(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) per row of ``docs``.

    Tokens are the lower-cased words and one end. ``base_score`` adds one to the training
    counts of words; ``score`` is the lattice model's. Both are log10 probabilities of the
    text. Null texts are empty: only the end. Rows without id are learned from. Repeated rows
    come back, and count in training, as often as they come; other columns are not looked at.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held_out(id_col).alias("held_out"))
    training = docs.where(~F.col("held_out"))
    counts = table(word_counts(training.select("text")), "words")
    n_words, n_distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_texts = training.count()
    n_tokens, distinct = n_words + n_texts, n_distinct + bool(n_texts)

    lattice = fit(counts, n_texts, start_weights(model_path))
    # No more than HEAD_WORDS words can have this count.
    common = counts.where(F.col("n") >= max(1, n_words / HEAD_WORDS)) if n_words > HEAD_WORDS else counts
    head = {r.word.encode(): r.n for r in common.collect()}
    rows = table(_scored(docs, lattice, head).withColumn("row", F.monotonically_increasing_id()), "scored")

    asked = rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("w"))
    asked = asked.select("row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    found = asked.join(counts, "word").groupBy("row").agg(
        F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs")
    )
    base = (
        F.col("head_sum") + F.coalesce("logs", F.lit(0.0)) + math.log10(n_texts + 1)
        - (F.col("n_words") + 1) * math.log10(n_tokens + distinct + 1)
    )
    known = F.col("head_known") + F.coalesce("known", F.lit(0)) + int(n_texts > 0)
    return rows.drop("words", "times").join(found, "row", "left").select(
        F.col("doc_id").alias(id_col), "held_out", (F.col("n_words") + 1).alias("n_tokens"), known.alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )
