"""Quality scores by nearest-neighbour voting in a latent space.

A text is described by counts of its byte trigrams (hashed), of trigrams of character
classes and of how often its trigrams repeat for its length; counts are damped, weighted by
rarity over all texts and projected by the leading singular vectors of a bounded labelled sample.
Labelled vectors go to every task, each text is compared with all of them in blocks, and
the nearest vote with their similarity as weight.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import blocks, prepare, type_of

TRIGRAMS = 2048
CLASSES = 10
LENGTHS, REPEATS = 20, 40
#: Count that the one length-and-repetition feature of a text gets.
REPEAT_WEIGHT = 20
SIZE = TRIGRAMS + CLASSES**3 + LENGTHS * REPEATS
#: Texts that are described together.
CHUNK = 128

# Characters of classes 5 (pauses), 6 (stops) and 7 (symbols). Capitals, small letters,
# digits, spaces, line breaks are 0 to 4, bytes beyond ASCII 8 and the rest 9.
_PAUSES, _STOPS, _SYMBOLS = b".,;:", b"!?", b"#*$%&|@=+~^_<>\\/"


def _class_table() -> np.ndarray:
    out = np.full(256, 9, np.int64)
    out[65:91], out[97:123], out[48:58], out[32], out[10], out[128:] = 0, 1, 2, 3, 4, 8
    for code, group in ((5, _PAUSES), (6, _STOPS), (7, _SYMBOLS)):
        out[list(group)] = code
    return out


_CLASS = _class_table()


def describe(data: np.ndarray) -> np.ndarray:
    """Feature counts of one text given as bytes; all zero below three bytes."""
    out = np.zeros(SIZE, np.float32)
    # In slices, so that a very long text needs no long arrays.
    for at in range(0, len(data) - 2, 1 << 20):
        part = data[at : at + (1 << 20) + 2].astype(np.int64)
        code = part[:-2] << 16 | part[1:-1] << 8 | part[2:]
        out[:TRIGRAMS] += np.bincount((code * 2654435761 >> 9) & (TRIGRAMS - 1), minlength=TRIGRAMS)
        kind = _CLASS[part]
        code = (kind[:-2] * CLASSES + kind[1:-1]) * CLASSES + kind[2:]
        out[TRIGRAMS : TRIGRAMS + CLASSES**3] += np.bincount(code, minlength=CLASSES**3)
    if len(data) > 2:
        variety = math.log(np.count_nonzero(out[:TRIGRAMS])) / math.log(len(data) + 1)
        place = min(LENGTHS - 1, int(math.log2(len(data)))) * REPEATS + min(REPEATS - 1, int(variety * REPEATS))
        out[TRIGRAMS + CLASSES**3 + place] = REPEAT_WEIGHT
    return out


def _described(column: pa.Array) -> Iterator[np.ndarray]:
    """Feature rows of the texts, CHUNK at a time."""
    for at in range(0, len(column), CHUNK):
        rows = []
        for first, stop, data, starts in blocks(column[at : at + CHUNK]):
            ends = [*starts[1:], len(data)]
            rows += [describe(data[starts[i] : ends[i]]) for i in range(stop - first)]
        yield np.stack(rows)


def _packed(row: np.ndarray) -> bytes:
    """Places and values of what isn't zero."""
    used = np.flatnonzero(row)
    return used.astype(np.uint16).tobytes() + row[used].tobytes()


def _unpack(data: bytes, into: np.ndarray) -> None:
    n = len(data) // 6
    into[np.frombuffer(data, np.uint16, n)] = np.frombuffer(data[2 * n :], np.float32)


@dataclass(frozen=True)
class Model:
    """Everything a task needs; its size depends on the parameters only."""

    rarity: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int
    power: float

    def project(self, rows: np.ndarray) -> np.ndarray:
        """Unit vectors in the latent space; zero for texts without features."""
        latent = (np.log1p(rows) * self.rarity) @ self.axes
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def score(self, rows: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(rows), self.prior)
        near = self.project(rows) @ self.vectors.T
        k = min(self.neighbours, len(self.labels))
        top = np.argpartition(-near, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(near, top, 1), 0).astype(np.float64) ** self.power
        total = weight.sum(axis=1)
        voted = (weight * self.labels[top]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.where(total > 0, voted, self.prior)


def text_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Number of texts with each feature, and of texts, over all of ``docs`` (text)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE + 1, np.int64)
        for batch in batches:
            for rows in _described(batch.column(0)):
                total[:SIZE] += (rows > 0).sum(axis=0)
                total[SIZE] += len(rows)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["feature", "n"])

    rows = docs.mapInArrow(counted, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    found = np.zeros(SIZE + 1, np.int64)
    for feature, n in rows.collect():  # at most SIZE + 1 rows
        found[feature] = n
    return found[:SIZE], int(found[SIZE])


def leading_axes(matrix: np.ndarray, dims: int, rounds: int = 4) -> np.ndarray:
    """The leading right singular vectors, as columns, by randomised subspace iteration."""
    rng = np.random.default_rng(0)
    basis = rng.standard_normal((matrix.shape[1], min(dims + 16, *matrix.shape))).astype(np.float32)
    for _ in range(rounds):
        basis, _ = np.linalg.qr(matrix.T @ (matrix @ basis))
    _, _, turn = np.linalg.svd(matrix @ basis, full_matrices=False)
    return np.ascontiguousarray(basis @ turn[:dims].T)


def fit(
    docs: DataFrame, labels: DataFrame, sample: int = 4000, dims: int = 64, neighbours: int = 15, power: float = 4.0,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
) -> Model:
    """Learn from at most ``sample`` labelled rows, the first by a hash of their id.

    ``labels`` holds (id, label 0 or 1), already without rows that must not be learned
    from; null labels, ids and texts are left out. Of ids with several labels the least
    counts. The sample is the only bound: rarities are counted over all texts.
    """
    prepare(docs.sparkSession)
    counts, n_texts = text_frequencies(docs.select(F.col(text_col).alias("text")))
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).cast("double").alias("label"))
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    order = [F.xxhash64("id"), F.col("id")]
    chosen = texts.select("id").distinct().join(known, "id").orderBy(*order).limit(sample)
    chosen = F.broadcast(chosen)  # at most ``sample`` rows

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_packed(r) for part in _described(batch.column("text")) for r in part]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(rows, pa.binary())], ["id", "label", "row"]
            )

    columns = texts.join(chosen, "id").select("id", "label", "text")
    rows = columns.mapInArrow(described, f"id {type_of(columns, 'id')}, label double, row binary")
    # Repeated rows of one document count once.
    found = rows.groupBy("id").agg(F.min("label").alias("label"), F.min("row").alias("row")).orderBy(*order).collect()

    rarity = np.log((1 + n_texts) / (1 + counts)).astype(np.float32)
    if not found:
        empty = np.zeros((0, 1), np.float32)
        return Model(rarity, np.zeros((SIZE, 1), np.float32), empty, np.zeros(0), 0.5, neighbours, power)
    # One matrix of sample x SIZE, changed in place: the driver holds no copy of it.
    matrix = np.zeros((len(found), SIZE), np.float32)
    for line, r in zip(matrix, found, strict=True):
        _unpack(r.row, line)
    labelled = np.array([r.label for r in found])
    del found
    np.log1p(matrix, out=matrix)
    matrix *= rarity
    matrix /= np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-9)
    axes = leading_axes(matrix, min(dims, *matrix.shape))
    vectors = matrix @ axes
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return Model(rarity, axes, vectors, labelled, float(labelled.mean()), neighbours, power)


def score(docs: DataFrame, model: Model, threshold: float = 0.7, text_col: str = "text") -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 from ``threshold`` on); older columns of these names go.

    Null texts are empty. A text without features, or without a similar labelled text,
    gets the share of label 1 in the sample, 0.5 without a sample. Rows are independent.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.drop("score", "predicted")
    shared = spark.sparkContext.broadcast(model)  # some MB, by the parameters

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            parts = [model.score(rows) for rows in _described(batch.column(text_col))]
            found = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                [*batch.schema.names, "score", "predicted"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(scored, f"{schema}, score double, predicted int")


def held_out(id_col: str) -> Column:
    """The fold that is never learned from: crc32 of the id's text modulo 4 is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """``docs`` scored by a model of the labels outside the held-out fold."""
    model = fit(docs, labels.where(~held_out("doc_id")).select("doc_id", "quality"))
    return score(docs, model, threshold)
