"""Helpers that several operators share: session, scratch tables, word and shingle hashes.

Words are hashed in numpy straight from Arrow's text buffer, so no Python object is made
per word. A word's hash is a polynomial over its bytes modulo 2**64, mixed at the end;
sets of words and shingles are compared by these 64-bit hashes.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir
from ..sources.tables import remove

#: Arrow batches sent to Python end at this size, so that memory follows it and not the
#: length of the texts (a single longer text is a batch of its own).
BATCH_BYTES = 4 << 20
#: Texts are hashed in blocks of about this many bytes.
BLOCK_BYTES = 1 << 20

# The characters that end a word (0x20 and 0x09 to 0x0D).
SPACES = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches of this session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new table in the shared folder and read it back: cuts the lineage."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored.scratch = path
    return stored


def release(*tables: DataFrame) -> None:
    """Delete tables of ``table`` that no later step reads, whoever's executors are lost."""
    for stored in tables:
        remove(stored.sparkSession, stored.scratch)


def counts_of(rows: DataFrame, size: int) -> np.ndarray:
    """The counts of ``rows`` (place, n), each place once, as an array of ``size``.

    Tasks pack their rows, so the driver gets bytes and makes no object or table of them.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [pa.array([c.to_numpy().astype(np.int64).tobytes()], pa.binary()) for c in batch.columns]
            yield pa.RecordBatch.from_arrays(both, ["place", "n"])

    total = np.zeros(size, np.int64)
    for place, n in rows.mapInArrow(packed, "place binary, n binary").collect():
        total[np.frombuffer(place, np.int64)] = np.frombuffer(n, np.int64)
    return total


def type_of(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """The texts, an empty one for null."""
    return [t or "" for t in column.to_pylist()]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix64 finalizer)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    inverse = pow(_BASE, -1, 1 << 64)
    up = np.full(n, _BASE, np.uint64)
    down = np.full(n, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def lower_table() -> np.ndarray:
    """Byte table that lower-cases A-Z and leaves the rest."""
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def space_table() -> np.ndarray:
    out = np.zeros(256, bool)
    out[SPACES] = True
    return out


def word_hashes(
    data: np.ndarray, starts: np.ndarray, lower: np.ndarray, space: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start bytes of the words in a block of concatenated texts.

    ``starts``: first byte of each text. ``lower`` and ``space``: byte tables that say what
    a byte counts as and which bytes part words.
    """
    if not data.size:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~space[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    first = starts[starts < data.size]
    opens[first] = inside[first]
    before = first[first > 0] - 1
    closes[before] = inside[before]
    begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    size = max(2 * BLOCK_BYTES, 1 << int(data.size).bit_length())
    up, down = _powers(size)
    total = np.zeros(data.size + 1, np.uint64)
    np.cumsum((lower[data].astype(np.uint64) + np.uint64(1)) * up[: data.size], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin]), begin


def blocks(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, start byte of each text) in blocks of about BLOCK_BYTES."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, "right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, stop, data[offsets[row] : offsets[stop]], offsets[row:stop] - offsets[row]
        row = stop


def words_by_text(
    column: pa.Array | pa.ChunkedArray, lower: np.ndarray, space: np.ndarray
) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of every text, in order."""
    for first, stop, data, starts in blocks(column):
        hashes, begin = word_hashes(data, starts, lower, space)
        cuts = np.searchsorted(begin, starts)
        ends = [*cuts[1:], len(begin)]
        for i in range(stop - first):
            yield first + i, hashes[cuts[i] : ends[i]]


# Odd multipliers for the place of a word in its shingle.
_PLACES = [np.uint64(k) for k in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]


def shingle_set(words: np.ndarray, n: int = 3) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; a shorter text is one shingle."""
    if not len(words):
        return np.zeros(0, np.uint64)
    width = min(n, len(words))
    total = np.full(len(words) - width + 1, np.uint64(width), np.uint64)
    for k in range(width):
        place = np.uint64(int(_PLACES[k % 3]) * (k // 3 * 2 + 1) & _MASK)
        total = total + words[k : len(words) - width + 1 + k] * place
    return np.unique(mix(total))
