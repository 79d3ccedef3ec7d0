"""Sets of word shingles: their hashes by text, what tells equal ones, and the full sets of chosen texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lower_table, mix, shingle_set, space_table, words_by_text

#: Size and two independent sums of the hashes tell sets apart.
SET_KEY = ["n_shingles", "sum1", "sum2"]
#: Up to this many ids are broadcast to pick texts; beyond, they are joined.
BROADCAST_IDS = 1_000_000


def sets_of(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for _, words in words_by_text(column, lower_table(), space_table()):
        yield shingle_set(words, n)


def sums(hashes: np.ndarray) -> tuple[np.int64, np.int64]:
    return (
        hashes.sum(dtype=np.uint64).astype(np.int64),
        mix(hashes ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64),
    )


def full_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """(rep, hashes) of the texts ``wanted`` (rep, doc_id); ``rep`` is the hash of the set's key.

    Only those texts are read into sets. A repeated row gives a repeated set.
    """
    pick = F.broadcast if wanted.count() <= BROADCAST_IDS else (lambda df: df)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, sum1, sum2, packed = [], [], [], []
            for hashes in sets_of(batch.column(1), n):
                a, b = sums(hashes)
                size.append(len(hashes))
                sum1.append(a)
                sum2.append(b)
                packed.append(hashes.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(size, pa.int64()), pa.array(np.array(sum1, np.int64)),
                    pa.array(np.array(sum2, np.int64)), pa.array(packed, pa.binary()),
                ],
                [*SET_KEY, "hashes"],
            )

    texts = docs.select("doc_id", "text").join(pick(wanted.select("doc_id").distinct()), "doc_id", "leftsemi")
    sets = texts.mapInArrow(hashed, "n_shingles long, sum1 long, sum2 long, hashes binary")
    # An id may have other texts too.
    sets = sets.select(F.xxhash64(*SET_KEY).alias("rep"), "hashes")
    return sets.join(pick(wanted.select("rep")), "rep", "leftsemi")
