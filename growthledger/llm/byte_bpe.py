"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The library's model is built from a rank file: bytes are written as characters, and every
way to part a token into two known tokens becomes a merge, in the order of the ranks. New
pieces of text are encoded by the library in batches and remembered as packed ids; a piece
is what stands between single spaces (see ``token_counts``), since such a space always
starts a new match of the pattern. Decoding reverses the byte table.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, texts_of, type_of
from .token_counts import byte_characters

#: Entries in each of the two generations of the per-process memory of pieces.
MEMORY = 150_000
#: Characters of the pieces in one generation.
MEMORY_CHARS = 4 << 20


class ByteBpe:
    """Encodes texts to ids and decodes ids to bytes for one rank file."""

    def __init__(self, rank_path: str, pattern: str = public_tokenizers.PATTERN):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        with open(rank_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        letters = byte_characters()
        written = {token: "".join(letters[b] for b in token) for token in ranks}
        merges = [
            (written[token[:k]], written[token[k:]])
            for token in sorted(ranks, key=ranks.__getitem__)
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        ]
        self.tokenizer = Tokenizer(models.BPE({written[t]: r for t, r in ranks.items()}, merges))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.Split(Regex(pattern), behavior="isolated"),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        self.pieces: dict[str, bytes | None] = {}
        self.older: dict[str, bytes | None] = {}
        self.held = 0

        # The way back: from a token's characters to its bytes, laid out end to end.
        byte_of = {letter: b for b, letter in enumerate(letters)}
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for text, rank in self.tokenizer.get_vocab().items():
            tokens[rank] = bytes(byte_of[c] for c in text)
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int32).tobytes()

    def _learn(self, pieces: set[str]) -> None:
        """Remember the ids of pieces, each with the space before it."""
        new = []
        self.held += sum(map(len, pieces))
        for piece in pieces:
            if not piece or piece[0].isspace() or piece[-1].isspace():
                self.pieces[piece] = None  # the text has to be cut as a whole
            elif (ids := self.older.get(piece)) is not None:
                self.pieces[piece] = ids
            else:
                new.append(piece)
        for i in range(0, len(new), 10_000):
            part = new[i : i + 10_000]
            found = self.tokenizer.encode_batch_fast([" " + p for p in part], add_special_tokens=False)
            for piece, encoding in zip(part, found, strict=True):
                self.pieces[piece] = np.array(encoding.ids, np.int32).tobytes()

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, special strings being ordinary text."""
        if len(self.pieces) > MEMORY or self.held > MEMORY_CHARS:
            # What was used since the last time stays one round longer.
            self.older, self.pieces, self.held = self.pieces, {}, 0
        split = [t.split(" ") for t in texts]
        self._learn(set(chain.from_iterable(rest for _, *rest in split)) - self.pieces.keys())
        known, out = self.pieces.__getitem__, []
        for text, (first, *rest) in zip(texts, split, strict=True):
            parts = list(map(known, rest))
            if not first or first[-1].isspace() or None in parts:
                ids = self._whole(text)
            else:
                ids = self._whole(first) + b"".join(parts)
            out.append(np.frombuffer(ids, np.int32))
        return out

    def spans(self, data: bytes, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte, character) index at which each token ends.

        A character whose bytes are split over tokens counts with the token that holds its
        first byte.
        """
        ends = np.cumsum(self.length[ids])
        leads = np.frombuffer(data, np.uint8) & 0xC0 != 0x80
        return ends, np.concatenate([[0], np.cumsum(leads)])[ends]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids; they need not be whole characters."""
        size = self.length[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self.start[ids] - (ends - size), size) + np.arange(total)
        return self.bytes[at].tobytes()


@lru_cache(maxsize=2)
def _bpe(rank_path: str) -> ByteBpe:
    return ByteBpe(rank_path)


def _lists(values: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()))


def encode(
    docs: DataFrame, rank_path: str, offsets: bool = False, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, ids) per row; with ``offsets`` also byte_ends and char_ends of the tokens.

    Null texts are empty and have no ids. Rows are independent, so null and repeated ids
    pass through; other columns are not looked at.
    """
    prepare(docs.sparkSession)
    names = [id_col, "ids", *(["byte_ends", "char_ends"] if offsets else [])]

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(rank_path)
        for batch in batches:
            texts = texts_of(batch.column(1))
            ids = bpe.encode(texts)
            columns = [batch.column(0), _lists(ids)]
            if offsets:
                spans = [bpe.spans(t.encode(), i) for t, i in zip(texts, ids, strict=True)]
                columns += [_lists([s[k].astype(np.int32) for s in spans]) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names)

    extra = "".join(f", {n} array<int>" for n in names[1:])
    schema = f"`{id_col}` {type_of(docs, id_col)}{extra}"
    return docs.select(id_col, text_col).mapInArrow(encoded, schema)


def decode(rows: DataFrame, rank_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, decoded binary) per row; null ids decode to no bytes.

    ``decoded`` may begin or end inside a character when the ids are part of a text; cast
    whole texts to string.
    """

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(rank_path)
        for batch in batches:
            column = batch.column(1)
            bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(column), 0).to_numpy())])
            flat = pc.list_flatten(column).to_numpy(zero_copy_only=False)
            texts = [bpe.decode(flat[a:b]) for a, b in zip(bounds, bounds[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([batch.column(0), column, pa.array(texts, pa.binary())], names)

    names = [id_col, ids_col, "decoded"]
    schema = f"`{id_col}` {type_of(rows, id_col)}, `{ids_col}` array<int>, decoded binary"
    return rows.select(id_col, ids_col).mapInArrow(decoded, schema)


def round_trip(docs: DataFrame, rank_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): texts encoded, then decoded from the ids."""
    prepare(docs.sparkSession)

    def both_ways(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One worker for both, and nothing remembered beyond the task: an executor holds one tokenizer per core.
        bpe = _bpe(rank_path)
        try:
            for batch in batches:
                ids = bpe.encode(texts_of(batch.column(1)))
                texts = pa.array([bpe.decode(np.asarray(i, np.int32)) for i in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0), _lists(ids), texts], ["id", "ids", "decoded"])
        finally:
            bpe.pieces.clear()
            bpe.older.clear()

    id_name = f"`{id_col}`"
    rows = docs.select(F.col(id_name).alias("id"), F.col(f"`{text_col}`").alias("text"))
    both = rows.mapInArrow(both_ways, f"id {type_of(rows, 'id')}, ids array<int>, decoded binary")
    return both.select(
        F.col("id").alias(id_col),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
