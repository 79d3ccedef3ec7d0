"""Token counts of whole texts by byte-pair merging, without producing identifiers.

Text is cut by the vocabulary's pattern into pre-tokens. Within one, symbols form a linked
list and adjacent pairs a heap ordered by merge rank, then place; the lowest is popped
and merged until none is left. The count is the initial symbols minus the merges.

Space-separated pieces are counted once and remembered: a single space between two
characters that are no white space always starts a new pre-token, so the counts of pieces
add up. Texts with other white space next to a space are cut as a whole.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from .common import prepare, texts_of, type_of

#: Entries in each of the two generations of the per-process memory of pieces.
MEMORY = 500_000
#: Count that marks a piece whose text has to be cut as a whole.
_WHOLE = -(1 << 50)


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others take the code points from 256 on.
    """
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(spare)) for b in range(256)]


class MergeCounter:
    """Counts the tokens of texts for a byte-level pair vocabulary."""

    def __init__(self, pairs: list[tuple[str, str]], pattern: str, whole_tokens: list[str] = ()):
        symbol = {c: i for i, c in enumerate(byte_characters())}
        self.first = list(range(256))
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for left, right in pairs:
            made = symbol.setdefault(left + right, len(symbol))
            self.rank.setdefault(symbol[left] << 24 | symbol[right], len(self.made))
            self.made.append(made)
        self.pattern = regex.compile(pattern)
        self.special = list(whole_tokens)
        self.special_pattern = regex.compile("|".join(map(regex.escape, whole_tokens)) or "(?!)")
        self.pieces: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.pre_tokens: dict[str, int] = {}

    @classmethod
    def from_json(cls, path: str) -> MergeCounter:
        """From a tokenizer file with byte-level pre-tokenization."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        return cls(merges, public_tokenizers.PATTERN, [t["content"] for t in spec.get("added_tokens", [])])

    def merged(self, data: bytes) -> int:
        """Symbols left of one pre-token."""
        rank, made = self.rank, self.made
        symbols = list(data)
        n = len(symbols)
        heap = []
        for i in range(n - 1):
            r = rank.get(symbols[i] << 24 | symbols[i + 1])
            if r is not None:
                heap.append(r << 40 | i)
        if not heap:
            return n
        heapq.heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left = n
        while heap:
            entry = heapq.heappop(heap)
            i, r = entry & 0xFFFFFFFFFF, entry >> 40
            j = after[i]
            # An entry is stale when the place has no pair of this rank any more.
            if symbols[i] < 0 or j >= n or rank.get(symbols[i] << 24 | symbols[j]) != r:
                continue
            symbols[i], symbols[j] = made[r], -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank.get(symbols[i] << 24 | symbols[k])
                if r is not None:
                    heapq.heappush(heap, r << 40 | i)
            k = before[i]
            if k >= 0:
                r = rank.get(symbols[k] << 24 | symbols[i])
                if r is not None:
                    heapq.heappush(heap, r << 40 | k)
        return left

    def whole(self, text: str) -> int:
        total = 0
        for part in self.pattern.findall(text):
            count = self.pre_tokens.get(part)
            if count is None:
                if len(self.pre_tokens) > MEMORY:
                    self.pre_tokens.clear()
                count = self.pre_tokens[part] = self.merged(part.encode())
            total += count
        return total

    def learn(self, pieces: set[str]) -> None:
        """Remember the tokens of pieces, each with the space before it."""
        older = self.older
        for piece in pieces:
            count = older.get(piece)
            if count is None:
                if not piece or piece[0].isspace() or piece[-1].isspace():
                    count = _WHOLE
                else:
                    count = self.whole(" " + piece)
            self.pieces[piece] = count

    def counts(self, texts: list[str]) -> list[int]:
        """Tokens of each text."""
        if len(self.pieces) > MEMORY:
            # What was used since the last time stays one round longer.
            self.older, self.pieces = self.pieces, {}
        split = [t.split(" ") for t in texts]
        self.learn(set(chain.from_iterable(split)) - self.pieces.keys())
        known, found = self.pieces.__getitem__, []
        for text, (first, *rest) in zip(texts, split, strict=True):
            if any(token in text for token in self.special):
                parts = self.special_pattern.split(text)
                found.append(len(parts) - 1 + sum(map(self.whole, parts)))
                continue
            total = -1 if not first or first[-1].isspace() else self.whole(first) + sum(map(known, rest))
            found.append(self.whole(text) if total < 0 else total)
        return found


@lru_cache(maxsize=2)
def _counter(path: str) -> MergeCounter:
    return MergeCounter.from_json(path)


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row.

    Null and empty texts have 0 bytes and 0 tokens. Rows are independent: null or repeated
    ids and repeated rows pass through, other columns are not looked at.
    """
    prepare(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer_path)
        for batch in batches:
            ids, column = batch.columns
            tokens = pa.array(counter.counts(texts_of(column)), pa.int64())
            size = pc.fill_null(pc.binary_length(column), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, size, tokens, pc.greater(tokens, limit)], [id_col, "n_bytes", "n_tokens", "over_limit"]
            )

    schema = f"`{id_col}` {type_of(docs, id_col)}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    return docs.select(id_col, text_col).mapInArrow(counted, schema)
