"""Spelling variants: words one edit apart, by a bit-sliced position index.

An index holds, for each position and letter, the set of words with that letter there, as one
integer with a bit per word. A query word walks along its letters and carries four sets for all words of the
index at once: those that agree so far, and those that agree so far but for one
replaced, one additional or one missing letter; the last two are looked up one position on or
back. Each step is a few ands and ors of whole sets.

Words one edit apart share their first three or their last three letters when they have six or more, so they are
indexed in groups by either. A group is dealt into blocks of bounded size; every word
of a group is put to each of the group's blocks, and comes back with a count and its best neighbour there, not with pairs.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, table

# The letters of a run, and the rule that spoils some of them.
LETTERS = "A-Za-zÀ-ÿ"
SPOIL_EVERY = 199

SHORTEST = 6
#: Letters at either end by which words are grouped; words need twice as many.
EDGE = 3
#: Words and letters of one index.
BLOCK_WORDS = 4096
#: Distinct words that a task counts before it sends them.
BUFFER = 200_000

_LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _spoiled(run: str, doc_id: object) -> str:
    """The run without one letter, for the few that the checksum of document and run picks."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % SPOIL_EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, min_length: int = SHORTEST, min_count: int = 5) -> DataFrame:
    """(word, n) of the words of ``docs`` (doc_id, text); a word is a run after spoiling."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Shorter runs can't become longer; matching is greedy, so a match is a whole run.
        runs = re.compile(f"[{LETTERS}]{{{min_length},}}")
        total: Counter[str] = Counter()

        def sent() -> pa.RecordBatch:
            words, n = list(total), list(total.values())
            total.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py()
                if not text:
                    continue
                prefix = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                found = Counter(runs.findall(text.translate(_LOWER)))
                for run, n in found.items():
                    if zlib.crc32(run.encode(), prefix) % SPOIL_EVERY == 0:
                        run = _spoiled(run, doc_id)
                        if len(run) < min_length:
                            continue
                    total[run] += n
                if len(total) >= BUFFER:
                    yield sent()
        if total:
            yield sent()

    words = docs.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return words.where(F.col("n") >= min_count)


class PositionIndex:
    """The sets of words by position and letter, of lengths, and of first letters."""

    def __init__(self, words: list[str]):
        self.words = words
        self.at: dict[tuple[int, str], int] = {}
        self.long: dict[int, int] = {}
        self.starts: dict[str, int] = {}
        at: dict[tuple[int, str], list[int]] = {}
        long: dict[int, list[int]] = {}
        starts: dict[str, list[int]] = {}
        for k, word in enumerate(words):
            for place in enumerate(word):
                at.setdefault(place, []).append(k)
            long.setdefault(len(word), []).append(k)
            starts.setdefault(word[:EDGE], []).append(k)
        for sets, members in ((self.at, at), (self.long, long), (self.starts, starts)):
            for key, numbers in members.items():
                sets[key] = _bits(numbers, len(words))
        self.all = (1 << len(words)) - 1

    def near(self, word: str) -> int:
        """The set of words that differ from ``word`` by one inserted, deleted or replaced letter."""
        at = self.at
        none, replaced, added, missing = self.all, 0, 0, 0
        here = 0  # words with this letter one position back
        for i, letter in enumerate(word):
            same, ahead, back = at.get((i, letter), 0), at.get((i + 1, letter), 0), here
            here = at.get((i, word[i + 1]), 0) if i + 1 < len(word) else 0
            replaced = (replaced & same) | (none ^ (none & same))
            added = (added | none) & ahead
            missing = (missing & back) | none
            none &= same
            if not (none or replaced or added or missing):
                return 0
        m = len(word)
        long = self.long
        # Words that agree to the end and have one more letter; the ones that end before are found by length.
        return (
            (replaced & long.get(m, 0)) | ((added | none) & long.get(m + 1, 0)) | (missing & long.get(m - 1, 0))
        )


def _bits(numbers: list[int], size: int) -> int:
    """The integer with these bits set."""
    if len(numbers) < 8:
        total = 0
        for k in numbers:
            total |= 1 << k
        return total
    raw = bytearray(size // 8 + 1)
    for k in numbers:
        raw[k >> 3] |= 1 << (k & 7)
    return int.from_bytes(raw, "little")


def _members(found: int) -> Iterator[int]:
    while found:
        low = found & -found
        yield low.bit_length() - 1
        found ^= low


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by block, those to index before those to ask: (word, n_near, near_n, near) per word with any."""
    group, counts, words, index = None, [], [], None
    for batch in batches:
        out: dict[str, list] = {"word": [], "n_near": [], "near_n": [], "near": []}
        columns = [batch.column(k).to_pylist() for k in ("kind", "edge", "block", "asks", "word", "n")]
        for kind, edge, block, asks, word, n in zip(*columns, strict=True):
            if (kind, edge, block) != group:
                group, counts, words, index = (kind, edge, block), [], [], None
            if not asks:
                words.append(word)
                counts.append(n)
                continue
            index = index or PositionIndex(words)
            found = index.near(word)
            if kind:  # those with the same first letters are found there
                found &= ~index.starts.get(word[:EDGE], 0)
            if found:
                best = min(((-counts[k], words[k]) for k in _members(found)))
                out["word"].append(word)
                out["n_near"].append(found.bit_count())
                out["near_n"].append(-best[0])
                out["near"].append(best[1])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(out["word"], pa.string()), pa.array(out["n_near"], pa.int64()),
                pa.array(out["near_n"], pa.int64()), pa.array(out["near"], pa.string()),
            ],
            list(out),
        )


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, near_n, near) of each of the ``words`` (word, n) that has a near one.

    ``n_near``: the near words' number; ``near``: the one with the largest n, ``near_n``, the first in code-point order of equals.
    Words must have twice EDGE letters or more, and be distinct.
    """
    ends = F.array(
        F.struct(F.lit(0).alias("kind"), F.substring("word", 1, EDGE).alias("edge")),
        F.struct(F.lit(1).alias("kind"), F.right("word", F.lit(EDGE)).alias("edge")),
    )
    rows = words.select("word", "n", F.inline(ends))
    sizes = rows.groupBy("kind", "edge").agg(F.count("*").alias("members")).where("members > 1")
    rows = rows.join(sizes, ["kind", "edge"])
    n_blocks = F.ceil(F.col("members") / BLOCK_WORDS)
    indexed = rows.withColumn("block", F.pmod(F.xxhash64("word"), n_blocks)).withColumn("asks", F.lit(0))
    asking = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), n_blocks - 1))).withColumn("asks", F.lit(1))
    key = ["kind", "edge", "block"]
    both = indexed.unionByName(asking).select(*key, "asks", "word", "n")
    dealt = both.repartition(*key).sortWithinPartitions(*key, "asks")
    found = dealt.mapInArrow(_asked, "word string, n_near long, near_n long, near string")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("best.minus")).alias("near_n"), F.col("best.near").alias("near")
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for ``forms`` (word, form): the last word when forms are followed.

    A form occurs several times as often as its word, so there are no rings, and the rounds
    are the binary digits of the longest chain.
    """
    state = table(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = state.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = state.join(ahead, "root", "left")
        moved = table(moved.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        state = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return state


def spelling_variants(
    docs: DataFrame, min_count: int = 5, times: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) per word of the texts.

    A word is a run of the letters A-Z, a-z, U+00C0 to U+00FF, with A-Z lower-cased; where 199 divides the CRC-32 of
    ``<id>:<run>``, the run loses one letter. Words have six letters and ``min_count`` occurrences
    at least. ``form``: the word one edit away that occurs most (the first in code-point order of
    equals), if it occurs ``times`` as often; ``root``: where following forms ends.

    Null texts have no words; a null id counts as empty text before the colon. Repeated rows count each time.
    An empty table gives no row. Other columns are not looked at, whatever their names.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    words = table(vocabulary(docs, SHORTEST, min_count), "words")
    known = words.join(near_words(words), "word", "left")
    has_form = F.col("near_n") >= F.col("n") * times
    known = table(
        known.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, F.col("near")).alias("form"), F.when(has_form, F.col("near_n")).alias("form_n"),
        ),
        "near",
    )
    roots = _roots(known.where("form IS NOT NULL").select("word", "form"))
    return known.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
