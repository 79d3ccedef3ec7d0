"""CSV text with line breaks inside quotes, cut into records by many tasks.

Where a record ends depends on all text before it, since a line break counts only outside of quotes. But each line,
and so each split of a file, only maps "starts inside quotes" to "ends inside quotes", and two such maps in a row are one
again. So the lines are read in splits twice: the first pass reduces each split to its map, the driver chains one
entry per split (it plans one entry per split anyway), and the second pass cuts every split into records, now knowing
how it starts. Only records that cross a split's end, at most two pieces per split, are shuffled to be joined.

A quote opens a field at its start only and closes it at the next one that isn't doubled, as for Spark's own parser; a
quote inside an unquoted field is text. Records end with ``\\n`` or ``\\r\\n``; line breaks inside quotes stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A field that is followed by a comma: quoted, empty or plain.
_QUOTED = r'"(?:[^"]++|"")*+'
_FIELDS = rf'(?:{_QUOTED}"[^,]*+,|,|[^",][^,]*+,)*+'
_OPENS = rf"\A{_FIELDS}{_QUOTED}\z"
_STAYS_OPEN = rf'\A(?:[^"]++|"")*+(?:"[^,]*+,{_FIELDS}{_QUOTED})?+\z'

# What a line does: 1 if it ends inside quotes after a start outside, plus 2 if it does after a start inside.
_CLOSES, _SWAPS, _KEEPS, _LEAVES_OPEN = 0, 1, 2, 3

_SPLITS = "path string, start long, from_closed boolean, from_open boolean, begins boolean"
_RECORDS = "path string, owner long, start long, first boolean, text string"
_RECORDS_ARROW = pa.schema(
    [("path", pa.string()), ("owner", pa.int64()), ("start", pa.int64()), ("first", pa.bool_()), ("text", pa.string())]
)

#: By file and start of a split: does it start inside quotes, and if so, in which split did that record begin.
Starts = dict[str, dict[int, int | None]]


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """first, text: each record's whole text without the line break at its end; ``first`` marks each file's first one.

    Empty lines are no records. A file that ends inside quotes is an error, found here: the first pass runs now.
    """
    lines = _lines(spark, path)
    starts = _chain(lines)
    whole = lines.mapInArrow(_cutter(starts, pieces=False), _RECORDS)
    if any(owner is not None for splits in starts.values() for owner in splits.values()):
        pieces = lines.mapInArrow(_cutter(starts, pieces=True), _RECORDS)
        in_order = F.array_sort(F.collect_list(F.struct("start", "text")))
        joined = pieces.groupBy("path", "owner").agg(
            F.bool_or("first").alias("first"),
            F.array_join(F.transform(in_order, lambda p: p["text"]), "\n").alias("text"),
        )
        whole = whole.select("first", "text").unionByName(joined.select("first", "text"))
    text = F.col("text")
    ended = F.when(F.endswith(text, F.lit("\r")), F.expr("left(text, length(text) - 1)")).otherwise(text)
    return whole.select("first", ended.alias("text")).where("text <> ''")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """path, start (of the split), move, text: the lines of each split in order."""
    text = F.col("value")
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        _move(text).alias("move"),
        text.alias("text"),
    )


def _move(text: Column) -> Column:
    with_quotes = text.rlike(_OPENS).cast("byte") + text.rlike(_STAYS_OPEN).cast("byte") * F.lit(2).cast("byte")
    return F.when(F.contains(text, F.lit('"')), with_quotes.cast("byte")).otherwise(F.lit(_KEEPS).cast("byte"))


def _ends_open(moves: np.ndarray, is_open: bool) -> np.ndarray:
    """For each line, whether it ends inside quotes, if the first one starts so or not."""
    swaps = np.cumsum(moves == _SWAPS)
    fixed = np.where((moves == _CLOSES) | (moves == _LEAVES_OPEN), np.arange(len(moves)), -1)
    last = np.maximum.accumulate(fixed)
    base = np.where(last >= 0, moves[last] == _LEAVES_OPEN, is_open)
    return (base + swaps - np.where(last >= 0, swaps[last], 0)) % 2 == 1


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """The lines of one split after the other; a split may go on in the next batch."""
    if not batch.num_rows:
        return
    paths = pc.dictionary_encode(batch.column("path"))
    codes, starts = paths.indices.to_numpy(zero_copy_only=False), batch.column("start").to_numpy()
    cuts = np.flatnonzero((np.diff(codes) != 0) | (np.diff(starts) != 0)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        yield (paths.dictionary[int(codes[a])].as_py(), int(starts[a])), batch.slice(a, b - a)


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per split: how it ends from either start, and whether a record begins in it if it starts inside quotes."""
    found: dict[tuple[str, int], list[bool]] = {}
    for batch in batches:
        for split, lines in _runs(batch):
            moves = lines.column("move").to_numpy()
            closed, opened, begins = found.get(split, (False, True, False))
            after = _ends_open(moves, opened)
            begins = begins or not opened or not after[:-1].all()
            found[split] = [bool(_ends_open(moves, closed)[-1]), bool(after[-1]), bool(begins)]
    rows = [(*split, *ends) for split, ends in found.items()]
    columns = zip(*rows, strict=True) if rows else [[]] * 5
    types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
    names = ["path", "start", "from_closed", "from_open", "begins"]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _chain(lines: DataFrame) -> Starts:
    """How each split starts. The driver gets one short row per split."""
    splits = lines.select("path", "start", "move").mapInArrow(_reduce, _SPLITS).toArrow().sort_by(
        [("path", "ascending"), ("start", "ascending")]
    )
    starts: Starts = {}
    path, owner = None, None
    for row in zip(*[splits.column(c).to_pylist() for c in splits.column_names], strict=True):
        if row[0] != path:
            _require_closed(path, owner)
            path, owner = row[0], None
        _, start, from_closed, from_open, begins = row
        starts.setdefault(path, {})[start] = owner
        if owner is None:
            owner = start if from_closed else None
        elif not from_open:
            owner = None
        elif begins:
            owner = start
    _require_closed(path, owner)
    return starts


def _require_closed(path: str | None, owner: int | None) -> None:
    if owner is not None:
        raise ValueError(f"{path} ends inside quotes; the record begins in the split at byte {owner}")


def _cutter(starts: Starts, pieces: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts splits into whole records, or into the ``pieces`` of those that cross a split's end."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = _Split("", 0, None)
        for batch in batches:
            out: list[tuple] = []
            for (path, start), lines in _runs(batch):
                if (path, start) != (split.path, split.start):
                    out += split.end()
                    if start not in starts.get(path, {}):
                        raise RuntimeError(f"{path} was not split at byte {start} in the pass before; read it again")
                    split = _Split(path, start, starts[path][start])
                if split.all_whole(lines):
                    if not pieces:
                        yield _plain(lines.column("text"))
                else:
                    out += split.cut(lines)
            yield _batch(out, pieces)
        yield _batch(split.end(), pieces)

    return cut


class _Split:
    """One split's lines on their way to records. Rows are (path, owner, start, first, text); whole records have no owner."""

    def __init__(self, path: str, start: int, owner: int | None):
        self.path, self.start, self.owner = path, start, owner
        self.open = owner is not None
        self.pending: list[str] = []
        self.header_seen = start > 0

    def all_whole(self, lines: pa.RecordBatch) -> bool:
        """No line goes on in the next one, and none is the file's first."""
        if self.open or not self.header_seen:
            return False
        moves = lines.column("move").to_numpy()
        return not ((moves == _SWAPS) | (moves == _LEAVES_OPEN)).any()

    def cut(self, lines: pa.RecordBatch) -> list[tuple]:
        after = _ends_open(lines.column("move").to_numpy(), self.open)
        texts = lines.column("text").to_pylist()
        out, begin = [], 0
        for end in np.flatnonzero(~after) + 1:
            text = "\n".join([*self.pending, *texts[begin:end]])
            self.pending = []
            out.append(self._row(self.owner, text))
            self.owner, begin = None, end
        self.pending += texts[begin:]
        self.open = bool(after[-1])
        return out

    def end(self) -> list[tuple]:
        """What is still open belongs to a record that goes on in the next split."""
        if not self.pending:
            return []
        owner = self.start if self.owner is None else self.owner
        return [self._row(owner, "\n".join(self.pending))]

    def _row(self, owner: int | None, text: str) -> tuple:
        first = not self.header_seen and text.rstrip("\r") != ""
        self.header_seen = self.header_seen or first
        return self.path, owner, self.start, first, text


def _plain(texts: pa.Array) -> pa.RecordBatch:
    n = len(texts)
    columns = [pa.nulls(n, pa.string()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.repeat(False, n), texts]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, _RECORDS_ARROW, strict=True)], schema=_RECORDS_ARROW)


def _batch(rows: list[tuple], pieces: bool) -> pa.RecordBatch:
    kept = [r for r in rows if (r[1] is not None) == pieces]
    columns = zip(*kept, strict=True) if kept else [[]] * len(_RECORDS_ARROW)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _RECORDS_ARROW, strict=True)], schema=_RECORDS_ARROW
    )
