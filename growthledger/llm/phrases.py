"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are two words, edges three: an edge joins the nodes that overlap in its middle word,
and weighs how often the three words occur together. Every word occurrence starts exactly one edge; near the
end of a piece the missing words are an end mark, and these edges are the piece-end corrections. So only
edges are counted over the texts, and the shorter counts follow from them: the occurrences
of two words are the flow out of their node, those of a word the flow out of all its nodes.

Words are 64-bit hashes until the result is known. A task counts the edges of many texts before it sends any,
and sends them as packed blocks: each word once, and three small numbers per edge. What is
sent is dealt by node, so that one task sees all edges out of a node; it keeps
the edges and nodes that reach ``min_count`` one by one, and the rest as one remainder per
node or word. The number of parts follows the length of the texts.

Edges that reach ``min_count`` are compacted: nodes with one edge in and one out lie inside
a path. Whether a longer phrase takes in a node is read off its neighbours in the path; only
the ends of paths have to be brought together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import blocks, lower_table, mix, prepare, table, word_hashes

# What ends a piece, what parts the words of a piece, the language of texts without one.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_ENDS = b"\x20\x09"
NO_LANG = "und"

#: Word occurrences that a task counts before it sends blocks.
BUFFER = 2 << 20
#: Shares in which a task adds up and packs what it holds.
SHARES = 16
#: Edges of one language that a task holds before it adds up equal ones.
MERGE = 1 << 20
#: Characters of text per part of the shuffle.
PART_CHARS = 12 << 20
#: Edges of one stored path; longer paths go on in another row.
PATH_EDGES = 512
#: Up to this many words are broadcast to look up their text; beyond, they are joined.
BROADCAST_WORDS = 1_000_000

_PLACES = [np.uint64(k) for k in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3)]
_END = np.uint64(0)


def _key(words: np.ndarray) -> np.ndarray:
    total = np.zeros(words.shape[1], np.uint64)
    for place, row in zip(_PLACES, words, strict=False):
        total = total + row * place
    return mix(total)


def add_up(words: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal columns of ``words`` once, with the sum of their ``n``."""
    if not len(n):
        return words, n
    order = np.argsort(_key(words))
    words, n = words[:, order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (words[:, 1:] != words[:, :-1]).any(axis=0)]))
    return words[:, first], np.add.reduceat(n, first)


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    piece = np.zeros(256, bool)
    piece[list(PIECE_ENDS)] = True
    apart = piece.copy()
    apart[list(WORD_ENDS)] = True
    return lower_table(), apart, piece


def _words(column: pa.Array, tables: tuple[np.ndarray, ...]) -> Iterator[tuple[int, np.ndarray, np.ndarray, ...]]:
    """(first row, bytes, text starts, hashes, begins, row of each word, piece of each word) by block."""
    lower, apart, piece = tables
    for first, _, data, starts in blocks(column):
        hashes, begin = word_hashes(data, starts, lower, apart)
        row = np.searchsorted(starts, begin, "right") - 1
        ended = np.cumsum(piece[data])
        # Another text is another piece; several empty texts may share a start.
        yield first, data, starts, hashes, begin, row, (ended[begin] if len(begin) else begin) + (row << 40)


def _edges(column: pa.Array, langs: np.ndarray, tables: tuple[np.ndarray, ...]) -> Iterator[np.ndarray]:
    """(w1, w2, w3, language) of the edge that each word occurrence starts, as four rows."""
    for first, _, _, hashes, _, row, piece in _words(column, tables):
        m = len(hashes)
        if not m:
            continue
        edges = np.zeros((4, m), np.uint64)
        edges[0] = hashes
        for k in (1, 2):
            same = np.flatnonzero(piece[k:] == piece[: m - k]) if m > k else np.zeros(0, np.int64)
            edges[k, same] = hashes[same + k]
        edges[3] = langs[first + row]
        yield edges


def _part(words: np.ndarray, parts: int) -> np.ndarray:
    """The part of the shuffle that sees all edges out of each edge's node."""
    return (_key(words[:2]) >> np.uint64(32)) % np.uint64(parts)


def _blocks_of(words: np.ndarray, n: np.ndarray, names: list[str], parts: int) -> pa.RecordBatch:
    """Packed blocks of counted edges, one per (language, part)."""
    part = _part(words, parts)
    group = words[3] * np.uint64(parts) + part
    order = np.argsort(group, kind="stable")
    words, n, group = words[:, order], n[order], group[order]
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    out: dict[str, list] = {"part": [], "lang": [], "words": [], "edges": [], "n": []}
    for a, b in zip(first, [*first[1:], len(group)], strict=True):
        used, number = np.unique(words[:3, a:b], return_inverse=True)
        small = np.uint16 if len(used) <= 1 << 16 else np.uint32
        out["part"].append(int(group[a]) % parts)
        out["lang"].append(names[int(group[a]) // parts])
        out["words"].append(used.tobytes())
        out["edges"].append(number.astype(small).tobytes())
        out["n"].append(n[a:b].astype(np.uint8 if n[a:b].max() < 256 else np.uint32).tobytes())
    binary = pa.binary()
    return pa.RecordBatch.from_arrays(
        [
            pa.array(out["part"], pa.int32()), pa.array(out["lang"], pa.string()),
            pa.array(out["words"], binary), pa.array(out["edges"], binary), pa.array(out["n"], binary),
        ],
        list(out),
    )


def _unpacked(words: bytes, edges: bytes, n: bytes) -> tuple[np.ndarray, np.ndarray]:
    used = np.frombuffer(words, np.uint64)
    number = np.frombuffer(edges, np.uint16 if len(used) <= 1 << 16 else np.uint32).reshape(3, -1)
    counts = np.frombuffer(n, np.uint8 if len(n) == number.shape[1] else np.uint32)
    return used[number], counts.astype(np.int64)


def _graph_rows(words: np.ndarray, n: np.ndarray, min_count: int) -> tuple[np.ndarray, np.ndarray]:
    """All edges out of some nodes, reduced to what reaches ``min_count`` and remainders.

    Rows (w1, w2, w3), an end mark standing for what is left out: frequent edges, then what else flows out of
    frequent nodes, then what else flows out of a word.
    """
    order = np.argsort(_key(words[:2]), kind="stable")
    words, n = words[:, order], n[order]
    first = np.flatnonzero(np.concatenate([[True], (words[:2, 1:] != words[:2, :-1]).any(axis=0)]))
    node = words[:, first].copy()
    heavy = (n >= min_count) & (words[2] != _END)
    flow, in_edges = np.add.reduceat(n, first), np.add.reduceat(np.where(heavy, n, 0), first)
    frequent = (flow >= min_count) & (node[1] != _END)
    node[2] = _END
    node[1, ~frequent] = _END
    left, left_n = add_up(node, flow - np.where(frequent, in_edges, 0))
    some = left_n > 0
    return (
        np.concatenate([words[:3, heavy], left[:, some]], axis=1),
        np.concatenate([n[heavy], left_n[some]]),
    )


def word_graph(docs: DataFrame, min_count: int) -> DataFrame:
    """(lang, w1, w2, w3, n): frequent edges, and remainders whose w3, or w2 and w3, are null.

    ``docs``: (lang, text). The n of all rows with the same w1 and w2 add up to the occurrences of these
    two words, where that is at least ``min_count``; the n of all rows with the same w1 to its own.
    """
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(8, -(-chars // PART_CHARS))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables()
        codes: dict[str, int] = {}
        # One array per task, filled in place. What is done to it is done to one share of the parts at a time.
        held = np.empty((4, BUFFER), np.uint64)
        share = np.empty(BUFFER, np.uint8)
        size = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for k in range(SHARES):
                edges = held[:, np.flatnonzero(share[:size] == k)]
                if edges.size:
                    yield _blocks_of(*add_up(edges, np.ones(edges.shape[1], np.int64)), list(codes), parts)

        for batch in batches:
            langs = np.array([codes.setdefault(v, len(codes)) for v in batch.column(0).to_pylist()], np.uint64)
            for edges in _edges(batch.column(1), langs, tables):
                while edges.size:
                    room = edges[:, : BUFFER - size]
                    held[:, size : size + room.shape[1]] = room
                    share[size : size + room.shape[1]] = _part(room, parts) % np.uint64(SHARES)
                    size += room.shape[1]
                    edges = edges[:, room.shape[1] :]
                    if size == BUFFER:
                        yield from sent()
                        size = 0
        yield from sent()

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str], list] = {}
        size: dict[tuple[int, str], int] = {}
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["part"], row["lang"])
                held.setdefault(key, []).append(_unpacked(row["words"], row["edges"], row["n"]))
                size[key] = size.get(key, 0) + len(held[key][-1][1])
                # Equal edges are added up each time that as many again have come.
                if size[key] > max(MERGE, 2 * len(held[key][0][1])):
                    held[key] = [_merged(held[key])]
                    size[key] = len(held[key][0][1])
        for (_, lang), several in held.items():
            words, n = _graph_rows(*_merged(several), min_count)
            several.clear()
            w = [pa.array(row.view(np.int64), mask=row == _END if k else None) for k, row in enumerate(words)]
            names = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(n), np.int32)), pa.array([lang])).cast(pa.string())
            yield pa.RecordBatch.from_arrays([names, *w, pa.array(n)], ["lang", "w1", "w2", "w3", "n"])

    packed = docs.mapInArrow(counted, "part int, lang string, words binary, edges binary, n binary")
    graph = packed.repartitionById(parts, "part").mapInArrow(reduced, "lang string, w1 long, w2 long, w3 long, n long")
    return table(graph, "graph")


def _merged(several: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    return add_up(np.concatenate([w for w, _ in several], axis=1), np.concatenate([n for _, n in several]))


def unary_paths(edges: DataFrame) -> DataFrame:
    """(lang, path, part, edges): the maximal paths through nodes with one edge in and one out.

    ``edges``: (lang, w1, w2, w3, n). ``edges`` of a row: consecutive (w1, w2, w3, n), at most PATH_EDGES. A
    ring without any other node is left as single edges. Heads are found by pointer
    doubling, in as many rounds as the longest path has binary digits.
    """
    named = table(edges.withColumn("edge", F.xxhash64("lang", "w1", "w2", "w3")), "edges")
    out = named.groupBy("lang", F.col("w1").alias("a"), F.col("w2").alias("b")).agg(
        F.count("*").alias("n_out"), F.min("edge").alias("edge")
    )
    into = named.groupBy("lang", F.col("w2").alias("a"), F.col("w3").alias("b")).agg(
        F.count("*").alias("n_in"), F.min("edge").alias("before")
    )
    inner = out.where("n_out = 1").join(into.where("n_in = 1"), ["lang", "a", "b"]).where("edge <> before")
    steps = named.select("edge").join(inner.select("edge", "before"), "edge", "left")
    state = table(
        steps.select("edge", F.coalesce("before", "edge").alias("head"), F.col("before").isNotNull().cast("long").alias("dist")),
        "pointers",
    )
    real = table(state.where("dist = 0").select(F.col("edge").alias("head")), "heads")
    open_edges = state.join(real, "head", "leftanti").count()
    while open_edges:
        ahead = state.select(F.col("edge").alias("head"), F.col("head").alias("next"), F.col("dist").alias("more"))
        moved = state.join(ahead, "head").select("edge", F.col("next").alias("head"), (F.col("dist") + F.col("more")).alias("dist"))
        state = table(moved, "pointers")
        before, open_edges = open_edges, state.join(real, "head", "leftanti").count()
        if before == open_edges:  # what is left are rings
            break
    settled = state.join(real, "head", "leftsemi").select("edge", "head", "dist")
    placed = named.join(settled, "edge", "left")
    path, dist = F.coalesce("head", "edge"), F.coalesce("dist", F.lit(0))
    row = F.struct(dist.alias("dist"), "w1", "w2", "w3", "n")
    gathered = placed.groupBy("lang", path.alias("path"), F.floor(dist / PATH_EDGES).alias("part"))
    return gathered.agg(F.sort_array(F.collect_list(row)).alias("edges"))


def _largest_around(paths: DataFrame) -> DataFrame:
    """(lang, w1, w2, longer): the largest edge into or out of each node of the graph."""
    e = F.col("edges")
    between = F.transform(
        F.sequence(F.lit(1), F.size(e) - 1),
        lambda k: F.struct(
            F.get(e, k)["w1"].alias("w1"), F.get(e, k)["w2"].alias("w2"),
            F.greatest(F.get(e, k - 1)["n"], F.get(e, k)["n"]).alias("longer"),
        ),
    )
    inside = paths.where(F.size("edges") > 1).select("lang", F.inline(between))
    first, last = F.element_at(e, 1), F.element_at(e, -1)
    ends = F.array(
        F.struct(first["w1"].alias("w1"), first["w2"].alias("w2"), first["n"].alias("longer")),
        F.struct(last["w2"].alias("w1"), last["w3"].alias("w2"), last["n"].alias("longer")),
    )
    ends = paths.select("lang", F.inline(ends)).groupBy("lang", "w1", "w2").agg(F.max("longer").alias("longer"))
    return inside.unionByName(ends)


def _score(a: Column, l: Column, r: Column) -> Column:
    """floor(1000000 * a * a / (l * r)), exact: the products are decimals of up to 38 digits."""
    a, l, r = (c.cast("decimal(15,0)") for c in (a, l, r))
    squared = (a * a).cast("decimal(30,0)") * F.lit(1000000).cast("decimal(7,0)")
    return F.call_function("div", squared, l * r)


def _texts_of(docs: DataFrame, needed: DataFrame) -> DataFrame:
    """(lang, w, word) for the words ``needed`` (lang, w)."""
    few = needed.count() <= BROADCAST_WORDS
    wanted: dict[str, np.ndarray] = {}
    if few:
        found = needed.toArrow().to_pydict()
        for lang in set(found["lang"]):
            mine = [w for name, w in zip(found["lang"], found["w"], strict=True) if name == lang]
            wanted[lang] = np.sort(np.array(mine, np.int64).view(np.uint64))

    def spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _tables()
        seen = {lang: np.zeros(len(words), bool) for lang, words in wanted.items()}
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for first, data, starts, hashes, begin, row, _ in _words(batch.column(1), tables):
                if not len(hashes):
                    continue
                gaps = np.append(np.flatnonzero(tables[1][data]), len(data))
                end = np.minimum(gaps[np.searchsorted(gaps, begin)], np.append(starts, len(data))[row + 1])
                low = tables[0][data]
                codes: dict[str, int] = {}
                of_row = np.array([codes.setdefault(v, len(codes)) for v in langs[first : first + len(starts)]])
                for lang, code in codes.items():
                    here = np.flatnonzero(of_row[row] == code)
                    new, at = np.unique(hashes[here], return_index=True)
                    if few:
                        words = wanted.get(lang, np.zeros(0, np.uint64))
                        place = np.minimum(np.searchsorted(words, new), max(len(words) - 1, 0))
                        hit = np.flatnonzero(words[place] == new) if len(words) else place[:0]
                        hit = hit[~seen[lang][place[hit]]] if len(hit) else hit
                        if not len(hit):
                            continue
                        seen[lang][place[hit]] = True
                        new, at = new[hit], at[hit]
                    spots = here[at]
                    texts = [low[b:e].tobytes() for b, e in zip(begin[spots], end[spots], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(texts), pa.string()),
                            pa.array(new.view(np.int64)),
                            pa.array(texts, pa.binary()).cast(pa.string()),
                        ],
                        ["lang", "w", "word"],
                    )

    words = docs.mapInArrow(spelled, "lang string, w long, word string")
    if not few:
        words = words.join(needed, ["lang", "w"], "leftsemi")
    return words.groupBy("lang", "w").agg(F.min("word").alias("word"))


def phrases(
    docs: DataFrame, min_count: int = 10, cover_percent: int = 50, top: int = 2000,
    text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of two or three words per language.

    Texts are lower-cased in A-Z and split into pieces at ``.,;:!?`` and line ends, pieces into words at
    spaces and tabs. ``a``: occurrences of the phrase inside pieces, at least ``min_count``; ``l`` and ``r``: those of
    its two parts at the cut with the lowest ``score`` (the first of equals); ``n``: all words of the language.
    Two words that lie in a longer candidate of at least ``cover_percent`` of their
    own count are left out. Ordered by score and a, both falling, then by phrase in UTF-8.

    Null texts count as empty, a null language as ``und``. Repeated rows count each time. An empty table or
    texts without words give no row. Other columns are not looked at, whatever their names.
    """
    prepare(docs.sparkSession)
    quoted = lambda c: F.col(f"`{c}`")
    docs = docs.select(
        F.coalesce(quoted(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), quoted(text_col).alias("text")
    )
    graph = word_graph(docs, min_count)
    totals = graph.groupBy("lang").agg(F.sum("n").alias("total"))
    ones = table(graph.groupBy("lang", "w1").agg(F.sum("n").alias("f")).where(F.col("f") >= min_count), "words")
    flows = graph.where("w2 IS NOT NULL").groupBy("lang", "w1", "w2").agg(F.sum("n").alias("f"))
    twos = table(flows, "nodes")
    threes = graph.where("w3 IS NOT NULL").select("lang", "w1", "w2", "w3", "n")

    around = _largest_around(table(unary_paths(threes), "paths"))
    first, last = ones.select("lang", "w1", F.col("f").alias("f1")), ones.select("lang", F.col("w1").alias("last"), F.col("f").alias("f_last"))
    pairs = twos.join(around, ["lang", "w1", "w2"], "left")
    pairs = pairs.where(F.coalesce(F.col("longer") * 100 < F.col("f") * cover_percent, F.lit(True)))
    pairs = pairs.withColumn("last", F.col("w2")).join(first, ["lang", "w1"]).join(last, ["lang", "last"])
    a = F.col("f")
    pairs = pairs.select(
        "lang", "w1", "w2", F.lit(None).cast("long").alias("w3"), F.col("f").alias("a"),
        F.struct(_score(a, F.col("f1"), F.col("f_last")).alias("score"), F.lit(1).alias("k"),
                 F.col("f1").alias("l"), F.col("f_last").alias("r")).alias("cut"),
    )
    head = twos.select("lang", "w1", "w2", F.col("f").alias("f12"))
    tail = twos.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("f23"))
    longer = threes.withColumn("last", F.col("w3")).join(head, ["lang", "w1", "w2"]).join(tail, ["lang", "w2", "w3"])
    longer = longer.join(first, ["lang", "w1"]).join(last, ["lang", "last"])
    a = F.col("n")
    cuts = [
        F.struct(_score(a, l, r).alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))
        for k, l, r in ((1, F.col("f1"), F.col("f23")), (2, F.col("f12"), F.col("f_last")))
    ]
    longer = longer.select("lang", "w1", "w2", "w3", F.col("n").alias("a"), F.least(*cuts).alias("cut"))

    by_value = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    scored = pairs.unionByName(longer).select("lang", "w1", "w2", "w3", "a", "cut.score", "cut.l", "cut.r")
    # Ties at the end are all kept until their words are known.
    best = table(scored.withColumn("place", F.rank().over(by_value)).where(F.col("place") <= top), "best")
    needed = best.select("lang", F.explode(F.array("w1", "w2", "w3")).alias("w")).where("w IS NOT NULL").distinct()
    words = table(_texts_of(docs, table(needed, "needed")), "texts")
    for k in ("w1", "w2", "w3"):
        text = words.select("lang", F.col("w").alias(k), F.col("word").alias(f"text_{k}"))
        best = best.join(text, ["lang", k], "left")
    best = best.withColumn("phrase", F.concat_ws(" ", "text_w1", "text_w2", "text_w3"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    ranked = best.withColumn("rank", place.cast("long")).where(F.col("rank") <= top).join(totals, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")


#: The query's rows in SQL.
ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
grams AS (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3, CAST(count(*) AS BIGINT) AS c FROM starts GROUP BY ALL),
total AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM grams GROUP BY lang),
f1 AS (SELECT lang, w1, CAST(sum(c) AS BIGINT) AS f FROM grams GROUP BY ALL HAVING sum(c) >= 10),
f2 AS (SELECT lang, w1, w2, CAST(sum(c) AS BIGINT) AS f FROM grams WHERE w2 IS NOT NULL GROUP BY ALL HAVING sum(c) >= 10),
f3 AS (SELECT * FROM grams WHERE w3 IS NOT NULL AND c >= 10),
longer AS (
  SELECT lang, w1, w2, max(c) AS c FROM (
    SELECT lang, w1, w2, c FROM f3 UNION ALL SELECT lang, w2, w3, c FROM f3) GROUP BY ALL),
cuts AS (
  SELECT f2.lang, f2.w1 || ' ' || f2.w2 AS phrase, f2.f AS a, 1 AS k, x.f AS l, y.f AS r
  FROM f2 JOIN f1 x ON x.lang = f2.lang AND x.w1 = f2.w1 JOIN f1 y ON y.lang = f2.lang AND y.w1 = f2.w2
  LEFT JOIN longer g ON g.lang = f2.lang AND g.w1 = f2.w1 AND g.w2 = f2.w2
  WHERE g.c IS NULL OR 100 * g.c < 50 * f2.f
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.c, 1, x.f, y.f
  FROM f3 JOIN f1 x ON x.lang = f3.lang AND x.w1 = f3.w1
  JOIN f2 y ON y.lang = f3.lang AND y.w1 = f3.w2 AND y.w2 = f3.w3
  UNION ALL
  SELECT f3.lang, f3.w1 || ' ' || f3.w2 || ' ' || f3.w3, f3.c, 2, x.f, y.f
  FROM f3 JOIN f2 x ON x.lang = f3.lang AND x.w1 = f3.w1 AND x.w2 = f3.w2
  JOIN f1 y ON y.lang = f3.lang AND y.w1 = f3.w3),
scored AS (
  SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
