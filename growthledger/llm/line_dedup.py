"""Removes lines that many sites share, with DataFrame functions only.

The spread of a line is its number of distinct sites. One HyperLogLog sketch per line hash,
merged by the aggregation, estimates it; lines near the threshold, where the estimate may
err, get an exact distinct count. The first occurrence of a line (by id) stays, so that no
content leaves the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import table

#: log2 of the sketch's registers, and the relative error that counts as near.
SKETCH_K = 12
NEAR = 0.05


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _occurrences(docs: DataFrame, min_words: int) -> DataFrame:
    """(line, site, id, key, place) of every line that is long enough."""
    lines = docs.select("site", "id", "key", F.posexplode(_lines(F.col("text"))).alias("place", "text"))
    trimmed = F.trim("text")
    # Blank lines are no lines, though splitting them gives a part or two.
    long_enough = trimmed.rlike(r"\S") & (F.size(F.split(trimmed, r"\s+")) >= min_words)
    return lines.where(long_enough).select(F.xxhash64(trimmed).alias("line"), "site", "id", "key", "place")


def spread_lines(occurrences: DataFrame, min_sites: int) -> DataFrame:
    """(line, first): the lines of at least ``min_sites`` sites and where they occur first."""
    # Rows without id come last.
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "place")).alias("first")
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg("site", SKETCH_K)).alias("sites")
    estimated = table(occurrences.groupBy("line").agg(sketch, first), "spread")
    band = max(1, math.ceil(NEAR * min_sites))
    sure = estimated.where(F.col("sites") > min_sites + band).select("line", "first")
    near = estimated.where(F.col("sites").between(min_sites - band, min_sites + band)).select("line", "first")
    sites = occurrences.join(near.select("line"), "line", "leftsemi").select("line", "site").distinct()
    exact = sites.groupBy("line").agg(F.count("*").alias("sites")).where(F.col("sites") >= min_sites)
    return sure.unionByName(near.join(exact.select("line"), "line", "leftsemi"))


def line_dedup(
    docs: DataFrame, min_sites: int = 10, min_words: int = 1,
    id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
) -> DataFrame:
    """``docs`` without repeated lines of at least ``min_sites`` sites, and n_removed (int).

    Lines are compared without spaces at their ends; blank lines and lines under ``min_words`` words
    stay. The first occurrence by (id, position) stays, in every row that repeats that
    document. Null texts stay null and rows without id count after all others; a null site
    is a site. A text whose lines all go becomes empty. A column of ``docs`` that is
    called n_removed is replaced.
    """
    keyed = docs.drop("n_removed").select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "n_removed"]).alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").alias("text"),
        F.coalesce(F.col(f"`{site_col}`").cast("string"), F.lit("")).alias("site"),
    ).withColumn("key", F.xxhash64("site", "text"))
    occurrences = table(_occurrences(keyed, min_words), "lines")

    repeated = occurrences.join(spread_lines(occurrences, min_sites), "line")
    here = F.struct(F.col("id").isNull().alias("no_id"), "id", "key", "place")
    gone = repeated.where(here != F.col("first")).groupBy(F.struct("id", "key").alias("of"))
    gone = gone.agg(F.sort_array(F.collect_set("place")).alias("gone"))

    lines = _lines(F.col("text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    shorter = F.array_join(F.transform(kept, lambda k: F.get(lines, k)), "\n")
    joined = keyed.withColumn("of", F.struct("id", "key")).join(gone, "of", "left")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(shorter)
    names = [c for c in docs.columns if c != "n_removed"]
    return joined.select(
        *[text.alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in names],
        F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"),
    )


#: The query's rows in SQL: doc_id, text, n_removed.
ORACLE = """
WITH lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS place
  FROM documents),
long AS (SELECT *, trim(line) AS t FROM lines WHERE regexp_matches(trim(line), '\\S')),
spread AS (
  SELECT t, min(struct_pack(d := doc_id, p := place)) AS first
  FROM long GROUP BY t HAVING count(DISTINCT source) >= 10),
gone AS (
  SELECT doc_id, place FROM long JOIN spread USING (t)
  WHERE struct_pack(d := doc_id, p := place) <> first),
kept AS (
  SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.place) FILTER (WHERE g.place IS NULL) AS text,
         CAST(count(g.place) AS INTEGER) AS n_removed
  FROM lines l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.place = g.place GROUP BY l.doc_id)
SELECT d.doc_id, CASE WHEN k.n_removed > 0 THEN coalesce(k.text, '') ELSE d.text END AS text,
       coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
