"""DuckDB SQL for joins on word shingles: all pairs that share a shingle, then what can be reached."""

from __future__ import annotations

_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {n} + 1, least(len(w), 1)) + 1)) AS i FROM split),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + {n} - 1], ' ') AS s FROM starts),
sizes AS (SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b, c = p.size AND c = q.size AS same
  FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * c >= {percent} * (p.size + q.size - c)),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN links l ON l.a = r.other),
components AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id),
around AS (SELECT a AS doc_id, min(b) FILTER (WHERE same) AS twin, count(*) AS n FROM links GROUP BY a)
SELECT d.doc_id, coalesce(z.size, 0) AS n_shingles, c.component_id,
  least(d.doc_id, coalesce(o.twin, d.doc_id)) AS class_id, {last}
FROM documents d JOIN components c USING (doc_id) LEFT JOIN sizes z USING (doc_id) LEFT JOIN around o USING (doc_id)
"""


def similar_sql(n: int, percent: int, last: str) -> str:
    """One row per document with its component over all links; ``last`` is the last column."""
    return _SQL.format(n=n, percent=percent, last=last)
