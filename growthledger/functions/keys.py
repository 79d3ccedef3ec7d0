"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands in for a null part so that keys agree with existing ones.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the text of the columns joined by ``-``; a null part has its own token."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.md5(F.concat_ws("-", *[F.coalesce(p.cast("string"), F.lit(NULL_PART)) for p in parts]))
