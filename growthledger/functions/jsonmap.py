"""JSON object columns: building, field access, key tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_object(**fields: Column) -> Column:
    """JSON text with the given keys in order; a null value stays as a ``null`` key."""
    named = [value.alias(key) for key, value in fields.items()]
    return F.to_json(F.struct(*named), {"ignoreNullFields": "false"})


def iso_timestamp(when: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS[.ffffff]`` without trailing zeros in the fraction."""
    return F.translate(when.cast("string"), " ", "T")


def json_text(document: Column, key: str) -> Column:
    """Field as text; null when the key is missing or its value is null.

    For strings and null tests: Spark spells numbers anew. Use ``json_number`` for those.
    """
    return F.get_json_object(document, f"$.{key}")


def json_number(document: Column, key: str, precision: int = 38, scale: int = 10) -> Column:
    """Field as an exact decimal; text that is not a number is an error."""
    schema = f"`{key}` decimal({precision}, {scale})"
    return F.from_json(document, schema, {"mode": "FAILFAST"})[key]


def has_json_key(document: Column, key: str) -> Column:
    """Whether the key exists, also when its value is null."""
    return F.array_contains(F.json_object_keys(document), key)
