"""Raw CSV input: header-bound, all text, null tokens mapped."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quotedcsv import read_records
from .schemas import RAW_COLUMNS

# Cell texts that mean "no value" (pandas' documented default list).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_RECORD = "_malformed_record"
_OPTIONS = {"escape": '"'}
# A field that no record holds.
_MARK = "\x1eend of record\x1e"


def read_raw_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: list[str] = RAW_COLUMNS,
    multiline: bool = False,
) -> DataFrame:
    """Read CSV files with a header row as text columns, selected by header name.

    A missing column fails, an additional one is ignored, a short record is padded with
    nulls and a record with more fields than the header aborts the read. All files must
    share one header. A file is read in splits; a quote that is still open at the end of a
    line aborts the read. ``multiline`` allows line breaks inside quotes, at the price of
    another pass over the text, which runs at once.
    """
    reader = spark.read.options(header=True, multiLine=multiline, **_OPTIONS)
    header = reader.csv(path).columns
    missing = [name for name in columns if name not in header]
    if missing:
        raise ValueError(f"CSV header lacks columns {missing}; it has {header}")
    if multiline:
        return _parsed(read_records(spark, path), header).select(*[_value(name) for name in columns])

    # The header order becomes the schema, so that binding by position is right and
    # every further file is checked against it.
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*header, _RECORD]])
    rows = reader.options(enforceSchema=False, columnNameOfCorruptRecord=_RECORD).schema(schema).csv(path)
    return rows.filter(_whole(header)).select(*[_value(name) for name in columns])


def _value(name: str) -> Column:
    return F.when(~F.col(name).isin(NULL_TOKENS), F.col(name)).alias(name)


def _marked(record: Column, names: list[str]) -> Column:
    """The record's fields under these names, with a mark as one more field at its end."""
    options = {"multiLine": "true", **_OPTIONS}
    return F.from_csv(F.concat(record, F.lit("," + _MARK)), ", ".join(f"{n} string" for n in names), options)


def _parsed(records: DataFrame, header: list[str]) -> DataFrame:
    """Records of text parsed one by one; each file's first record has to be the header.

    The mark stands right after the last field. Where it is missing, the record has too many
    fields, or the parser found its end somewhere else.
    """
    names = [f"f{k}" for k in range(len(header) + 1)]
    # As a generator's output the fields are parsed once; conditions are not moved below it.
    fields = records.select("first", "text", F.inline(F.array(_marked(F.col("text"), names))))
    fits = F.coalesce(reduce(Column.__or__, [F.col(n) == _MARK for n in names]), F.lit(False))
    is_header = reduce(
        Column.__and__, [F.lower(F.col(n)).eqNullSafe(F.lit(h.lower())) for n, h in zip(names, header, strict=False)]
    )
    kept = (
        F.when(~fits, _error(F.lit(f"CSV record has more than {len(header)} fields, or quotes that end elsewhere: "), "text"))
        .when(~F.col("first"), True)
        .when(is_header & (F.col(names[-1]) == _MARK), False)
        .otherwise(_error(F.lit(f"CSV header is not {header}: "), "text"))
    )
    return fields.where(kept).select(
        *[F.when(F.col(n) != _MARK, F.col(n)).alias(h) for n, h in zip(names, header, strict=False)]
    )


def _error(message: Column, text: str) -> Column:
    return F.raise_error(F.concat(message, F.coalesce(F.col(text), F.lit("")))).cast("boolean")


def _whole(header: list[str]) -> Column:
    """True, or an error for a record with too many fields or an open quote.

    Only records whose field count differs from the header are looked at. Their text is
    parsed once more by the CSV parser itself, with a mark as one more field at its end and two
    more columns: the mark stands right after the last field, in the first of them for
    the longest record that is allowed. An open quote swallows the mark.
    """
    record = F.col(_RECORD)
    names = [f"f{k}" for k in range(len(header) + 1)]
    fields = _marked(record, names)
    fits = reduce(Column.__or__, [fields[n] == _MARK for n in names])
    # Naming all columns here makes the reader look at all fields, also for a bare count().
    message = F.concat(
        F.lit("CSV record with the values '"), F.concat_ws(",", *header),
        F.lit(
            f"' has more than {len(header)} fields or a quote that the line doesn't close "
            "(read files with line breaks inside quotes with --multi-line): "
        ),
        F.coalesce(record, F.lit("")),
    )
    fine = record.isNull() | F.coalesce(fits, F.lit(False))
    # A quote that is open in the last field doesn't show there: the parser closes it at
    # the end of the line. It shows in the rest, a short record with an odd quote.
    quotes = F.length(record) - F.length(F.replace(record, F.lit('"'), F.lit("")))
    fine = fine & F.coalesce(quotes % 2 == 0, F.lit(True))
    return F.when(fine, True).otherwise(F.raise_error(message).cast("boolean"))
