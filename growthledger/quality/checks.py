"""Check operators. A check selects failing rows; no failing row means it passed."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RowCheck:
    """A predicate on single rows. Null counts as passing, as in a SQL WHERE."""

    name: str
    bad: Column

    def failing(self, df: DataFrame) -> DataFrame:
        return df.where(self.bad)


@dataclass(frozen=True)
class ValueCheck(RowCheck):
    """A predicate on the values of one column; it fails with each bad value once."""

    column: str

    def failing(self, df: DataFrame) -> DataFrame:
        return df.where(self.bad).groupBy(self.column).agg(F.count("*").alias("n_records"))


@dataclass(frozen=True)
class GroupCheck:
    """A check that has to look at several rows together."""

    name: str
    select_failing: Callable[[DataFrame], DataFrame]

    def failing(self, df: DataFrame) -> DataFrame:
        return self.select_failing(df)


Check = RowCheck | GroupCheck


def not_null(column: str) -> RowCheck:
    return RowCheck(f"not_null_{column}", F.col(column).isNull())


def accepted_values(column: str, values: list) -> ValueCheck:
    """Other values than these, each with its number of records; counted in rows."""
    return ValueCheck(f"accepted_values_{column}", ~F.col(column).isin(values), column)


def matches(column: str, pattern: str) -> RowCheck:
    """The whole text must match. ``\\z`` is used because ``$`` allows a trailing newline."""
    return RowCheck(f"matches_{column}", ~F.col(column).rlike(rf"\A(?:{pattern})\z"))


def expression_is_true(name: str, expression: Column) -> RowCheck:
    return RowCheck(f"expression_{name}", ~expression)


def unique(column: str) -> GroupCheck:
    """Values that occur more than once; nulls are not compared."""
    return GroupCheck(
        f"unique_{column}",
        lambda df: _repeated(df.where(F.col(column).isNotNull()), [column]),
    )


def unique_combination(*columns: str) -> GroupCheck:
    """Column combinations that occur more than once; nulls are equal to each other."""
    return GroupCheck(f"unique_combination_{'_'.join(columns)}", lambda df: _repeated(df, list(columns)))


def unique_within(owner: str, column: str) -> GroupCheck:
    """As ``unique``, for a column whose value contains that of ``owner``, so that no two owners share one.

    Where the rows are stored by owner, they are not shuffled.
    """
    return GroupCheck(
        f"unique_{column}",
        lambda df: _repeated(df.where(F.col(column).isNotNull()), [owner, column]),
    )


def _repeated(df: DataFrame, columns: list[str]) -> DataFrame:
    # The map-side partial count collapses a key with very many copies before the shuffle.
    return df.groupBy(*columns).agg(F.count("*").alias("n_records")).where(F.col("n_records") > 1)


def single_value_per(key: str, columns: dict[str, str], name: str) -> GroupCheck:
    """Keys with more than one distinct value in a column; ``columns`` maps it to its count name."""

    def failing(df: DataFrame) -> DataFrame:
        # Distinct first: it shrinks the rows to about one per key before they are
        # expanded for the two distinct counts.
        values = df.select(key, *columns).distinct()
        counts = values.groupBy(key).agg(*[F.countDistinct(c).alias(n) for c, n in columns.items()])
        return counts.where(reduce(Column.__or__, [F.col(n) > 1 for n in columns.values()]))

    return GroupCheck(name, failing)


def bad_row_counts(checks: Iterable[RowCheck]) -> list[Column]:
    """One aggregate per check, so that any number of checks costs a single scan."""
    return [F.count_if(check.bad).alias(check.name) for check in checks]


def summary(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """check, bad_count: one row per check; all row checks share one pass over ``df``."""
    checks = list(checks)
    row_checks = [c for c in checks if isinstance(c, RowCheck)]
    parts = [
        c.failing(df).agg(F.lit(c.name).alias("check"), F.count("*").alias("bad_count"))
        for c in checks
        if isinstance(c, GroupCheck)
    ]
    if row_checks:
        entries = F.array(
            *[F.struct(F.lit(c.name).alias("check"), F.col(c.name).alias("bad_count")) for c in row_checks]
        )
        parts.insert(0, df.agg(*bad_row_counts(row_checks)).select(F.inline(entries)))
    return reduce(DataFrame.unionByName, parts)
