"""Set operations on whole rows and on arrays (U1-U8, F9, F10). Rows compare null-safe; order is kept by a position column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def same_row(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    return reduce(Column.__and__, (a[c].eqNullSafe(b[c]) for c in columns))


def difference(df: DataFrame, other: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows of ``df`` that ``other`` has not; repeated ones stay repeated."""
    columns = columns or [c for c in df.columns if c in other.columns]
    b = other.select(*columns).distinct()
    return df.join(b, same_row(df, b, columns), "left_anti")


def symmetric_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of one side only, those of the second first (``side`` 0, then 1)."""
    return difference(b, a).withColumn("side", F.lit(0)).unionByName(difference(a, b).withColumn("side", F.lit(1)))


def prepended(new: DataFrame, old: DataFrame) -> DataFrame:
    """Both, with the ordinal of their source."""
    return new.withColumn("source", F.lit(0)).unionByName(old.withColumn("source", F.lit(1)))


def minus_all(df: DataFrame, *others: DataFrame, columns: list[str]) -> DataFrame:
    """U4: rows that no other set has: one anti-join against their union."""
    return difference(df, reduce(DataFrame.unionByName, (o.select(*columns) for o in others)), columns)


def common(a: DataFrame, b: DataFrame) -> DataFrame:
    """U7."""
    return a.intersect(b)


def lacking(required: Column, present: Column) -> Column:
    """Required values that are not present."""
    return F.array_except(required, present)


def complete(required: Column, present: Column) -> Column:
    """Whether all required values are present."""
    return F.size(lacking(required, present)) == 0


def joined(a: Column, b: Column) -> Column:
    """U8: both lists, in order."""
    return F.concat(a, b)
