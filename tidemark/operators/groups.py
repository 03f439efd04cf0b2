"""Groups that collect in order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_order(value: Column, pos: Column) -> Column:
    """The values of a group by position."""
    return F.transform(F.array_sort(F.collect_list(F.struct(pos.alias("p"), value.alias("v")))), lambda x: x["v"])


def task_records(files: DataFrame, keys: list[str], lists: list[str], scalars: list[str], pos: str) -> DataFrame:
    """A4, A5: one record per key: lists collected in order, of scalars the last."""
    return files.groupBy(*keys).agg(*(in_order(F.col(c), F.col(pos)).alias(c) for c in lists), *(F.max_by(c, pos).alias(c) for c in scalars))


def multi_values(pairs: DataFrame, key: str = "key", value: str = "value", pos: str = "pos") -> DataFrame:
    """Each key's values in order, and whether there is but one."""
    return pairs.groupBy(key).agg(in_order(F.col(value), F.col(pos)).alias("values")).withColumn("single", F.size("values") == 1)


def by_rank(variables: DataFrame, name: str = "name", dims: str = "dims") -> DataFrame:
    """Names by their number of dimensions."""
    return variables.groupBy(F.size(dims).alias("rank")).agg(F.array_sort(F.collect_list(name)).alias("names"))


def distinct_rows(df: DataFrame, *keys: str) -> DataFrame:
    """A6."""
    return df.select(*keys).distinct()


def distinct_values(value: Column) -> Column:
    """A10: sorted."""
    return F.array_sort(F.collect_set(value))
