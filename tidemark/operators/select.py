"""Newest-per-key selection, horizons, endpoints and order.

Every tie is broken by an explicit position column, so results don't depend on the order in which Spark reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def latest_per_key(df: DataFrame, keys: list[str], ts: str, pos: str) -> DataFrame:
    """A1: of each key the row with the largest ``ts``; of equal ones the first by ``pos``.

    A numeric position takes one aggregate with map-side combine, any other a rank that is cut off before the shuffle too: a
    hot key sends one row per task. Rows with a null ``ts`` lose to all others.
    """
    if not isinstance(df.schema[pos].dataType, NumericType):
        order = Window.partitionBy(*keys).orderBy(F.col(ts).desc_nulls_last(), F.col(pos))
        return df.withColumn("_rank", F.row_number().over(order)).filter("_rank = 1").drop("_rank")
    rest = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(F.col(ts), -F.col(pos)))
    return df.groupBy(*keys).agg(best.alias("_row")).select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest)).select(*df.columns)


def latest(df: DataFrame, ts: str, pos: str, after: Column | None = None) -> DataFrame:
    """The newest row, of equal ones the first; A3: only if strictly after a floor."""
    kept = df if after is None else df.filter(F.col(ts) > after)
    return kept.orderBy(F.col(ts).desc_nulls_last(), F.col(pos)).limit(1)


def within_horizon(df: DataFrame, ts: str, run: Column, seconds: int) -> DataFrame:
    """F3, F4, T-2: rows strictly newer than ``seconds`` before the run."""
    return df.filter(F.col(ts) > run - F.make_interval(secs=F.lit(seconds)))


def endpoints(df: DataFrame, keys: list[str], value: str, pos: str) -> DataFrame:
    """The value at the first and the last position (not the least and the largest value)."""
    return df.groupBy(*keys).agg(F.min_by(value, pos).alias("first_value"), F.max_by(value, pos).alias("last_value"))


def ranked(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """A rank column within each key."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def ordered(df: DataFrame, by: str, pos: str, newest_first: bool = False) -> DataFrame:
    """A stable sort."""
    key = F.col(by).desc() if newest_first else F.col(by).asc()
    return df.orderBy(key, F.col(pos))


def single(df: DataFrame, *order: Column) -> DataFrame:
    """The one row that is assumed; an error if there are more."""
    count = F.count(F.lit(1)).over(Window.partitionBy())
    return df.limit(2).withColumn("_n", count).filter(F.when(F.col("_n") > 1, F.raise_error(F.lit("more than one row")).cast("boolean")).otherwise(True)).drop("_n").orderBy(*order)


def analysis_row(track: DataFrame) -> DataFrame:
    """The row of a track table at DELTA_T = 0, its time as DTG and its longitude signed."""
    from tidemark.functions.values import lon_signed

    return track.filter("DELTA_T = 0").withColumnRenamed("DATETIME", "DTG").withColumn("LONGITUDE", lon_signed(F.col("LONGITUDE")))


def projected(df: DataFrame, wanted: list[str], renames: dict[str, str] | None = None, dropped: list[str] = ()) -> DataFrame:  # type: ignore[assignment]
    """Chosen columns, renamed."""
    return df.drop(*dropped).select(*wanted).withColumnsRenamed(renames or {})


def with_results(pairs: DataFrame, results: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """pairs that have results, and those to skip."""
    return pairs.join(results, keys, "left_semi"), pairs.join(results, keys, "left_anti")


def key_list(tasks: DataFrame, key: str, pos: str, by: list[str]) -> DataFrame:
    """One key's values over the tasks of each group, in the order of ``pos``."""
    values = F.transform(F.array_sort(F.collect_list(F.struct(pos, key))), lambda x: x[key])
    return tasks.groupBy(*by).agg(values.alias(key))


def non_empty(files: DataFrame) -> DataFrame:
    """F13."""
    return files.filter(F.col("length") > 0)


def by_name(files: DataFrame, pattern: str, name: str = "name", negate: bool = False) -> DataFrame:
    """names that match from their start (or don't)."""
    from tidemark.functions.strings import java_pattern

    hit = F.col(name).rlike(java_pattern(pattern))
    return files.filter(~hit if negate else hit)
