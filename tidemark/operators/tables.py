"""Wide and interleaved tables from sparse variables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch

NO_INDEX = -999
ABSENT, NO_SECOND = "-" * 10, "-" * 4


def coordinates(lon: DataFrame, lat: DataFrame) -> DataFrame:
    """i0, lon, lat of two rank-1 variables, (i0, value) each, zipped by position."""
    return lon.select("i0", F.col("value").alias("lon")).join(lat.select("i0", F.col("value").alias("lat")), "i0")


def numbered(df: DataFrame, order: list) -> DataFrame:
    """``df`` with line: its rows' numbers, from 1, in a total order. No task sees the whole table.

    Rows are dealt by range and sorted within partitions; the partitions' sizes, of which there are few, give each its first
    number. The sorted table is written to the shared folder, so that both steps see the same partitions.
    """
    at = F.monotonically_increasing_id()
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_part", F.shiftright(at, 33)).withColumn("_at", at.bitwiseAND((1 << 33) - 1))
    path = scratch(df.sparkSession, "sorted")
    rows.write.parquet(path)
    rows = df.sparkSession.read.schema(rows.schema).parquet(path)
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    first = sizes.select("_part", (F.sum("n").over(Window.orderBy("_part")) - F.col("n")).alias("_first"))
    return rows.join(F.broadcast(first), "_part").withColumn("line", F.col("_first") + F.col("_at") + 1).drop("_part", "_at", "_first")  # a row for each partition


def zip_tables(first: DataFrame, second: DataFrame, order_first: list[str], order_second: list[str], suffixes: tuple[str, str] = ("1", "2")) -> DataFrame:
    """Row n of one table beside row n of the other; surplus rows of the second are ignored, missing ones are an error.

    Positions come from a total order (see ``numbered``), then the lines are an equi-join.
    """
    a = numbered(first, order_first).select(*(F.col(c).alias(c + suffixes[0]) for c in first.columns), "line")
    b = numbered(second, order_second).select(*(F.col(c).alias(c + suffixes[1]) for c in second.columns), "line", F.lit(True).alias("_there"))
    out = a.join(b, "line", "left").filter(F.when(F.col("_there").isNull(), F.raise_error(F.lit("the second table is shorter")).cast("boolean")).otherwise(True))
    shared = [c for c in first.columns if c in second.columns]
    return out.select("line", *(x for c in shared for x in (c + suffixes[0], c + suffixes[1])), *(c + suffixes[0] for c in first.columns if c not in shared), *(c + suffixes[1] for c in second.columns if c not in shared))


def located(samples: DataFrame, coords: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Samples (var, i0, i1, value, pos) with their coordinates, and those without."""
    return samples.join(coords, "i0"), samples.join(coords, "i0", "left_anti")


def wide(samples: DataFrame, variables: list[str]) -> DataFrame:
    """A row for each lon, lat and second index, a column for each variable; of repeated cells the last wins. ``wide_lines`` puts them in order."""
    keyed = samples.withColumn("i1", F.coalesce("i1", F.lit(NO_INDEX)))
    return keyed.groupBy("lon", "lat", "i1").pivot("var", variables).agg(F.max_by("value", "pos"))


def wide_lines(table: DataFrame, variables: list[str]) -> DataFrame:
    """K9: the lines of a wide table; absent cells are ten dashes, an absent second index four."""
    second = F.when(F.col("i1") == NO_INDEX, F.lit(NO_SECOND)).otherwise(F.format_string("%04d", "i1"))
    cells = [F.coalesce(F.when(F.col(v).isNotNull(), F.format_string("%010.5f", v)), F.lit(ABSENT)) for v in variables]
    return table.orderBy("lon", "lat", "i1").select(F.concat(F.concat_ws(" ", F.format_string("%07.2f", "lon"), F.format_string("%06.2f", "lat"), second, *cells), F.lit(" ")).alias("value"))


def wide_header(variables: list[str]) -> str:
    return f"{'Lon':7s} {'Lat':6s} {'Idx2':4s} " + "".join(f"{v:10s} " for v in variables)


def index_lines(coords: DataFrame) -> DataFrame:
    """K8: idx lon lat."""
    return coords.orderBy("i0").select(F.format_string("%09d %015.5f %015.5f", "i0", "lon", "lat").alias("value"))


def interleaved_lines(first: DataFrame, second: DataFrame, keys: int = 3) -> DataFrame:
    """Of two tables of lines (line_no, value) the shared leading fields, then each further field of both. Lines join on line_no."""
    a, b = (df.select("line_no", F.split(F.rtrim("value"), " +").alias(n)) for df, n in ((first, "a"), (second, "b")))
    pairs = F.zip_with(F.slice("a", keys + 1, F.greatest(F.size("a") - keys, F.lit(0))), F.slice("b", keys + 1, F.greatest(F.size("a") - keys, F.lit(0))), lambda x, y: F.concat(x, F.lit(" "), y))
    return a.join(b, "line_no").orderBy("line_no").select("line_no", F.concat(F.array_join(F.concat(F.slice("a", 1, keys), pairs), " "), F.lit(" ")).alias("value"))


def stacked(*parts: DataFrame) -> DataFrame:
    """K3: tables of lines one after the other, with the ordinal of their part."""
    return reduce(DataFrame.unionByName, (p.withColumn("part", F.lit(i)) for i, p in enumerate(parts)))
