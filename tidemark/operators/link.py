"""Joins of data sets on shared keys (J1-J3, J9, J11-J16), each with an explicit output for what doesn't match."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def link_all(datasets: dict[str, DataFrame], key: str, pos: str) -> DataFrame:
    """One row for each key that every data set has, with a struct column per data set; of repeated keys the last by ``pos`` wins.

    All sets go through one shuffle: they are stacked, and one aggregate picks each set's last row.
    """
    names = list(datasets)
    stacked = [df.select(F.col(key), F.col(pos).alias("_pos"), *(F.struct(*(c for c in df.columns if c not in (key, pos))).alias(n) if n == name else F.lit(None).cast(datasets[n].select(F.struct(*(c for c in datasets[n].columns if c not in (key, pos))).alias("x")).schema["x"].dataType).alias(n) for n in names)) for name, df in datasets.items()]
    rows = reduce(DataFrame.unionByName, stacked).filter(F.col(key).isNotNull())
    last = rows.groupBy(key).agg(*(F.max_by(n, F.when(F.col(n).isNotNull(), F.col("_pos"))).alias(n) for n in names))
    return last.filter(reduce(Column.__and__, (F.col(n).isNotNull() for n in names)))


def split_linked(df: DataFrame, links: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is linked, and the others (a null key is not linked)."""
    keys = links.select(key).distinct()
    return df.join(keys, key, "left_semi"), df.join(keys, key, "left_anti")


def linked_names(inputs: DataFrame, files: DataFrame, links: DataFrame, pos: str = "pos", name: str = "name", key: str = "key", out: str = "out_name") -> tuple[DataFrame, DataFrame]:
    """Input names to keys to linked names, in input order; misses apart. inputs (pos, name), files (name, key), links (key, out_name)."""
    found = inputs.join(files.select(name, key), name, "left").join(links.select(key, out), key, "left")
    return found.filter(F.col(out).isNotNull()).orderBy(pos), found.filter(F.col(out).isNull()).select(pos, name)


def reduced_scan(second: DataFrame, links: DataFrame, hits: DataFrame, file_col: str = "file", key: str = "key") -> DataFrame:
    """Of the second data set only files whose key the first one's hits have; the keys are pushed into the scan as a semi-join."""
    return second.join(links.join(hits.select(key).distinct(), key, "left_semi").select(file_col).distinct(), file_col, "left_semi")


def same_count(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """The keys for which both sides have the same number of files."""
    a, b = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n)) for df, n in ((first, "n1"), (second, "n2")))
    return a.join(b, keys).filter("n1 = n2").select(*keys)


def every_pair(a: DataFrame, b: DataFrame) -> DataFrame:
    """Storms by satellites: both are short lists."""
    return a.crossJoin(b)


def with_reason(df: DataFrame, lookups: list[tuple[DataFrame, list[str], str]]) -> tuple[DataFrame, DataFrame]:
    """Rows that all dimension tables know, with their columns; and the others, with the reason (the first that fails).

    Each lookup is (dimension, keys, reason). Keys of a dimension must be unique.
    """
    out, reasons = df, []
    for i, (dim, keys, reason) in enumerate(lookups):
        out = out.join(dim.withColumn(f"_hit{i}", F.lit(True)), keys, "left")
        reasons.append(F.when(F.col(f"_hit{i}").isNull(), F.lit(reason)))
    out = out.withColumn("reason", F.coalesce(*reasons)).drop(*(f"_hit{i}" for i in range(len(lookups))))
    return out.filter("reason IS NULL").drop("reason"), out.filter("reason IS NOT NULL").select(*df.columns, "reason")


def expected_outputs(files: DataFrame, suffixes: DataFrame, kind: str, name: Column) -> DataFrame:
    """Each file's expected output names: its own name and every suffix of its kind. suffixes: (kind, suffixes array)."""
    return files.join(suffixes, kind).select("*", F.explode("suffixes").alias("suffix")).withColumn("expected", F.concat(name, F.lit("."), F.col("suffix"))).drop("suffixes")


def missing_outputs(expected: DataFrame, listing: DataFrame, name: str = "name") -> DataFrame:
    """Expected names that no file has."""
    return expected.join(listing.select(F.col(name).alias("expected")).distinct(), "expected", "left_anti")


def name_mismatch(configured: DataFrame, present: DataFrame, name: str = "name") -> DataFrame:
    """Names on one side only."""
    return configured.select(name).exceptAll(present.select(name)).withColumn("side", F.lit("configured")).unionByName(present.select(name).exceptAll(configured.select(name)).withColumn("side", F.lit("present")))
