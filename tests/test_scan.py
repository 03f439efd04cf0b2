"""Segmented scans against plain loops: keys over many tasks, nulls, empty tables, clashing names."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import scan


def plain(rows):
    """rows of (key, at, head): ordinal, filled head and rows since it."""
    out, state = [], {}
    for key, at, head in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        n, last, stood = state.get(key, (0, None, None))
        n += 1
        if head is not None:
            last, stood = head, n
        state[key] = (n, last, stood)
        out.append((key, at, head, n, last, None if stood is None else n - stood))
    return sorted(out, key=str)


@pytest.mark.parametrize("share", [0.02, 0.6])
def test_ranges_equal_a_loop(spark, share, monkeypatch):
    draw = random.Random(3)
    rows = [(draw.choice([None, 1, 2, *range(50)]) if draw.random() > 0.5 else 7, i, f"h{i}" if draw.random() < share else None) for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        df = spark.createDataFrame(rows, "key int, at int, head string").repartition(5)
        out = scan.segmented_scan(df, ["key"], [F.col("at")], ordinal="n", fill={"last": "head"}, since={"gone": "head"})
        got = [tuple(r) for r in out.collect()]
        parts = scan.local_scans(df.repartitionByRange(8, "key", "at").sortWithinPartitions("key", "at"), ["key"], ["head"], None).filter("key = 7 AND NOT _sum")
        counts = [r["count"] for r in parts.groupBy("_part").count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(got, key=str) == plain(rows)
    assert len(counts) >= 4 and max(counts) < 0.5 * sum(counts)  # the hot key stands in several tasks


def test_parts_are_scanned_as_they_lie(spark):
    rows = [("a", 0, 1, None), ("a", 0, 2, "x"), ("b", 0, 3, "y"), ("a", 5, 6, None), ("b", 9, 10, None), ("a", 7, 8, "z"), ("a", 9, 10, None)]
    df = spark.createDataFrame(rows, "file string, start long, line long, head string").coalesce(1)
    out = scan.segmented_scan(df, ["file"], part="start", ordinal="n", fill={"last": "head"}, since={"gone": "head"})
    assert sorted((r.file, r.line, r.n, r.last, r.gone) for r in out.collect()) == [
        ("a", 1, 1, None, None), ("a", 2, 2, "x", 0), ("a", 6, 3, "x", 1), ("a", 8, 4, "z", 0), ("a", 10, 5, "z", 1), ("b", 3, 1, "y", 0), ("b", 10, 2, "y", 1),
    ]


def test_defined_results(spark):
    empty = spark.createDataFrame([], "key int, at int, head string")
    assert scan.segmented_scan(empty, ["key"], [F.col("at")], ordinal="n", fill={"last": "head"}).columns == ["key", "at", "head", "n", "last"]
    assert scan.segmented_scan(empty, ["key"], [F.col("at")], ordinal="n").count() == 0
    flag = spark.createDataFrame([(1, 1, None), (1, 2, True), (1, 3, None), (2, 1, None)], "key int, at int, flag boolean")
    sticky = scan.segmented_scan(flag, ["key"], [F.col("at")], fill={"on": "flag"})
    assert sorted((r.key, r["at"], r.on) for r in sticky.collect()) == [(1, 1, None), (1, 2, True), (1, 3, True), (2, 1, None)]
    with pytest.raises(ValueError, match="in the way"):
        scan.segmented_scan(flag.withColumn("_rows", F.lit(1)), ["key"], [F.col("at")], ordinal="n")
    with pytest.raises(ValueError, match="order or part"):
        scan.segmented_scan(flag, ["key"], ordinal="n")
