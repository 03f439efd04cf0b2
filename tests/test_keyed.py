"""The keyed stream: repeats, failures, restarts, eviction, completed tasks."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.streaming import keyed
from tidemark.streaming.schedule import Plugin

T = dt.datetime(2024, 1, 1)
SCHEMA = "name string, dts timestamp, size int"


def add(spark, folder, *rows):
    spark.createDataFrame([(n, T + dt.timedelta(hours=h), i) for i, (n, h) in enumerate(rows)], SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")


def launch(spark, folder, work, back=86_400 * 10, run="2024-01-02", **how):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    query = keyed.stream_tasks_keyed(stream, Plugin(lambda f: f, work, ("name",), back_seconds=back), folder, F.lit(run).cast("timestamp"), **how)
    query.awaitTermination()
    return sorted((r.name, r.dts.hour, r.ok) for r in spark.read.parquet(f"{folder}/out").collect())


def test_repeats_failures_and_restart(spark, tmp_path):
    folder = str(tmp_path)
    ok = lambda row: row["name"] != "bad" and (row["name"] != "raises" or 1 / 0)
    add(spark, folder, ("a", 1), ("a", 3), ("bad", 2), ("raises", 2), ("done", 1))
    add(spark, folder, ("a", 4), ("bad", 5), ("b", 1))
    done = spark.createDataFrame([("done",)], "name string")
    first = launch(spark, folder, ok, done=done)
    assert first == [("a", 3, True), ("b", 1, True), ("bad", 2, False), ("raises", 2, False)]  # each once in this launch
    assert sorted(r.name for r in keyed.failed_tasks(spark, f"{folder}/checkpoint", spark.createDataFrame([], SCHEMA).schema).collect()) == ["bad", "raises"]
    add(spark, folder, ("c", 6), ("a", 7))
    second = launch(spark, folder, lambda row: True, done=done)
    assert sorted(set(second) - set(first)) == [("bad", 2, True), ("c", 6, True), ("raises", 2, True)]
    third = launch(spark, folder, lambda row: True, done=done)
    assert third == second  # nothing fails, nothing comes back


def test_horizon_and_eviction(spark, tmp_path):
    folder = str(tmp_path)
    add(spark, folder, ("old", 12), ("edge", 13), ("a", 14))
    add(spark, folder, ("far", 20))
    add(spark, folder, ("far2", 21))
    got = launch(spark, folder, lambda row: True, back=3600 * 11)  # the horizon is 13:00
    assert got == [("a", 14, True), ("far", 20, True), ("far2", 21, True)]
    folder += "/second"
    add(spark, folder, ("a", 14))
    add(spark, folder, ("far", 20))
    add(spark, folder, ("far2", 21))
    add(spark, folder, ("late", 15), ("a", 22))
    got = launch(spark, folder, lambda row: True, back=3600 * 11, late_seconds=3600)
    # the state of a at 14:00 went when the watermark passed it, so it works again; 15:00 is behind the watermark
    assert got == [("a", 14, True), ("a", 22, True), ("far", 20, True), ("far2", 21, True)]
