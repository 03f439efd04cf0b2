"""A scheduler with persisted state: tasks from new files, a strict horizon, no repeats (T-1 to T-10, U4, S18, K7, X1).

``plan_tasks`` is one DataFrame function for batch and stream. The state is a table of completed tasks; each task that
succeeds adds its keys at once, so a failed task comes back in the next run, and one that was done before a crash doesn't.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.scan import segmented_scan
from tidemark.operators.select import within_horizon
from tidemark.operators.sets import minus_all
from tidemark.sources.named_files import write_text_files


@dataclass(frozen=True)
class Plugin:
    """What a task type provides. tasks: files -> task records; work: one task record (a dict) -> whether it succeeded."""

    tasks: Callable[[DataFrame], DataFrame]
    work: Callable[[dict], bool]
    keys: tuple[str, ...]
    ts: str = "dts"
    back_seconds: int = 43_200


def plan_tasks(found: DataFrame, done: DataFrame, keys: list[str], ts: str, run: Column, back_seconds: int) -> DataFrame:
    """Tasks strictly within the horizon that are not done, each once, newest first."""
    fresh = minus_all(within_horizon(found, ts, run, back_seconds), done, columns=keys)
    return fresh.dropDuplicates(keys).orderBy(F.col(ts).desc(), *keys)


def purged(state: DataFrame, ts: str, run: Column, back_seconds: int) -> DataFrame:
    """T-2: the state without tasks at or before the horizon."""
    return within_horizon(state, ts, run, back_seconds)


def state_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The completed tasks; none where there is no readable table."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def read_json_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The completed tasks of a JSON file, an array of objects; none where there is no such file or it can't be read as such.

    Objects are open: fields beyond the schema are ignored, missing ones null. The file is one value, as its format demands.
    """
    try:
        rows = spark.read.option("multiLine", True).schema(f"{schema}, _corrupt string").option("columnNameOfCorruptRecord", "_corrupt").json(path)
        found = rows.withColumn("_bad", F.count("_corrupt").over(Window.partitionBy(F.input_file_name())))
        return found.filter("_bad = 0").drop("_corrupt", "_bad")
    except AnalysisException:
        return spark.createDataFrame([], schema)


def write_json_state(tasks: DataFrame, folder: str, name: str, order: list[str]) -> None:
    """The tasks as one JSON file, an array of objects in the order of ``order``; a file of that name is replaced at once."""
    numbered = segmented_scan(tasks.select(F.to_json(F.struct(*tasks.columns)).alias("value"), *(F.col(c).alias(f"o_{c}") for c in order)), [], [F.col(f"o_{c}") for c in order], ordinal="pos")
    lines = numbered.select("pos", F.concat(F.when(F.col("pos") == 1, " ").otherwise(","), "value").alias("value"))
    ends = tasks.sparkSession.createDataFrame([(0, "["), ((1 << 63) - 1, "]")], "pos long, value string")
    write_text_files(lines.unionByName(ends).withColumn("file", F.lit(name)), folder)


def coverage_windows(events: DataFrame, ts: str, length: str = "12 hours", every: str = "1 hour") -> DataFrame:
    """T-9: how many rows each sliding window covers."""
    return events.groupBy(F.window(ts, length, every).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def run_once(spark: SparkSession, files: DataFrame, plugin: Plugin, state_path: str, run: Column) -> DataFrame:
    """One pass of a batch scheduler: plan, work, state. Returns the tasks with their outcome.

    Tasks work where Spark has dealt them, the newest first in each partition. T-6: every task that succeeds adds its own
    row to the state before the next one begins, so a run that is cut off forgets none of them; a task may run twice (at
    least once), which the state, a set, doesn't mind. T-2: at the end, rows at or before the horizon leave the state.
    """
    found = plugin.tasks(files)
    kept = [f for f in found.schema.fields if f.name in {*plugin.keys, plugin.ts}]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    done = state_table(spark, state_path, schema)
    planned = plan_tasks(found, done, list(plugin.keys), plugin.ts, run, plugin.back_seconds)
    names = [f.name for f in kept]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for i, row in enumerate(batch.to_pylist()):
                ok.append(bool(plugin.work(row)))
                if ok[-1]:
                    add_to_state(state_path, pa.Table.from_batches([batch.slice(i, 1)]).select(names))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(ok)], names=[*names, "ok"])

    dealt = planned.repartition(*plugin.keys).sortWithinPartitions(F.col(plugin.ts).desc(), *plugin.keys)
    outcome = dealt.mapInArrow(work, f"{schema}, ok boolean").toArrow()  # tasks of one horizon; collected so that none works twice
    evict(spark, state_path, schema, plugin, run)
    return spark.createDataFrame(outcome).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in kept), "ok")


def state_files(state_path: str) -> tuple[fs.FileSystem, str, list[str]]:
    system, path = fs.FileSystem.from_uri(state_path if "://" in state_path or state_path.startswith("file:") else f"file://{state_path}")
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return system, path, [f.path for f in found if f.base_name.endswith(".parquet")]


def add_to_state(state_path: str, rows: pa.Table) -> None:
    """T-6: a file of its own, whole or not at all: readers skip names that begin with a dot."""
    system, path, _ = state_files(state_path)
    system.create_dir(path, recursive=True)
    name = uuid.uuid4().hex
    with system.open_output_stream(f"{path}/.{name}") as out:
        pq.write_table(rows, out)
    system.move(f"{path}/.{name}", f"{path}/{name}.parquet")


def evict(spark: SparkSession, state_path: str, schema: str, plugin: Plugin, run: Column) -> None:
    """T-2, K7: the files of the state as one table without tasks at or before the horizon. The old files go last, so a crash leaves repeats only."""
    system, _, old = state_files(state_path)
    if old:
        purged(spark.read.schema(schema).parquet(*old), plugin.ts, run, plugin.back_seconds).distinct().write.mode("append").parquet(state_path)
        for file in old:
            system.delete_file(file)


def stream_tasks(stream: DataFrame, keys: list[str], ts: str, back_seconds: int, handle: Callable[[DataFrame, int], None], checkpoint: str, run: Column | None = None, done: Callable[[], DataFrame] | None = None) -> StreamingQuery:
    """The same as a stream: late rows beyond the watermark, repeats within it and tasks that ``done`` has (T-3) go, then ``handle`` gets each micro-batch newest first.

    ``done`` is asked for the completed tasks (with ``keys``) at each micro-batch. ``ts`` is cast to TIMESTAMP, which
    watermarks need. The query stops when the available input is used up (T-10).
    """
    rows = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, f"{back_seconds} seconds").dropDuplicatesWithinWatermark(keys)

    def batch(df: DataFrame, number: int) -> None:
        kept = df if run is None else within_horizon(df, ts, run, back_seconds)
        kept = kept if done is None else minus_all(kept, done(), columns=keys)
        handle(kept.orderBy(F.col(ts).desc(), *keys), number)

    return rows.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
