"""The scheduler as a keyed stateful stream (T-1 to T-7, X1): each task has a state of its own, which timers evict.

A task's state is what became of it: done, or failed with the record to try again. Records whose task is done are repeats
and go. A task that fails stays out of this launch; the next launch reads the failed ones from the checkpoint and offers
them again as input. A timer at the task's own time clears its state once the watermark, which trails the newest record by
the look-back, has passed it. Nothing is read or joined as a whole: a micro-batch touches the states of its own tasks.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from tidemark.operators.select import within_horizon
from tidemark.streaming.schedule import Plugin

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"  # fixed value: the store that keeps timers
STATE = "task"
DONE, FAILED = "done", "failed"


class Tasks(StatefulProcessor):
    """Works each task once. ``launch`` tells this launch from the one in which a task failed."""

    def __init__(self, keys: tuple[str, ...], ts: str, work: Callable[[dict], bool], launch: str):
        self.keys, self.ts, self.work, self.launch = keys, ts, work, launch

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(STATE, "status string, launch string, record string, until long")

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: ANN001, N802, N803
        newest = max(rows, key=lambda r: r[self.ts])
        known = self.state.get() if self.state.exists() else None
        if known and (known[0] == DONE or known[1] == self.launch):
            return
        try:
            ok = bool(self.work(newest.asDict(recursive=True)))
        except Exception:  # noqa: BLE001  a plugin's error is a failed task, not the end of the stream
            ok = False
        record = None if ok else json.dumps(newest.asDict(recursive=True), default=str)
        until = int(newest[self.ts].timestamp() * 1000)
        self.state.update((DONE if ok else FAILED, self.launch, record, until))
        self.handle.registerTimer(until)
        yield Row(**dict(zip(self.keys, key, strict=True)), **{self.ts: newest[self.ts]}, ok=ok)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: ANN001, N802, N803
        if self.state.exists() and (self.state.get()[3] or 0) <= expiredTimerInfo.getExpiryTimeInMs():  # else a later record has a later timer
            self.state.clear()
        return iter(())

    def handleInitialState(self, key: tuple, initialState: Row, timerValues) -> None:  # noqa: ANN001, N802, N803
        self.state.update((DONE, "", None, None))

    def close(self) -> None:
        pass


def failed_tasks(spark: SparkSession, checkpoint: str, schema: StructType) -> DataFrame:
    """T-7: the records of the tasks that failed, from the state of a stopped stream."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", STATE).load()
    return state.filter(F.col("value.status") == FAILED).select(F.from_json("value.record", schema).alias("r")).select("r.*")


def stream_tasks_keyed(
    stream: DataFrame, plugin: Plugin, folder: str, run: Column, done: DataFrame | None = None, late_seconds: int | None = None,
) -> StreamingQuery:
    """One launch: works the tasks of ``stream`` and those that failed in earlier launches; the outcomes (keys, ts, ok) are appended to ``folder``/out.

    Tasks at or before the horizon (``plugin.back_seconds`` before ``run``, T-1) are ignored, later ones accepted however
    late, up to ``late_seconds`` (the look-back where not given) behind the newest record, when their state goes too (T-2).
    ``done`` has the keys of tasks completed before the first launch. Of several records of a task in a micro-batch the
    newest works. T-6: outcomes and states are committed together after a micro-batch, so a launch that is cut off works its
    last micro-batch again and no other. Rows without a time are ignored. The launch ends when the input is used up (T-10).
    """
    spark, keys, ts = stream.sparkSession, list(plugin.keys), plugin.ts
    stream = stream.withColumn(ts, F.col(ts).cast("timestamp"))
    again, checkpoint = f"{folder}/again", f"{folder}/checkpoint"
    empty = spark.createDataFrame([], stream.schema)
    empty.write.mode("append").parquet(again)
    if exists(spark, f"{checkpoint}/commits"):
        failed_tasks(spark, checkpoint, stream.schema).write.mode("append").parquet(again)
    rows = stream.unionByName(spark.readStream.schema(stream.schema).parquet(again))
    late = plugin.back_seconds if late_seconds is None else late_seconds
    rows = within_horizon(rows.withWatermark(ts, f"{late} seconds"), ts, run, plugin.back_seconds)
    kinds = {f.name: f for f in stream.schema}
    out = StructType([*(kinds[k] for k in keys), kinds[ts], StructField("ok", BooleanType())])
    first = None if done is None else done.select(*keys).distinct().groupBy(*keys)
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        worked = rows.groupBy(*keys).transformWithState(Tasks(tuple(keys), ts, plugin.work, uuid.uuid4().hex), out, "Append", "EventTime", first)
        return worked.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file below ``path``, in any store that Spark reads."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop))
