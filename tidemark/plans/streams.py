"""Queries of streams: the driver's tables come in as files, and the outcome is compared with SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.catalogue import query
from tidemark.session import scratch, table
from tidemark.sources import folders, named_files, names
from tidemark.streaming.keyed import stream_tasks_keyed
from tidemark.streaming.schedule import Plugin, read_json_state, write_json_state


@query("""SELECT DISTINCT user_id, event_type FROM events WHERE ts > TIMESTAMP '2024-01-10'
AND (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM events WHERE ts <= TIMESTAMP '2024-01-05')""")
def q74_keyed_stream(spark: SparkSession, sf: str) -> DataFrame:
    """T-1, T-3, T-6, T-7, T-10, X1: tasks of users by event type; a launch over one half of the events, in which every third
    user's tasks fail, then, from its checkpoint, one over the rest. A task is in the result as often as it was done."""
    events = table(spark, sf, "events").select("user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    done = events.filter("ts <= TIMESTAMP '2024-01-05'").select("user_id", "event_type")
    folder = scratch(spark, "stream")
    for half, work in ((0, lambda row: row["user_id"] % 3 != 0), (1, lambda row: True)):
        table(spark, sf, "events").filter(F.col("event_id") % 2 == half).select(*events.columns[:2], F.col("ts").cast("timestamp").alias("ts")).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(events.schema).parquet(f"{folder}/in")
        plugin = Plugin(lambda f: f, work, ("user_id", "event_type"), "ts", 86_400)
        run = F.lit("2024-01-11").cast("timestamp")
        stream_tasks_keyed(stream, plugin, folder, run, done, late_seconds=86_400 * 60).awaitTermination()
    return spark.read.parquet(f"{folder}/out").filter("ok").select("user_id", "event_type")


@query("""SELECT user_id, event_type, strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS dts FROM events GROUP BY user_id, event_type""")
def q95_json_state(spark: SparkSession, sf: str) -> DataFrame:
    """Completed tasks in a JSON file, written whole and read back."""
    tasks = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.date_format(F.max("ts"), "yyyy-MM-dd'T'HH:mm:ss").alias("dts"))
    path = scratch(spark, "state")
    write_json_state(tasks, path, "completed.json", ["dts", "user_id", "event_type"])
    return read_json_state(spark, f"{path}/completed.json", "user_id long, event_type string, dts string")


@query("""SELECT DISTINCT (hour(ts) // 6 * 6)::INT AS hour, (event_id % 385)::INT AS fhour, strftime(date_trunc('day', ts) + to_hours(hour(ts) // 6 * 6), '%Y-%m-%d %H:00:00') AS run
FROM events WHERE event_type = 'purchase' AND event_id % 385 < 100""")
def q96_matched_files(spark: SparkSession, sf: str) -> DataFrame:
    """Forecast files in a folder, those whose names match, and the fields of their names."""
    hour = F.floor(F.hour("ts") / 6) * 6
    name = F.concat(F.lit("gfs.t"), F.format_string("%02d", hour), F.lit("z.pgrb2.1p00.f"), F.format_string("%03d", F.col("event_id") % 385), F.lit("."), F.date_format("ts", "yyyyMMdd"))
    files = table(spark, sf, "events").filter("event_type = 'purchase'").select(name.alias("file")).distinct().select("file", F.lit(0).cast("long").alias("pos"), F.lit("x").alias("value"))
    path = scratch(spark, "forecasts")
    named_files.write_text_files(files, path)
    found = names.forecast.read(folders.listed(spark, [path], r"gfs\.t\d{2}z\.pgrb2\.1p00\.f0\d{2}\."))
    return found.select("hour", "fhour", F.date_format("runDTG", "yyyy-MM-dd HH:mm:ss").alias("run"))
