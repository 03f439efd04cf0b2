"""The task types that come with the engine (X2): storm products, geostationary channels, dust archives, forecast files.

Each turns a listing (path, name, modified; see ``sources.names``) into task records; ``registry.PLUGINS`` has them by name,
and ``streaming.schedule`` runs them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.strings import forecast_name, track_name
from tidemark.functions.times import job_coverage
from tidemark.operators.groups import in_order, task_records
from tidemark.operators.link import with_reason
from tidemark.operators.select import latest, within_horizon
from tidemark.operators.sets import complete
from tidemark.plans.registry import PLUGINS
from tidemark.sources import names
from tidemark.streaming.schedule import Plugin

# Look-back of each task type in seconds.
LOOK_BACK = {"storm": 43_200, "forecast": 43_200, "geostationary": 3_600, "dust": 900}


def storm_tasks(tracks: DataFrame, forecasts: DataFrame, images: DataFrame, soundings: DataFrame, run: Column, done_runs: DataFrame | None = None, back: int = LOOK_BACK["storm"]) -> DataFrame:
    """At most one task for the run's hour: the files modified within the look-back and the newest forecast run after it.

    No task when any input is missing (F8) or the hour is among ``done_runs`` (dts) already (F11).
    """
    recent = lambda df: within_horizon(df, "modified", run, back).agg(in_order(F.col("path"), F.struct("dir_pos", "name")).alias("paths"))
    after = run - F.make_interval(secs=F.lit(back))
    forecast = names.forecast_quarter.read(forecasts)
    newest = latest(forecast, "DTS", "path", after).select(F.col("path").alias("gfs"))
    parts = [recent(df).select(F.col("paths").alias(n)) for df, n in ((tracks, "tracks"), (images, "images"), (soundings, "soundings"))]
    task = newest
    for part in parts:  # one row each
        task = task.join(part, F.lit(True))
    window = job_coverage(run, back)
    task = task.select(window["end"].alias("dts"), window["start"].alias("job_coverage_start"), window["end"].alias("job_coverage_end"), "tracks", "gfs", "images", "soundings")
    task = task.filter((F.size("tracks") > 0) & (F.size("images") > 0) & (F.size("soundings") > 0))
    return task.join(done_runs.select("dts"), "dts", "left_anti") if done_runs is not None else task


def storm_control(task: DataFrame, tracks: DataFrame) -> DataFrame:
    """The operational names of a storm task's files, as control-file rows (key, value)."""
    t = task.select(F.explode("tracks").alias("path")).join(tracks, "path")
    basin = F.regexp_extract("name", r"^a(\w{2})\d{6}\.dat", 1)
    rows = t.select(F.lit("adeck_input").alias("key"), track_name(F.col("name"), basin, F.col("modified")).alias("value"))
    g = names.forecast_quarter.read(task.select(F.element_at(F.split("gfs", "/"), -1).alias("name")))
    return rows.unionByName(g.select(F.lit("gfs_input").alias("key"), forecast_name(F.col("DTS"), F.col("fcst")).alias("value")))


def geostationary_tasks(files: DataFrame, headers: DataFrame, channels: DataFrame, sectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Task records by time and satellite, and the rejected files with their reason.

    headers (path, num_line, num_elem) of the files; channels (channel, kind) and sectors (satellite, sector_id,
    sector_name) are dimension tables.
    """
    found = names.geostationary.read(files).join(headers, "path", "left").withColumn("sector_id", F.concat_ws("x", "num_line", "num_elem"))
    satellites = sectors.select("satellite").distinct()
    headed = found.filter("num_line IS NOT NULL AND num_elem IS NOT NULL").select("path").distinct()
    kept, rejected = with_reason(found, [(satellites, ["satellite"], "satellite not defined"), (channels, ["channel"], "channel not defined"), (headed, ["path"], "line or element count not found"), (sectors, ["satellite", "sector_id"], "sector not defined")])
    rows = kept.withColumn("pos", F.struct("dir_pos", "name")).withColumn("sector", F.struct(F.col("sector_name").alias("name"), F.col("sector_id").alias("id"), F.col("num_line").alias("lines"), F.col("num_elem").alias("elems")))
    tasks = task_records(rows, ["DTS", "satellite"], ["channel", "path"], ["sector"], "pos")
    return tasks.select(F.col("DTS").alias("dts"), "satellite", F.col("channel").alias("channels"), F.col("path").alias("files"), "sector"), rejected


def ready(tasks: DataFrame, required: list[str]) -> DataFrame:
    """tasks that have every channel."""
    return tasks.filter(complete(F.array(*map(F.lit, required)), F.col("channels")))


def dust_tasks(files: DataFrame) -> DataFrame:
    """One task for each path."""
    return names.dust.read(files).select(F.col("DTS").alias("dts"), F.col("path").alias("file")).distinct()


def forecast_tasks(files: DataFrame) -> DataFrame:
    """A5: one task for each time and forecast hour."""
    rows = names.forecast_quarter.read(files).withColumn("pos", F.struct("dir_pos", "name")).withColumn("hour", F.col("fcst"))
    tasks = task_records(rows, ["DTS", "hour"], ["fcst", "path"], [], "pos")
    return tasks.select(F.col("DTS").alias("dts"), "hour", "fcst", F.col("path").alias("files"))


def not_yet(task: dict) -> bool:
    """Work that isn't given: the task counts as failed, so it comes back."""
    return False


def storm_plugin(run: Column, work: Callable[[dict], bool] = not_yet) -> Plugin:
    """Files are one listing with a column ``input`` that tells tracks, forecasts, images and soundings apart."""

    def tasks(files: DataFrame) -> DataFrame:
        of = lambda kind: files.filter(F.col("input") == kind).drop("input")
        return storm_tasks(of("tracks"), of("forecasts"), of("images"), of("soundings"), run)

    return Plugin(tasks, work, ("dts",), back_seconds=LOOK_BACK["storm"])


def geostationary_plugin(headers: DataFrame, channels: DataFrame, sectors: DataFrame, required: list[str], work: Callable[[dict], bool] = not_yet) -> Plugin:
    """Only tasks that have every required channel."""
    return Plugin(lambda files: ready(geostationary_tasks(files, headers, channels, sectors)[0], required), work, ("dts", "satellite"), ts="dts", back_seconds=LOOK_BACK["geostationary"])


#: Plugins, and makers of those that need more than a listing.
PLUGINS |= {
    "storm": storm_plugin,
    "geostationary": geostationary_plugin,
    "dust": Plugin(dust_tasks, not_yet, ("file",), back_seconds=LOOK_BACK["dust"]),
    "forecast": Plugin(forecast_tasks, not_yet, ("dts", "hour"), back_seconds=LOOK_BACK["forecast"]),
}
