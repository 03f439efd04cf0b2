import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.errors import ConfigError
from tidemark.plans import registry
from tidemark.streaming import schedule



@pytest.fixture
def run(spark):
    return F.lit("2024-01-01 12:00:00").cast("timestamp")


def found(spark):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([("a", t + dt.timedelta(hours=11)), ("b", t + dt.timedelta(hours=11, minutes=30)), ("b", t + dt.timedelta(hours=11, minutes=30)), ("edge", t + dt.timedelta(hours=11) - dt.timedelta(hours=0)), ("old", t)], "name string, dts timestamp")


def test_plan_is_strict_newest_first_and_without_repeats(spark, run):
    done = spark.createDataFrame([("a",)], "name string")
    got = [r.name for r in schedule.plan_tasks(found(spark), done, ["name"], "dts", run, 3600 * 2).collect()]
    assert got == ["b", "edge"]
    assert schedule.plan_tasks(found(spark), done, ["name"], "dts", run, 3600).filter("name = 'edge'").count() == 0


def test_failed_tasks_come_back(spark, tmp_path, run):
    plugin = schedule.Plugin(lambda f: f, lambda row: row["name"] != "b", ("name",), back_seconds=7200)
    state = str(tmp_path / "state")
    first = {r.name: r.ok for r in schedule.run_once(spark, found(spark), plugin, state, run).collect()}
    assert first == {"a": True, "b": False, "edge": True}
    assert {r.name for r in schedule.run_once(spark, found(spark), plugin, state, run).collect()} == {"b"}


def test_work_done_before_a_crash_is_kept(spark, tmp_path, run):
    log, state = tmp_path / "log", str(tmp_path / "state")

    def work(row):
        with log.open("a") as out:
            out.write(row["name"] + "\n")
        if row["name"] == "edge" and log.read_text().count("edge") == 1:
            raise RuntimeError("lost")
        return True

    plugin = schedule.Plugin(lambda f: f, work, ("name",), back_seconds=7200)
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # newest first in one partition: b, then a and edge by name
    try:
        with pytest.raises(Exception, match="lost"):
            schedule.run_once(spark, found(spark), plugin, state, run)
        assert {r.name for r in schedule.state_table(spark, state, "name string, dts timestamp").collect()} == {"a", "b"}
        assert {r.name for r in schedule.run_once(spark, found(spark), plugin, state, run).collect()} == {"edge"}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(log.read_text().split()) == ["a", "b", "edge", "edge"]


def test_old_tasks_leave_the_state(spark, tmp_path, run):
    plugin, state = schedule.Plugin(lambda f: f, lambda row: True, ("name",), back_seconds=7200), str(tmp_path / "state")
    schedule.run_once(spark, found(spark), plugin, state, run)
    later = run + F.expr("INTERVAL 70 MINUTES")
    assert schedule.run_once(spark, found(spark), plugin, state, later).count() == 0
    assert {r.name for r in schedule.state_table(spark, state, "name string, dts timestamp").collect()} == {"b"}


def test_stream_leaves_completed_tasks(spark, tmp_path):
    rows = spark.createDataFrame([("a", dt.datetime(2024, 1, 1)), ("b", dt.datetime(2024, 1, 1))], "name string, ts timestamp")
    rows.write.parquet(str(tmp_path / "in"))
    got = []
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    done = lambda: spark.createDataFrame([("a",)], "name string")
    schedule.stream_tasks(stream, ["name"], "ts", 3600, lambda df, n: got.extend(r.name for r in df.collect()), str(tmp_path / "check"), done=done).awaitTermination()
    assert got == ["b"]


def test_stream_drops_repeats(spark, tmp_path, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    for i in range(3):
        events.filter(f"event_id % 3 = {i}").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    got = []
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = schedule.stream_tasks(stream, ["user_id", "event_type"], "ts", 86_400 * 40, lambda df, n: got.extend((r.user_id, r.event_type) for r in df.collect()), str(tmp_path / "check"))
    query.awaitTermination()
    assert sorted(got) == sorted((r.user_id, r.event_type) for r in events.select("user_id", "event_type").distinct().collect())


def test_registry(spark):
    df = spark.createDataFrame([(10.0, "5")], "lat double, n string")
    out = registry.converted(df, {"y": {"from": ["lat"], "convert": "latitude"}, "n": {"from": ["n"], "convert": "convert2float"}})
    assert tuple(out.first()) == (10.0, 5.0)
    with pytest.raises(ConfigError, match="unknown"):
        registry.converted(df, {"y": {"from": ["lat"], "convert": "nothing"}})
    assert registry.replaced({"dir": "a", "sub": {"dirs": "b", "list": ["c"]}}, "dir", str.upper) == {"dir": "A", "sub": {"dirs": "B", "list": ["c"]}}
    assert registry.validated({"a": 1}, {"a": int, "b": str}) == "b: missing"
    assert registry.validated({"a": 1}, {"a": int}) is None


def test_programs(spark):
    df = spark.createDataFrame([("0",), ("101",)], "code string")
    got = {r.code: r.meaning for r in registry.run_program(df.withColumnRenamed("code", "arg"), ["arg"], lambda r: ["sh", "-c", f"exit {r['arg']}"]).collect()}
    assert got == {0: None, 101: "time"}


def test_json_state(spark, tmp_path):
    schema = "name string, size int, files array<string>"
    read = lambda n: sorted((r.name, r["size"], r["files"]) for r in schedule.read_json_state(spark, str(tmp_path / n), schema).collect())
    tasks = spark.createDataFrame([("b", 2, ["x", "y"]), ("a", 1, None)], schema)
    for _ in range(2):  # rewritten as a whole
        schedule.write_json_state(tasks, str(tmp_path), "done.json", ["name"])
    assert __import__("json").loads((tmp_path / "done.json").read_text()) == [{"name": "a", "size": 1}, {"name": "b", "size": 2, "files": ["x", "y"]}]
    assert read("done.json") == [("a", 1, None), ("b", 2, ["x", "y"])]
    schedule.write_json_state(tasks.limit(0), str(tmp_path), "none.json", ["name"])
    assert read("none.json") == [] and read("missing.json") == []
    (tmp_path / "cut.json").write_text('[{"name": "a"}, {"na')
    (tmp_path / "open.json").write_text('[{"name": "a", "other": 1}]')
    assert read("cut.json") == [] and read("open.json") == [("a", None, None)]
