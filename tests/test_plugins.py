import datetime as dt

from pyspark.sql import functions as F

from tidemark.plans import plugins
from tidemark.plans.registry import PLUGINS

SCHEMA = "path string, dir_pos int, name string, modified timestamp"


def listing(spark, *found, modified=dt.datetime(2012, 10, 27, 17)):
    return spark.createDataFrame([(f"/in/{n}", 0, n, modified) for n in found], SCHEMA)


def test_storm_task(spark):
    run = F.lit("2012-10-27 18:20:00").cast("timestamp")
    tracks = listing(spark, "aal182012.dat", "awp022012.dat").unionByName(listing(spark, "aal092012.dat", modified=dt.datetime(2012, 10, 27, 6, 20)))
    gfs = listing(spark, "gfs.2012102706.pgrb2.0p25.f000", "gfs.2012102712.pgrb2.0p25.f003", "gfs.2012102712.pgrb2.0p25.f006")
    img, snd = listing(spark, "i1", "i0"), listing(spark, "s0")
    task = plugins.storm_tasks(tracks, gfs, img, snd, run)
    row = task.first()
    assert row.tracks == ["/in/aal182012.dat", "/in/awp022012.dat"]
    assert row.gfs == "/in/gfs.2012102712.pgrb2.0p25.f003"
    assert row.images == ["/in/i0", "/in/i1"]
    assert (row.job_coverage_start, row.dts) == (dt.datetime(2012, 10, 27, 6), dt.datetime(2012, 10, 27, 18))
    assert plugins.storm_tasks(tracks, gfs, img, snd.limit(0), run).count() == 0
    assert plugins.storm_tasks(tracks, gfs, img, snd, run, done_runs=task).count() == 0
    got = {(r.key, r.value) for r in plugins.storm_control(task, tracks).collect()}
    assert got == {("adeck_input", "nhc_aal182012.dat.201210271700"), ("adeck_input", "jtwc_awp022012.dat.201210271700"), ("gfs_input", "gfs.t12z.pgrb2.1p00.f003.20121027")}


def test_geostationary_tasks(spark):
    files = listing(spark, "2015032123000i13.c04", "2015032123000i13.c01", "2015032123000i99.c01", "2015032123000i13.c07", "2015032130000i13.c01", "2015032140000i13.c01")
    heads = spark.createDataFrame([("/in/" + n, a, b) for n, a, b in (("2015032123000i13.c04", 10, 20), ("2015032123000i13.c01", 10, 20), ("2015032123000i99.c01", 10, 20), ("2015032123000i13.c07", 10, 20), ("2015032130000i13.c01", 1, 1))], "path string, num_line long, num_elem long")
    channels = spark.createDataFrame([("01", "vis"), ("04", "ir")], "channel string, kind string")
    sectors = spark.createDataFrame([("13", "10x20", "full")], "satellite string, sector_id string, sector_name string")
    tasks, rejected = plugins.geostationary_tasks(files, heads, channels, sectors)
    row = tasks.first()
    assert tasks.count() == 1
    assert (row.channels, row.sector.name, row.sector.lines) == (["01", "04"], "full", 10)
    assert {(r.name[14:], r.reason) for r in rejected.collect()} == {("99.c01", "satellite not defined"), ("13.c07", "channel not defined"), ("13.c01", "sector not defined"), ("13.c01", "line or element count not found")}
    assert plugins.ready(tasks, ["01", "04"]).count() == 1
    assert plugins.ready(tasks, ["01", "02"]).count() == 0


def test_dust_and_forecast_tasks(spark):
    assert plugins.dust_tasks(listing(spark, "2015_032_1230_MSG03.zip")).first().dts == dt.datetime(2015, 2, 1, 12, 30)
    rows = plugins.forecast_tasks(listing(spark, "gfs.2012102712.pgrb2.0p25.f003", "gfs.2012102712.pgrb2.0p25.f006")).orderBy("hour").collect()
    assert [(r.hour, r.fcst) for r in rows] == [(3, [3]), (6, [6])]
    assert {"dust", "forecast", "storm", "geostationary"} <= set(PLUGINS)


def test_storm_plugin(spark):
    run = F.lit("2012-10-27 18:20:00").cast("timestamp")
    inputs = {"tracks": "aal182012.dat", "forecasts": "gfs.2012102712.pgrb2.0p25.f003", "images": "i0", "soundings": "s0"}
    files = None
    for kind, name in inputs.items():
        one = listing(spark, name).withColumn("input", F.lit(kind))
        files = one if files is None else files.unionByName(one)
    plugin = PLUGINS["storm"](run)
    assert [r.tracks for r in plugin.tasks(files).collect()] == [["/in/aal182012.dat"]]
    assert (plugin.keys, plugin.back_seconds) == (("dts",), 43_200)
