"""Parsers on small files written from the documented formats."""

import datetime as dt
import io
import struct
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.errors import InputError
from tidemark.operators import link, select, sets, spatial, tables
from tidemark.sources import binaries, names, sinks, texts

HEAD = "01 20121027 201230118   29.8  -75.6   28.1  -76.9 034 010 075 065 065 AL1812  SANDY\n01 2012301 180860    29.70   -76.38    29.82   -75.58\n"


def rows(spark, text, name="f.txt"):
    return spark.createDataFrame([(name, i, v) for i, v in enumerate(text.rstrip("\n").split("\n"))], "file string, line_no int, value string")


def files(spark, *found):
    return spark.createDataFrame([(n, i) for i, n in enumerate(found)], "name string, pos int")


def test_file_names(spark):
    r = names.track.read(files(spark, "nhc_aal182012.dat.201210271800")).first()
    assert (r.stormId, r.stormNum, r.year, r.jtwcId, r.basin, r.createDTG) == ("al182012", 18, 2012, "18A", "Atlantic", dt.datetime(2012, 10, 27, 18))
    r = names.satellite.read(files(spark, "NPR-MIRS-SND_v9_NPP_s201208180059460_e201208180100176_c20130308234921.nc")).first()
    assert (r.type, r.version, r.satellite, r.startDT) == ("SND", "v9", "NPP", dt.datetime(2012, 8, 18, 0, 59, 46))
    r = names.forecast.read(files(spark, "gfs.t06z.pgrb2.1p00.f012.20120818")).first()
    assert (r.fhour, r.runDTG) == (12, dt.datetime(2012, 8, 18, 6))
    assert names.geostationary.read(files(spark, "2015032123000i13.c04")).first().DTS == dt.datetime(2015, 2, 1, 12, 30)
    assert names.dust.read(files(spark, "2015_032_1230_MSG03_20150201123000.zip")).first().DTS == dt.datetime(2015, 2, 1, 12, 30)


def test_unmatched_name_is_an_error(spark):
    with pytest.raises(Exception, match="doesn't match"):
        names.track.read(files(spark, "other.txt")).collect()
    assert names.track.read(files(spark, "other.txt"), strict=False).first().stormId is None


def test_listing_and_tiers(spark, tmp_path):
    for n in ("a1.txt", "b1.txt"):
        (tmp_path / n).write_text("x")
    assert [r.name for r in names.listing(spark, [str(tmp_path)], "a").orderBy("dir_pos", "name").collect()] == ["a1.txt"]
    df = spark.createDataFrame([("/d/2012x/in",), ("/d/12/in",)], "p string")
    assert [r.p for r in df.filter(names.tier_match(F.col("p"), r"/d/^\d{4}$/in")).collect()] == ["/d/2012x/in"]


def test_control_file(spark):
    got = {r.key: (r["values"], r.single) for r in texts.control_file(rows(spark, "a=1\nb=x\na=2\n")).collect()}
    assert got == {"a": (["1", "2"], False), "b": (["x"], True)}
    assert texts.control_input({"a": "1"}, ["a"], spark).count() == 1
    with pytest.raises(InputError, match="missing: c"):
        texts.control_input({"a": "1"}, ["c"], spark)
    two = texts.control_file(rows(spark, "a=1\nb=2\n", "one").unionByName(rows(spark, "a=1\nc=2\n", "two")))
    assert texts.control_input(two, ["a"]).count() == 4
    with pytest.raises(InputError, match="missing: b"):  # a key in one file doesn't count for another
        texts.control_input(two, ["a", "b"])
    with pytest.raises(InputError, match="missing: a"):
        texts.control_input(two.limit(0), ["a"])


def test_track_table(spark):
    text = "h1\nh2\nh3\n20121027 1800 0 29.8 284.4 34 10 75 65 SANDY B\n20121028 0000 6 30.9 285.7 36 11 75 65 SANDY B\n"
    row = select.analysis_row(texts.track_table(rows(spark, text))).first()
    assert (row.DTG, row.LONGITUDE, row.NAME) == (dt.datetime(2012, 10, 27, 18), pytest.approx(-75.6), "SANDY")
    with pytest.raises(InputError, match="no column"):
        texts.track_table(rows(spark, text), ("OTHER", 0))


SPARSE = "rank:002\ndimensions:000000002,000000002\ntype:float\n000000000,000000000,000000001.50000\n000000000,000000001,-00000999.00000\n000000001,000000000,000000012.25000\n000000001,000000001,000000000.00000\n"


def test_sparse_round_trip(spark):
    heads, values = texts.sparse_variables(rows(spark, SPARSE, "/x/LWP.txt"))
    assert heads.first().dims == [2, 2]
    assert [(r.var, r.i0, r.i1, r.value) for r in values.orderBy("pos").collect()][2] == ("LWP", 1, 0, 12.25)
    again = sinks.sparse_lines(heads, values.select("file", "pos", "value"))
    assert "\n".join(r.value for r in again.orderBy("pos").collect()) + "\n" == SPARSE
    with pytest.raises(Exception, match="unknown type"):
        texts.sparse_variables(rows(spark, SPARSE.replace("float", "char")))[0].collect()


def test_time_components(spark):
    got = sinks.time_components(spark.createDataFrame([(0, 0, 86_461.0)], "pos int, i0 int, value double"))
    assert {(r.field, r.value) for r in got.collect()} >= {("days", "000000000,000000002"), ("seconds", "000000000,000000001")}


def grid(n=2):
    out = HEAD
    for p in ("10000.0", "=85000.0"):
        out += f"Pressure level (Pa)= {p} nlat={n} nlon={n}\n".replace("= =", "=") + "Lat Lon U V T Z\n" + "".join(f"{10 + j}.0 {300 + i}.0 {i}.0 {j}.0 2.5 3.5\n" for j in range(n) for i in range(n))
    return out + "Surface\nLat Lon U V T SLP CLW\n" + "".join(f"{10 + j}.0 {300 + i}.0 1.0 1.0 2.0 3.0 4.0\n" for j in range(n) for i in range(n)) + "\n"


def test_pressure_fields(spark):
    levels, surface = texts.pressure_fields(rows(spark, grid()))
    cells = {(r.level, r.i, r.j): (r.lat, r.lon, r.u) for r in levels.collect()}
    assert len(cells) == 8
    assert cells[85000.0, 1, 0] == (10.0, 301.0, pytest.approx(1.943844492457398))
    assert surface.first().v == pytest.approx(1.943844492457398)
    assert texts.pressure_fields(rows(spark, grid()), compat=True)[1].first().v == 1.0
    assert texts.pressure_slice(levels, "850.0").count() == 4
    head = texts.storm_headers(rows(spark, grid())).first()
    assert (head.asname, head.swath_time, head.abasin, head.asnum) == ("SANDY", dt.datetime(2012, 10, 27, 18, 9), "AL", 18)
    out = sinks.array_dataset(levels, surface, texts.storm_headers(rows(spark, grid())), F.lit("2013-01-01").cast("timestamp"), "NPP", "ATMS").first()
    assert out.lats == [10.0, 11.0]
    assert out.lons == [300.0, 301.0]
    assert out.attributes["atcf_storm_longitude_degrees_east"] == "284.4"
    assert len(out.u) == 8
    assert out.levels == [10000.0, 85000.0]


def test_unexpected_line_is_an_error(spark):
    with pytest.raises(Exception, match="unexpected line"):
        texts.pressure_fields(rows(spark, grid() + "Other\n"))[1].collect()


def test_radial_fields(spark):
    text = HEAD + "AL1812 102718 10271808  r(km): 3    0.0  600.0 z(km): 2    0.0   20.0 lat= 29.82 lon= -75.59\nPRESSURE\n1 2 3\n4\n5 6\nGRADIENT\n1 1 1 1 1 1\n"
    got = {(r["var"], r.r_idx, r.z_idx): (r.radius, r.height, r.value) for r in texts.radial_fields(rows(spark, text)).collect()}
    assert got["pressure", 1, 1] == (300.0, 20.0, 5.0)
    assert got["gradient", 0, 0][2] == pytest.approx(1.943844492457398)


def test_binary_header_and_members(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(struct.pack("<IIh4s", 7, 70_000, -3, b"GOES"))
    assert binaries.headers(spark, str(tmp_path / "a.bin"), {"x": ("I", 1), "num_line": ("I", 1)}).first()[1:] == (7, 70_000)
    assert binaries.headers(spark, str(tmp_path / "a.bin"), {"x": ("I", 1), "y": ("I", 1), "z": ("h", 1), "s": ("s", 4)}).first()[1:] == (7, 70_000, -3, "GOES")
    with tarfile.open(tmp_path / "t.tar", "w") as t:
        info = tarfile.TarInfo("top/one.txt")
        info.size = 2
        t.addfile(info, io.BytesIO(b"hi"))
    assert [(r.member, bytes(r.content)) for r in binaries.members(spark, str(tmp_path / "t.tar"), "tar", strip=1).collect()] == [("one.txt", b"hi")]
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("c01.dat", "x")
        z.writestr("other", "y")
    assert [r.member for r in binaries.members(spark, str(tmp_path / "z.zip"), "zip", r"c\d\d").collect()] == ["c01.dat"]
    assert len(binaries.GRID_FIELDS) == 71


def sample_rows(path):
    yield ("v", 0, 0, None, 1.5)


def test_sample_source(spark):
    spark.dataSource.register(binaries.sample_source("samples", sample_rows))
    assert [r.value for r in spark.read.format("samples").option("path", "a,b").load().collect()] == [1.5, 1.5]


def test_range_join_crosses_the_date_line(spark):
    t = spark.createDataFrame([(1, 0.0, 175.0, dt.datetime(2024, 1, 1, 12), 3600)], "storm int, t_lat double, t_lon double, t_ts timestamp, after int")
    s = spark.createDataFrame([(1, 0.0, -175.0, dt.datetime(2024, 1, 1, 11)), (2, 0.0, 185.0, dt.datetime(2024, 1, 1, 13)), (3, 14.0, 161.0, dt.datetime(2024, 1, 1, 6)), (4, 0.0, 150.0, dt.datetime(2024, 1, 1, 12)), (5, 0.0, 175.0, dt.datetime(2024, 1, 1, 14)), (6, None, 1.0, None)], "id int, lat double, lon double, ts timestamp")
    assert sorted(r.id for r in spatial.range_join(t, s).collect()) == [1, 2, 3]


def test_wide_table_lines(spark):
    s = spark.createDataFrame([(1.0, 2.0, None, "A", 1.5, 0), (1.0, 2.0, None, "A", 2.5, 1), (0.5, 2.0, 3, "B", 4.0, 2)], "lon double, lat double, i1 int, var string, value double, pos int")
    got = [r.value for r in tables.wide_lines(tables.wide(s, ["A", "B"]), ["A", "B"]).collect()]
    assert got == ["0000.50 002.00 0003 ---------- 0004.00000 ", "0001.00 002.00 ---- 0002.50000 ---------- "]
    assert tables.wide_header(["A"]) == "Lon     Lat    Idx2 A          "


def test_interleaved_lines(spark):
    a, b = (spark.createDataFrame([(0, f"Lon Lat Idx2 {x}"), (1, f"1 2 3 {x}9")], "line_no int, value string") for x in "PQ")
    assert [r.value for r in tables.interleaved_lines(a, b).collect()] == ["Lon Lat Idx2 P Q ", "1 2 3 P9 Q9 "]


def test_zip_needs_enough_rows(spark):
    a, b = spark.range(3).toDF("k"), spark.range(2).toDF("k")
    assert tables.zip_tables(b, a, ["k"], ["k"]).count() == 2
    with pytest.raises(Exception, match="shorter"):
        tables.zip_tables(a, b, ["k"], ["k"]).collect()


def test_ties_and_sets(spark):
    df = spark.createDataFrame([("a", 1, 0, "x"), ("a", 1, 1, "y"), ("b", None, 2, "z")], "k string, ts int, pos int, v string")
    assert {r.k: r.v for r in select.latest_per_key(df, ["k"], "ts", "pos").collect()} == {"a": "x", "b": "z"}
    assert select.latest(df, "ts", "pos").first().v == "x"
    x, y = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int"), spark.createDataFrame([(2,), (3,), (None,)], "k int")
    assert [r.k for r in sets.difference(x, y).collect()] == [1, 1]
    assert sorted((r.side, r.k) for r in sets.symmetric_difference(x, y).collect()) == [(0, 3), (1, 1), (1, 1)]
    with pytest.raises(Exception, match="more than one"):
        select.single(x, F.col("k")).collect()


def test_linked_names(spark):
    i = spark.createDataFrame([(0, "b"), (1, "a"), (2, "q")], "pos int, name string")
    f = spark.createDataFrame([("a", 1), ("b", 2)], "name string, key int")
    k, m = link.linked_names(i, f, spark.createDataFrame([(1, "A"), (2, "B")], "key int, out_name string"))
    assert [r.out_name for r in k.collect()] == ["B", "A"]
    assert [r.name for r in m.collect()] == ["q"]


def test_nearest_keeps_repeated_rows(spark):
    left = spark.createDataFrame([(1, dt.datetime(2024, 1, 1))] * 2, "k int, a timestamp")
    right = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 1), 5)], "k int, b timestamp, pos int")
    assert [r.pos for r in spatial.nearest(left, right, ["k"], "a", "b", "pos", 120).collect()] == [5, 5]


def test_latest_with_a_text_position(spark):
    df = spark.createDataFrame([("a", 1, "y"), ("a", 1, "x"), ("b", None, "z")], "k string, ts int, pos string")
    assert {r.k: r.pos for r in select.latest_per_key(df, ["k"], "ts", "pos").collect()} == {"a": "x", "b": "z"}


def test_lines_are_numbered_over_partitions(spark):
    df = spark.range(1000).selectExpr("id * 7919 % 1000 AS k").repartition(5)
    assert [r.line for r in tables.numbered(df, ["k"]).orderBy("k").collect()] == list(range(1, 1001))


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path):
    """One file of 50,000 numbered lines, some empty, some ending in CR LF, in ranges of 16 kB; a small one beside it."""
    text = [f"{i} " + "x" * (i % 37) if i % 11 else "" for i in range(50_000)]
    (tmp_path / "big.txt").write_text("".join(x + ("\r\n" if i % 5 == 0 else "\n") for i, x in enumerate(text)), newline="")
    (tmp_path / "small.txt").write_text("a\nb")
    (tmp_path / "none.txt").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        found = texts.lines(spark, str(tmp_path))
        parts = found.filter("file LIKE '%big.txt'").groupBy("start", F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
        got = {(r.file.rsplit("/", 1)[1], r.line_no): r.value for r in found.collect()}
        heads = found.withColumn("head", F.when(F.col("line_no") % 4000 == 0, F.col("line_no")))
        filled = texts.scanned(heads, ordinal="n", fill={"last": "head"}, since={"gone": "head"}).filter("file LIKE '%big.txt'")
        wrong = filled.filter("n <> line_no + 1 OR last <> line_no - line_no % 4000 OR gone <> line_no % 4000").count()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len({p.task for p in parts}) > 50 and max(p.n for p in parts) < 3000
    assert got == {("big.txt", i): x for i, x in enumerate(text)} | {("small.txt", 0): "a", ("small.txt", 1): "b"}
    assert wrong == 0


def test_pieces_are_one_file(spark, tmp_path):
    rows = spark.range(3000).select(F.when(F.col("id") < 2500, "hot").otherwise("cold").alias("file"), F.col("id").alias("pos"), F.col("id").cast("string").alias("value"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows.repartitionByRange(8, "file", "pos").sortWithinPartitions("file", "pos").select("file", "value").write.partitionBy("file").text(str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "out" / "file=hot").glob("*.txt"))) > 4
    found = texts.lines(spark, str(tmp_path / "out"), pieces=True)
    got = sorted((r.file.rsplit("=", 1)[1], r.line_no, r.value) for r in found.collect())
    assert got == sorted([("hot", i, str(i)) for i in range(2500)] + [("cold", i, str(i + 2500)) for i in range(500)])


def test_names_of_pieces_are_not_taken_apart_for_each_line(spark, tmp_path):
    spark.range(100).selectExpr("'one' AS file", "CAST(id AS STRING) AS value").write.partitionBy("file").text(str(tmp_path / "out"))
    found = texts.lines(spark, str(tmp_path / "out"), pieces=True)
    assert "regexp" not in found._jdf.queryExecution().optimizedPlan().toString().lower()
    assert {r.file.rsplit("/", 1)[1] for r in found.collect()} == {"file=one"}
