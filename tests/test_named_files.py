"""Named files with a commit, and array files: round trips, ranges, aborted jobs."""

import pickle

import numpy as np
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidemark.sources import array_files, named_files


def test_text_files_come_whole_and_in_order(spark, tmp_path):
    rows = spark.range(2000).select(F.concat(F.lit("f"), F.col("id") % 3).alias("file"), (-F.col("id")).alias("pos"), F.col("id").cast("string").alias("value")).repartition(7)
    named_files.write_text_files(rows, str(tmp_path / "out"))
    named_files.write_text_files(spark.createDataFrame([("f0", 1, "new"), ("other", 1, None)], "file string, pos long, value string"), str(tmp_path / "out"))
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["f0", "f1", "f2", "other"]
    assert (tmp_path / "out/f0").read_text() == "new\n"
    assert (tmp_path / "out/other").read_bytes() == b""
    assert (tmp_path / "out/f1").read_text().split() == [str(i) for i in reversed(range(2000)) if i % 3 == 1]


def test_an_aborted_job_leaves_no_file(spark, tmp_path):
    rows = spark.range(4000).select(F.concat(F.lit("f"), F.col("id") % 9).alias("file"), F.col("id").alias("pos"), F.lit("x").alias("value"))
    bad = rows.withColumn("value", F.when(F.col("pos") == 3999, F.raise_error(F.lit("broken")).cast("string")).otherwise("x"))
    with pytest.raises(Exception, match="broken"):
        named_files.write_text_files(bad, str(tmp_path / "out"))
    with pytest.raises(Exception, match="not a file's name"):
        named_files.write_text_files(spark.createDataFrame([("good", 1, "x"), ("../bad", 1, "x")], "file string, pos long, value string"), str(tmp_path / "out"))
    assert [p for p in tmp_path.rglob("*") if p.is_file()] == []


def test_header_round_trip():
    own = array_files.Variable("t", [1, 0], {"units": "K", "range": [1.0, 2.0]})
    h = array_files.Header([("x", 3), ("yy", 2)], {"title": "häd", "empty": ""}, [own, array_files.Variable("scalar", [])])
    data = array_files.header_bytes(h)
    again = array_files.Cursor(data).header()
    assert again == h
    assert data[:4] == b"CDF\x02" and own.begin == len(data) and h.variables[1].begin == len(data) + 48
    with pytest.raises(array_files.Cursor.short):
        array_files.Cursor(data[:-1]).header()


def test_values_by_ranges(spark, tmp_path):
    h = array_files.Header([("n", 1000), ("m", 7)], {"a": "b"}, [array_files.Variable("big", [0, 1]), array_files.Variable("small", [1])])
    big, small = np.arange(7000) / 4, np.arange(7) - 3.0
    data = array_files.header_bytes(h) + big.astype(">f8").tobytes() + small.astype(">f8").tobytes()
    (tmp_path / "a.nc").write_bytes(data)
    found = array_files.read_values(spark, str(tmp_path), range_bytes=1003)
    assert found.rdd.getNumPartitions() > 50
    got = {(r["var"], r["at"]): r.value for r in found.collect()}
    assert got == {("big", i): x for i, x in enumerate(big.tolist())} | {("small", i): x for i, x in enumerate(small.tolist())}
    heads = {(r.kind, r["var"], r.name): r.value for r in array_files.read_heads(spark, str(tmp_path)).collect()}
    assert heads == {("dimension", "", "n"): "1000", ("dimension", "", "m"): "7", ("attribute", "", "a"): "b", ("variable", "big", "dimensions"): "n,m", ("variable", "small", "dimensions"): "m"}
    (tmp_path / "b.nc").write_bytes(data[:30])
    with pytest.raises(Exception, match="cut off"):
        array_files.read_heads(spark, str(tmp_path)).collect()


def test_the_driver_is_told_folders_not_files(tmp_path, monkeypatch):
    """A task's message holds a name for each folder of drafts, not for each file."""
    monkeypatch.setattr(named_files, "FILES_IN_FOLDER", 100, raising=False)
    writer = named_files.FileWriter(str(tmp_path / "drafts"))
    message = writer.write(Row(file=f"a file of some name {i}", data=b"x") for i in range(1001))
    assert len(pickle.dumps(message)) < 1000
    assert sorted(len(list(p.iterdir())) for p in (tmp_path / "drafts").iterdir()) == [1, *[100] * 10]


def test_drafts_of_tasks_that_succeeded_are_published(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(named_files, "FILES_IN_FOLDER", 100, raising=False)
    writer = named_files.FileWriter(str(tmp_path / "out/.drafts-1"))
    messages = [writer.write(Row(file=f"f{i}", data=str(i).encode()) for i in range(at, 250, 2)) for at in range(2)]
    writer.write(iter([Row(file="lost", data=b"")]))  # an attempt that was not taken
    writer.commit([*messages, None])
    named_files.publish(spark, writer.drafts, str(tmp_path / "out"))
    assert {p.name: p.read_text() for p in (tmp_path / "out").iterdir()} == {f"f{i}": str(i) for i in range(250)}
    named_files.write_text_files(spark.createDataFrame([], "file string, pos long, value string"), str(tmp_path / "none"))
    assert list((tmp_path / "none").iterdir()) == []


def test_one_name_from_two_tasks_is_an_error(spark, tmp_path):
    writer = named_files.FileWriter(str(tmp_path / "out/.drafts-1"))
    writer.commit([writer.write(iter([Row(file=x, data=b"")])) for x in ("same", "other", "same")])
    with pytest.raises(Exception, match="two tasks.*same"):
        named_files.publish(spark, writer.drafts, str(tmp_path / "out"))
    assert list((tmp_path / "out").iterdir()) == []
