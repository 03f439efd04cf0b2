"""Archive members and binary headers by range reads."""

import io
import struct
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.sources import binaries

NAMES = [f"in/{i:03d}.{'dat' if i % 2 else 'txt'}" for i in range(300)]


def data_of(i):
    return (f"{i} " * (1 + i * 7 % 900)).encode()


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    root = tmp_path_factory.mktemp("archives")
    with tarfile.open(root / "a.tar", "w") as tar, zipfile.ZipFile(root / "a.zip", "w") as packed:
        for archive in (tar, packed):
            for i, name in enumerate(NAMES):
                if archive is tar:
                    info = tarfile.TarInfo(name if i else "in/" + "long" * 60 + ".txt")
                    info.size = len(data_of(i))
                    tar.addfile(info, io.BytesIO(data_of(i)))
                else:
                    packed.writestr(name, data_of(i), zipfile.ZIP_DEFLATED if i % 3 else zipfile.ZIP_STORED)
        link = tarfile.TarInfo("in/link.txt")
        link.type, link.linkname = tarfile.SYMTYPE, "000.txt"
        tar.addfile(link)
        packed.writestr("in/", b"")
        packed.writestr(NAMES[4], b"again")
    return root


@pytest.mark.parametrize("kind", ["tar", "zip"])
def test_members_by_runs(spark, folder, kind):
    found = binaries.members(spark, str(folder / f"a.{kind}"), kind, r"\d+\.txt$", strip=1, run_bytes=20_000)
    got = sorted((r.member, bytes(r.content)) for r in found.collect())
    want = [(n.split("/")[1], data_of(i)) for i, n in enumerate(NAMES) if i % 2 == 0 and (i or kind == "zip")]
    assert got == sorted(want + ([(NAMES[4].split("/")[1], b"again")] if kind == "zip" else []))
    runs = binaries.archive_index(spark, str(folder / f"a.{kind}"), kind).select(F.floor(F.col("offset") / 20_000)).distinct().count()
    assert runs > 5
    assert binaries.members(spark, str(folder / f"a.{kind}"), kind, "none").count() == 0


def test_long_names_and_damage(spark, folder, tmp_path):
    assert binaries.members(spark, str(folder / "a.tar"), "tar", "in/long").first().content == data_of(0)
    whole = bytearray((folder / "a.zip").read_bytes())
    whole[40] ^= 1
    (tmp_path / "bad.zip").write_bytes(whole)
    with pytest.raises(Exception, match="damaged"):
        binaries.members(spark, str(tmp_path / "bad.zip"), "zip", NAMES[0]).collect()


def test_only_the_header_is_read(spark, tmp_path):
    for i in range(5):
        (tmp_path / f"f{i}").write_bytes(struct.pack("<IHd4s", i, 7, i / 2, b"ab") + bytes(100_000))
    read = binaries.first_bytes(spark, str(tmp_path), 18)
    assert {len(r.content) for r in read.collect()} == {18} and {r.length for r in read.collect()} == {100_018}
    layout = {"n": ("I", 1), "m": ("H", 1), "x": ("d", 1), "s": ("s", 4)}
    assert sorted((r.n, r.m, r.x, r.s) for r in binaries.headers(spark, str(tmp_path), layout).collect()) == [(i, 7, i / 2, "ab") for i in range(5)]
    (tmp_path / "short").write_bytes(b"abc")
    for own in (layout, {"n": ("I", 1)}):
        with pytest.raises(Exception, match="shorter than its header"):
            binaries.headers(spark, str(tmp_path), own).collect()


def test_many_small_files_take_few_tasks(spark, tmp_path):
    """1,500 files are 47 partitions of Spark's listing; their headers are read in as many tasks as there are cores."""
    for i in range(1500):
        (tmp_path / f"f{i}").write_bytes(i.to_bytes(4, "little") + bytes(10))
    read = binaries.headers(spark, str(tmp_path), {"number": ("I", 1)})
    assert read.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert sorted(r.number for r in read.collect()) == list(range(1500))


def test_the_driver_holds_no_listing(spark, tmp_path):
    """Files are listed in a task: the driver has no index of them. Folders key=value are opened, hidden names and other folders are not."""
    for name in ("a", "b", "_c", ".d", "day=1/e", "day=1/_f", "other/g"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"abcdef")
    read = binaries.first_bytes(spark, str(tmp_path), 4)
    assert read.inputFiles() == []
    assert sorted((r.path[len(str(tmp_path)) :], r.length, bytes(r.content)) for r in read.collect()) == [(f"/{x}", 6, b"abcd") for x in ("a", "b", "day=1/e")]
    assert binaries.first_bytes(spark, f"{tmp_path}/[ab]", 4).count() == 2
    (tmp_path / "none").mkdir()
    assert binaries.first_bytes(spark, str(tmp_path / "none"), 4).count() == 0
    with pytest.raises(Exception, match="no such file or folder"):
        binaries.first_bytes(spark, str(tmp_path / "missing"), 4)
