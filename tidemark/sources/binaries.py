"""Binary files: headers, archive members, gridded messages."""

from __future__ import annotations

import re
import struct
import tarfile
import zipfile
import zlib
from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.errors import InputError
from tidemark.sources.stores import open_fs, paths_below, read_range


def little_endian(content, offset: int, size: int = 4):  # noqa: ANN001, ANN201
    """An unsigned little-endian integer of a binary column."""
    return F.conv(F.array_join(F.transform(F.sequence(F.lit(size - 1), F.lit(0)), lambda i: F.hex(content).substr(2 * (offset + i) + 1, F.lit(2))), ""), 16, 10).cast("long")


FILES_IN_TASK = 2048
GLOB = re.compile(r"[*?\[{]")


def files_listed(spark: SparkSession, path: str) -> DataFrame:
    """path of the files in a folder, of one file, or of a glob; content isn't read.

    One task lists the folder, name by name, and deals the paths out; the driver gets their number alone. There are as many
    tasks as cores, more where each would have above ``FILES_IN_TASK`` files. A glob is listed by Spark, on the driver.
    """
    if GLOB.search(path):
        names = spark.read.format("binaryFile").load(path).select("path")
    else:

        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for folder in batch.column("folder").to_pylist():
                    found = paths_below(folder)
                    while some := list(islice(found, 8192)):
                        yield pa.RecordBatch.from_arrays([pa.array(some, pa.string())], ["path"])

        names = spark.range(0, 1, 1, 1).select(F.lit(path).alias("folder")).mapInArrow(listed, "path string")
    count = names.count()
    tasks = max(spark.sparkContext.defaultParallelism, -(-count // FILES_IN_TASK))
    return names.repartition(max(1, min(count, tasks)), "path")


def first_bytes(spark: SparkSession, path: str, size: int) -> DataFrame:
    """path, length and content: the first ``size`` bytes of each file (fewer of a shorter one); no more is read."""

    def start(source: str) -> tuple[int, bytes]:
        system, place = open_fs(source)
        with system.open_input_file(place) as file:
            length = file.size()
            return length, file.read_at(min(size, length), 0)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [start(p) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array([n for n, _ in found], pa.int64()), pa.array([x for _, x in found], pa.binary())], ["path", "length", "content"])

    return files_listed(spark, path).mapInArrow(read, "path string, length long, content binary")


def headers(spark: SparkSession, path: str, layout: dict[str, tuple[str, int]], order: str = "<") -> DataFrame:
    """Path and the named header fields of binary files. layout: name -> (struct format, count), in file order.

    Only the header's bytes are read. Integers of up to 4 bytes in little-endian order are cut out by column expressions;
    other formats by struct in Arrow batches. A file shorter than its header is an error.
    """
    size = struct.calcsize(order + "".join(f"{n}{f}" for f, n in layout.values()))
    files = first_bytes(spark, path, size)
    short = F.octet_length("content") < size
    files = files.filter(F.when(short, F.raise_error(F.concat(F.lit("shorter than its header: "), F.col("path"))).cast("boolean")).otherwise(True)).select("path", "content")
    if order == "<" and all(f in "BHI" and n == 1 for f, n in layout.values()):
        out, at = [], 0
        for name, (f, _) in layout.items():
            out.append(little_endian(F.col("content"), at, struct.calcsize(f"<{f}")).alias(name))
            at += struct.calcsize(f"<{f}")
        return files.select("path", *out)
    kinds = {n: "string" if f == "s" else "double" if f in "fd" else "long" for n, (f, _) in layout.items()}

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for content in batch["content"]:
                at, row = 0, []
                for f, n in layout.values():
                    got = struct.unpack_from(f"{order}{n}{f}", bytes(content), at)
                    at += struct.calcsize(f"{order}{n}{f}")
                    row.append(got[0].rstrip(b"\0 ").decode("latin-1") if f == "s" else got[0] if n == 1 else None)
                rows.append(row)
            yield pd.DataFrame(rows, columns=list(layout)).assign(path=batch["path"].to_numpy())[["path", *layout]]

    return files.mapInPandas(unpack, "path string, " + ", ".join(f"`{n}` {k}" for n, k in kinds.items()))


INDEX = "path string, member string, at long, offset long, stored long, method int, crc long"


def archive_index(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The members of tar or zip archives without their data: where each one is and how it is stored.

    Of a zip only the directory at its end is read, of a tar only its chain of headers. A compressed tar is an error: its
    members have no places. Folders, links and devices are left out; repeated names stay.
    """

    def entries(file, source: str) -> Iterator[tuple]:  # noqa: ANN001
        if kind == "tar":
            with tarfile.open(fileobj=file, mode="r:") as archive:
                yield from ((source, m.name, i, m.offset_data, m.size, 0, None) for i, m in enumerate(archive) if m.isfile())
            return
        with zipfile.ZipFile(file) as archive:
            for i, m in enumerate(archive.infolist()):
                if m.flag_bits & 1 or m.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
                    raise InputError(f"encrypted or oddly compressed: {m.filename} in {source}")
                if not m.is_dir():
                    yield source, m.filename, i, m.header_offset, m.compress_size, m.compress_type, m.CRC

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in INDEX.split(", ")]
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        for batch in batches:
            for source in batch.column("path").to_pylist():
                system, place = open_fs(source)
                with system.open_input_file(place) as file:
                    found = entries(file, source)
                    while rows := list(islice(found, 4096)):
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return files_listed(spark, path).mapInArrow(read, INDEX)


def member_data(row: dict) -> bytes:
    """A member's bytes, by its own range of the archive."""
    start = row["offset"]
    if row["crc"] is not None:  # zip: a local heading of its own, whose length stands in it
        name, extra = struct.unpack("<HH", read_range(row["path"], start + 26, 4))
        start += 30 + name + extra
    data = read_range(row["path"], start, row["stored"])
    if row["method"] == zipfile.ZIP_DEFLATED:
        data = zlib.decompress(data, -15)
    if len(data) < row["stored"] and not row["method"] or row["crc"] is not None and zlib.crc32(data) != row["crc"]:
        raise InputError(f"damaged: {row['member']} in {row['path']}")
    return data


def members(spark: SparkSession, path: str, kind: str, pattern: str = ".*", strip: int = 0, run_bytes: int = 64 << 20) -> DataFrame:
    """Path, member and content of tar or zip members whose names match from the start; ``strip`` leading components go.

    Members are found first, then dealt out in runs of ``run_bytes`` of an archive; a task reads the ranges of its own
    members and holds one of them, so an archive may be larger than any task's memory.
    """
    bare = F.array_join(F.slice(F.split("member", "/"), strip + 1, F.greatest(F.size(F.split("member", "/")) - strip, F.lit(0))), "/")
    wanted = archive_index(spark, path, kind).withColumn("name", bare).filter(F.col("name").rlike("^(?:" + pattern.replace("(?P<", "(?<") + ")"))
    runs = wanted.withColumn("run", F.floor(F.col("offset") / run_bytes)).repartition("path", "run")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([row["path"]]), pa.array([row["name"]]), pa.array([member_data(row)], pa.binary())], ["path", "member", "content"])

    return runs.mapInArrow(read, "path string, member string, content binary")


class SampleReader(DataSourceReader):
    def __init__(self, options: dict, decode: Callable[[str], Iterator[tuple]]):
        self.paths, self.decode = options["path"].split(","), decode

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from self.decode(partition.value)


def sample_source(name: str, decode: Callable[[str], Iterator[tuple]], schema: str = "var string, pos long, i0 int, i1 int, value double") -> type[DataSource]:
    """A data source by short name for any sample or grid format: ``decode`` yields a file's rows; a partition per file.

    Register it with spark.dataSource.register, then spark.read.format(name).option("path", "a,b").load().
    """

    class Samples(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return schema

        def reader(self, schema) -> DataSourceReader:  # noqa: ANN001, ARG002
            return SampleReader(self.options, decode)

    return Samples


# The forecast fields (J14), name and message pattern.
GRID_FIELDS = [
    ("u70", ":UGRD:70 mb:"),
    ("u100", ":UGRD:100 mb:"),
    ("u150", ":UGRD:150 mb:"),
    ("u200", ":UGRD:200 mb:"),
    ("u250", ":UGRD:250 mb:"),
    ("u300", ":UGRD:300 mb:"),
    ("u400", ":UGRD:400 mb:"),
    ("u500", ":UGRD:500 mb:"),
    ("u600", ":UGRD:600 mb:"),
    ("u700", ":UGRD:700 mb:"),
    ("u850", ":UGRD:850 mb:"),
    ("u925", ":UGRD:925 mb:"),
    ("u1000", ":UGRD:1000 mb:"),
    ("u1070", ":UGRD:0.995 sigma level:"),
    ("v70", ":VGRD:70 mb:"),
    ("v100", ":VGRD:100 mb:"),
    ("v150", ":VGRD:150 mb:"),
    ("v200", ":VGRD:200 mb:"),
    ("v250", ":VGRD:250 mb:"),
    ("v300", ":VGRD:300 mb:"),
    ("v400", ":VGRD:400 mb:"),
    ("v500", ":VGRD:500 mb:"),
    ("v600", ":VGRD:600 mb:"),
    ("v700", ":VGRD:700 mb:"),
    ("v850", ":VGRD:850 mb:"),
    ("v925", ":VGRD:925 mb:"),
    ("v1000", ":VGRD:1000 mb:"),
    ("v1070", ":VGRD:0.995 sigma level:"),
    ("height70", ":HGT:70 mb:"),
    ("height100", ":HGT:100 mb:"),
    ("height150", ":HGT:150 mb:"),
    ("height200", ":HGT:200 mb:"),
    ("height250", ":HGT:250 mb:"),
    ("height300", ":HGT:300 mb:"),
    ("height400", ":HGT:400 mb:"),
    ("height500", ":HGT:500 mb:"),
    ("height600", ":HGT:600 mb:"),
    ("height700", ":HGT:700 mb:"),
    ("height850", ":HGT:850 mb:"),
    ("height925", ":HGT:925 mb:"),
    ("height1000", ":HGT:1000 mb:"),
    ("height1070", ":HGT:surface:"),
    ("temp70", ":TMP:70 mb:"),
    ("temp100", ":TMP:100 mb:"),
    ("temp150", ":TMP:150 mb:"),
    ("temp200", ":TMP:200 mb:"),
    ("temp250", ":TMP:250 mb:"),
    ("temp300", ":TMP:300 mb:"),
    ("temp400", ":TMP:400 mb:"),
    ("temp500", ":TMP:500 mb:"),
    ("temp600", ":TMP:600 mb:"),
    ("temp700", ":TMP:700 mb:"),
    ("temp850", ":TMP:850 mb:"),
    ("temp925", ":TMP:925 mb:"),
    ("temp1000", ":TMP:1000 mb:"),
    ("temp1070", ":TMP:0.995 sigma level:"),
    ("relh100", ":RH:100 mb:"),
    ("relh70", ":RH:70 mb:"),
    ("relh150", ":RH:150 mb:"),
    ("relh200", ":RH:200 mb:"),
    ("relh250", ":RH:250 mb:"),
    ("relh300", ":RH:300 mb:"),
    ("relh400", ":RH:400 mb:"),
    ("relh500", ":RH:500 mb:"),
    ("relh600", ":RH:600 mb:"),
    ("relh700", ":RH:700 mb:"),
    ("relh850", ":RH:850 mb:"),
    ("relh925", ":RH:925 mb:"),
    ("relh1000", ":RH:1000 mb:"),
    ("relh1070", ":RH:0.995 sigma level:"),
    ("p1070", ":PRMSL:mean sea level:"),
]


def wanted_fields(messages: DataFrame, spark: SparkSession) -> DataFrame:
    """Messages (descr, ...) joined with the field table: one scan for all fields. 71 rows are broadcast."""
    dim = spark.createDataFrame(GRID_FIELDS, "field string, pattern string")
    return messages.withColumn("pattern", F.regexp_extract("descr", r"(:[A-Z]+:[^:]+:)", 1)).join(F.broadcast(dim), "pattern")
