"""Files written under names of their own, with a commit (K1, K2, K4, K6): drafts first, then all names at once or none.

A task streams the rows of each of its files to a draft, in folders of at most ``FILES_IN_FOLDER`` drafts, and tells the
driver the folders. When all tasks have done so, tasks rename the drafts of a folder each; if one fails for good, they go,
and nothing was there to be read. Rows of a file come to one task in order, which holds one row at a time and the names of
one folder; the driver holds the names of folders alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tidemark.errors import InputError
from tidemark.sources.stores import open_fs

NAME = "tidemark_files"
FILES_IN_FOLDER = 10_000
DONE = "_done"  # the list of folders whose tasks have succeeded


@dataclass
class Drafts(WriterCommitMessage):
    folders: list[str]


class FileWriter(DataSourceWriter):
    def __init__(self, drafts: str):
        self.drafts = drafts

    def write(self, iterator: Iterator[Row]) -> Drafts:
        system, base = open_fs(self.drafts)
        folders: list[str] = []
        seen: set[str] = set()
        out = last = None
        for name, data in ((r.file, r.data) for r in iterator):
            if not out or name != last:
                if out:
                    out.close()
                if not folders or len(seen) == FILES_IN_FOLDER:
                    folders.append(uuid.uuid4().hex)
                    system.create_dir(f"{base}/{folders[-1]}", recursive=True)
                    seen = set()
                if not name or "/" in name or name[0] in "._" or name in seen:
                    raise InputError(f"not a file's name, or its rows aren't together: {name!r}")
                seen.add(name)
                out, last = system.open_output_stream(f"{base}/{folders[-1]}/{name}", compression=None), name
            out.write(bytes(data or b""))
        if out:
            out.close()
        return Drafts(folders)

    def commit(self, messages: list[Drafts | None]) -> None:
        """The folders are written down; ``publish`` gives the drafts their places."""
        system, base = open_fs(self.drafts)
        system.create_dir(base, recursive=True)
        with system.open_output_stream(f"{base}/{DONE}", compression=None) as out:
            out.write("\n".join(f for m in messages if m for f in m.folders).encode())

    def abort(self, messages: list[Drafts | None]) -> None:  # noqa: ARG002
        remove(self.drafts)


def remove(drafts: str) -> None:
    system, folder = open_fs(drafts)
    if system.get_file_info(folder).type.name == "Directory":
        system.delete_dir(folder)


def publish(spark: SparkSession, drafts: str, path: str) -> None:
    """Renames the drafts of all tasks that have succeeded, a folder at a time in tasks; other drafts go. A name that is in two folders is an error, and nothing is renamed."""

    def names(folder: str) -> list[str]:
        system, place = open_fs(folder)
        return [f.base_name for f in system.get_file_info(fs.FileSelector(place))]

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(names(folder), pa.string())], ["name"])

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for folder in batch.column("folder").to_pylist():
                (system, place), (_, to) = open_fs(folder), open_fs(path)
                found = names(folder)
                for name in found:
                    try:
                        system.move(f"{place}/{name}", f"{to}/{name}")
                    except OSError:
                        if system.get_file_info(f"{place}/{name}").type != fs.FileType.NotFound:  # else another attempt has renamed it
                            raise
                yield pa.RecordBatch.from_arrays([pa.array([len(found)], pa.int64())], ["files"])

    try:
        system, base = open_fs(drafts)
        with system.open_input_stream(f"{base}/{DONE}", compression=None) as file:
            done = [f"{drafts}/{x}" for x in file.read().decode().split()]
        system.create_dir(open_fs(path)[1], recursive=True)
        if not done:
            return
        folders = spark.createDataFrame([(x,) for x in done], "folder string")
        if len(done) > 1:
            twice = folders.mapInArrow(listed, "name string").groupBy("name").count().filter("count > 1").limit(5).collect()
            if twice:
                raise InputError(f"files from two tasks, or their rows aren't together: {sorted(r.name for r in twice)}")
        folders.mapInArrow(moved, "files long").collect()
    finally:
        remove(drafts)


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "file string, data binary"

    def writer(self, schema: StructType, overwrite: bool) -> FileWriter:  # noqa: ARG002
        return FileWriter(self.options["drafts"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NamedFiles)


def write_files(rows: DataFrame, path: str) -> None:
    """Rows (file, pos, data binary): each file's data in the order of pos, as one file of that name in the folder.

    Files of that name are replaced, others stay. Names are plain: no folders, no leading dot. Null data adds nothing.
    """
    register(rows.sparkSession)
    drafts = f"{path.rstrip('/')}/.drafts-{uuid.uuid4().hex}"
    ordered = rows.select("file", "pos", "data").repartition("file").sortWithinPartitions("file", "pos").select("file", "data")
    ordered.write.format(NAME).mode("append").option("drafts", drafts).save(path)
    publish(rows.sparkSession, drafts, path.rstrip("/"))


def write_text_files(rows: DataFrame, path: str) -> None:
    """Rows (file, pos, value): the same for lines."""
    write_files(rows.select("file", "pos", F.encode(F.concat("value", F.lit("\n")), "UTF-8").alias("data")), path)
