"""A listing as a data source: folders whose tiers may be patterns, with filters that keep folders from being listed.

A template such as ``/data/^\\d{8}$/^sat.*$`` has pattern tiers, which match from their start; each is a column tier_0,
tier_1, ... The planning step opens folders tier by tier and leaves out those that a pushed filter on a tier excludes; the
tasks list the files of the last tier's folders and test names, times and sizes as they go.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, Not, StringContains,
    StringEndsWith, StringStartsWith,
)
from pyspark.sql.types import StructType

from tidemark.sources.stores import open_fs

FIXED = ["path", "dir", "dir_pos", "name", "modified", "length"]
KINDS = {"path": pa.string(), "dir": pa.string(), "dir_pos": pa.int32(), "name": pa.string(), "modified": pa.timestamp("us", "UTC"), "length": pa.int64()}
FOLDERS_IN_TASK = 64

TESTS: dict[type[Filter], Callable] = {
    EqualTo: lambda x, v: x == v, EqualNullSafe: lambda x, v: x == v, GreaterThan: lambda x, v: x > v, GreaterThanOrEqual: lambda x, v: x >= v, LessThan: lambda x, v: x < v,
    LessThanOrEqual: lambda x, v: x <= v, In: lambda x, v: x in v, StringContains: lambda x, v: v in x, StringEndsWith: lambda x, v: x.endswith(v), StringStartsWith: lambda x, v: x.startswith(v),
}


def passes(test: Filter, row: dict) -> bool:
    """Whether a row passes a filter; a column that the row doesn't have yet doesn't exclude it."""
    if isinstance(test, Not):
        inner = test.child
        return inner.attribute[0] not in row or not passes(inner, row)
    name = test.attribute[0]
    if name not in row:
        return True
    if isinstance(test, IsNotNull):
        return row[name] is not None
    value = test.value
    if isinstance(value, dt.datetime) and value.tzinfo is None:
        value = value.replace(tzinfo=dt.timezone.utc)
    return bool(TESTS[type(test)](row[name], value))


def known(test: Filter) -> bool:
    if isinstance(test, Not):
        return known(test.child) and not isinstance(test.child, Not)
    return len(test.attribute) == 1 and (isinstance(test, IsNotNull) or type(test) in TESTS and getattr(test, "value", None) is not None)


class FolderReader(DataSourceReader):
    def __init__(self, options: dict):
        self.templates = [x for x in options["path"].split("\n") if x]
        self.pattern = re.compile(options.get("pattern", ""))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Takes the filters it can test; yields the others, which Spark tests itself."""
        for f in filters:
            if known(f):
                self.filters.append(f)
            else:
                yield f

    def keeps(self, row: dict) -> bool:
        return all(passes(f, row) for f in self.filters)

    def folders(self, template: str) -> Iterator[tuple[str, list[str]]]:
        """(folder, values of its pattern tiers); a folder below one that a filter excludes is never opened."""
        scheme, path = re.fullmatch(r"((?:[a-z0-9+.-]+:(?://[^/]*)?)?)(/.*)", template.rstrip("/")).groups()
        found: list[tuple[str, list[str]]] = [(scheme, [])]
        for tier in path.split("/")[1:]:
            if not tier.startswith("^"):
                found = [(f"{folder}/{tier}", values) for folder, values in found]
                continue
            test, deeper = re.compile(tier.strip("^$")), []
            for folder, values in found:
                for name in self.subfolders(folder):
                    row = {f"tier_{i}": x for i, x in enumerate([*values, name])}
                    if test.match(name) and self.keeps(row):
                        deeper.append((f"{folder}/{name}", [*values, name]))
            found = deeper
        yield from found

    def subfolders(self, folder: str) -> list[str]:
        system, path = open_fs(folder)
        return sorted(f.base_name for f in system.get_file_info(fs.FileSelector(path, allow_not_found=True)) if f.type == fs.FileType.Directory)

    def partitions(self) -> list[InputPartition]:
        found = [(folder, i, values) for i, template in enumerate(self.templates) for folder, values in self.folders(template)]
        return [InputPartition(found[at : at + FOLDERS_IN_TASK]) for at in range(0, len(found), FOLDERS_IN_TASK)] or [InputPartition([])]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        tiers = max((sum(t.startswith("^") for t in x.split("/")) for x in self.templates), default=0)
        names = [*FIXED, *(f"tier_{i}" for i in range(tiers))]
        schema = pa.schema([(n, KINDS.get(n, pa.string())) for n in names])
        for folder, place, values in partition.value:
            system, path = open_fs(folder)
            rows = []
            for f in sorted(system.get_file_info(fs.FileSelector(path, allow_not_found=True)), key=lambda f: f.base_name):
                row = {"path": f"{folder}/{f.base_name}", "dir": folder, "dir_pos": place, "name": f.base_name, "modified": f.mtime, "length": f.size}
                row |= {f"tier_{i}": x for i, x in enumerate(values)}
                if f.type == fs.FileType.File and self.pattern.match(f.base_name) and self.keeps(row):
                    rows.append(row)
            yield pa.RecordBatch.from_pylist(rows, schema)


class Folders(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark_folders"

    def schema(self) -> str:
        tiers = max((sum(t.startswith("^") for t in x.split("/")) for x in self.options["path"].split("\n")), default=0)
        fixed = "path string, dir string, dir_pos int, name string, modified timestamp, length long"
        return ", ".join([fixed, *(f"tier_{i} string" for i in range(tiers))])

    def reader(self, schema: StructType) -> DataSourceReader:  # noqa: ARG002
        return FolderReader(self.options)


def listed(spark: SparkSession, templates: list[str], pattern: str = "") -> DataFrame:
    """Files directly in the folders of the templates, in any order: path, dir, dir_pos (the template's place), name, modified, length, tier_0, ...

    Names match ``pattern`` from their start. Filters on tiers keep folders from being opened, others keep rows out of the
    result. Folders that don't exist have no files. Order by dir_pos, dir and name (O3).
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Folders)
    return spark.read.format("tidemark_folders").option("path", "\n".join(templates)).option("pattern", pattern).load()
