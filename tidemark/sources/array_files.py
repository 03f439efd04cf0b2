"""Self-describing array files in the classic 64-bit-offset layout: dimensions, attributes, variables, big-endian arrays.

The writer makes a file's bytes as rows for ``named_files``. The reader's partitions are byte ranges: a task reads the
header, then the values whose first byte lies in its range, variable by variable.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from tidemark.errors import InputError
from tidemark.sources.named_files import write_files
from tidemark.sources.stores import files_below, ranges, read_range

# Tags and type numbers of the layout.
MAGIC, DIMENSIONS, VARIABLES, ATTRIBUTES = b"CDF\x02", 10, 11, 12
TYPES = {1: ">i1", 2: "S1", 3: ">i2", 4: ">i4", 5: ">f4", 6: ">f8"}
CHARS, DOUBLE = 2, 6
CHUNK = 1 << 20  # values in a row of bytes, or in a batch that is read


@dataclass
class Variable:
    name: str
    dims: list[int]  # numbers of dimensions
    attributes: dict[str, object] = field(default_factory=dict)
    kind: int = DOUBLE
    begin: int = 0


@dataclass
class Header:
    dims: list[tuple[str, int]]
    attributes: dict[str, object]
    variables: list[Variable]

    def values(self, v: Variable) -> int:
        return int(np.prod([self.dims[d][1] for d in v.dims], dtype=np.int64))

    def size(self, v: Variable) -> int:
        return -(-self.values(v) * np.dtype(TYPES[v.kind]).itemsize // 4) * 4


def padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 4)


def named(name: str) -> bytes:
    data = name.encode()
    return struct.pack(">i", len(data)) + padded(data)


def tagged(tag: int, items: list[bytes]) -> bytes:
    return struct.pack(">ii", tag if items else 0, len(items)) + b"".join(items)


def attribute(name: str, value: object) -> bytes:
    if isinstance(value, str):
        data = value.encode()
        return named(name) + struct.pack(">ii", CHARS, len(data)) + padded(data)
    data = np.atleast_1d(np.asarray(value, ">f8"))
    return named(name) + struct.pack(">ii", DOUBLE, len(data)) + data.tobytes()


def header_bytes(h: Header) -> bytes:
    """The header, with each variable's place filled in."""

    def once() -> bytes:
        dims = [named(n) + struct.pack(">i", size) for n, size in h.dims]
        atts = lambda a: tagged(ATTRIBUTES, [attribute(*x) for x in a.items()])
        shape = lambda v: struct.pack(f">i{len(v.dims)}i", len(v.dims), *v.dims)
        place = lambda v: struct.pack(">iIq", v.kind, min(h.size(v), 0xFFFFFFFF), v.begin)
        variables = [named(v.name) + shape(v) + atts(v.attributes) + place(v) for v in h.variables]
        return MAGIC + struct.pack(">i", 0) + tagged(DIMENSIONS, dims) + atts(h.attributes) + tagged(VARIABLES, variables)

    at = len(once())
    for v in h.variables:
        v.begin, at = at, at + h.size(v)
    return once()


class Cursor:
    """Reads a header's fields from bytes; ``short`` where they end too early."""

    class short(Exception):  # noqa: N801, N818
        pass

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def take(self, n: int) -> bytes:
        if self.at + n > len(self.data):
            raise self.short
        self.at += n
        return self.data[self.at - n : self.at]

    def ints(self, form: str) -> tuple:
        return struct.unpack(">" + form, self.take(struct.calcsize(">" + form)))

    def name(self) -> str:
        (n,) = self.ints("i")
        return self.take(-(-n // 4) * 4)[:n].decode()

    def attributes(self) -> dict[str, object]:
        found = {}
        for _ in range(self.ints("ii")[1]):
            name = self.name()
            kind, n = self.ints("ii")
            size = n * np.dtype(TYPES[kind]).itemsize
            data = self.take(-(-size // 4) * 4)[:size]
            found[name] = data.decode() if kind == CHARS else np.frombuffer(data, TYPES[kind]).astype(float).tolist()
        return found

    def header(self) -> Header:
        if self.take(4) != MAGIC:
            raise InputError("not an array file of this layout")
        self.ints("i")
        dims = [(self.name(), self.ints("i")[0]) for _ in range(self.ints("ii")[1])]
        attributes, variables = self.attributes(), []
        for _ in range(self.ints("ii")[1]):
            name = self.name()
            shape = self.ints(f"{self.ints('i')[0]}i")
            own = self.attributes()
            kind, _, begin = self.ints("iIq")
            variables.append(Variable(name, list(shape), own, kind, begin))
        return Header(dims, attributes, variables)


def read_header(path: str, size: int) -> Header:
    """The header alone: the file's first bytes, twice as many until they hold it."""
    have = 1 << 16
    while True:
        try:
            return Cursor(read_range(path, 0, min(have, size))).header()
        except Cursor.short:
            if have >= size:
                raise InputError(f"cut off: {path}") from None
            have *= 2


class ValueReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.size, self.what = options["path"], int(options.get("rangeBytes", 64 << 20)), options.get("what", "values")

    def partitions(self) -> list[InputPartition]:
        files = files_below(self.path)
        sizes = dict(files)
        found = ranges(files, self.size if self.what == "values" else 1 << 62)
        return [InputPartition((path, start, end, sizes[path])) for path, start, end in found]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        path, start, end, size = partition.value
        h, name = read_header(path, size), path.rsplit("/", 1)[1]
        if self.what != "values":
            shapes = [("dimension", "", n, str(size)) for n, size in h.dims]
            atts = [("attribute", owner, n, x if isinstance(x, str) else ",".join(map(repr, x))) for owner, a in [("", h.attributes), *((v.name, v.attributes) for v in h.variables)] for n, x in a.items()]
            rows = [*shapes, *atts, *(("variable", v.name, "dimensions", ",".join(h.dims[d][0] for d in v.dims)) for v in h.variables)]
            yield pa.RecordBatch.from_pylist([{"file": name, "kind": k, "var": v, "name": n, "value": x} for k, v, n, x in rows], HEADS)
            return
        for v in h.variables:
            width = np.dtype(TYPES[v.kind]).itemsize
            first = max(0, -(-(start - v.begin) // width))
            last = min(h.values(v), max(0, -(-(end - v.begin) // width)))
            for at in range(first, last, CHUNK):
                n = min(CHUNK, last - at)
                values = np.frombuffer(read_range(path, v.begin + at * width, n * width), TYPES[v.kind]).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array([name] * n), pa.array([v.name] * n), pa.array(np.arange(at, at + n)), pa.array(values)], VALUES)


VALUES = ["file", "var", "at", "value"]
HEADS = pa.schema([(c, pa.string()) for c in ("file", "kind", "var", "name", "value")])


class ArrayFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tidemark_arrays"

    def schema(self) -> str:
        return "file string, var string, at long, value double" if self.options.get("what", "values") == "values" else ", ".join(f"{f.name} string" for f in HEADS)

    def reader(self, schema: StructType) -> DataSourceReader:  # noqa: ARG002
        return ValueReader(self.options)


def read_values(spark: SparkSession, path: str, range_bytes: int = 64 << 20) -> DataFrame:
    """file, var, at (place in row-major order, the last dimension fastest), value of all numeric variables of the files in a folder."""
    spark.dataSource.register(ArrayFiles)
    return spark.read.format("tidemark_arrays").option("path", path).option("rangeBytes", range_bytes).load()


def read_heads(spark: SparkSession, path: str) -> DataFrame:
    """file, kind (dimension, attribute or variable), var, name, value of the files in a folder; only headers are read."""
    spark.dataSource.register(ArrayFiles)
    return spark.read.format("tidemark_arrays").option("path", path).option("what", "heads").load()


# The dimensions of each variable, with units.
LAYOUT = {
    "levels": (["pressure"], "Pa"), "lats": (["lat"], "degrees_north"), "lons": (["lon"], "degrees_east"), "u": (["pressure", "lat", "lon"], "kt"), "v": (["pressure", "lat", "lon"], "kt"),
    "t": (["pressure", "lat", "lon"], "K"), "z": (["pressure", "lat", "lon"], "m"), "su": (["lat", "lon"], "kt"), "sv": (["lat", "lon"], "kt"), "st": (["lat", "lon"], "K"), "sslp": (["lat", "lon"], "Pa"),
    "sclw": (["lat", "lon"], "mm"),
}


def write_arrays(datasets: DataFrame, path: str) -> None:
    """Rows of ``sinks.array_dataset`` as one array file each, named ``file`` with the ending .nc. A null array is left out with its variable."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                dims = [("pressure", len(row["levels"])), ("lat", len(row["lats"])), ("lon", len(row["lons"]))]
                number = {n: i for i, (n, _) in enumerate(dims)}
                variables = [Variable(n, [number[d] for d in own], {"units": unit}) for n, (own, unit) in LAYOUT.items() if row[n] is not None]
                h = Header(dims, {k: v for k, v in row["attributes"] if v is not None}, variables)
                data = [header_bytes(h)]
                for v in h.variables:
                    values = np.array([np.nan if x is None else x for x in row[v.name]], ">f8")
                    if len(values) != h.values(v):
                        raise InputError(f"{v.name} has {len(values)} values, not {h.values(v)}")
                    data += [values[at : at + CHUNK].tobytes() for at in range(0, len(values), CHUNK)]
                yield pa.RecordBatch.from_arrays([pa.array([f"{row['file']}.nc"] * len(data)), pa.array(range(len(data)), pa.int64()), pa.array(data, pa.binary())], ["file", "pos", "data"])

    write_files(datasets.mapInArrow(rows, "file string, pos long, data binary"), path)
