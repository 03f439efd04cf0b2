"""Small helpers that the operators of this subpackage share: tables, the shared folder, files, checksums."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


DEFAULT_BATCH = "67108864b"  # fixed value: Spark's default for spark.sql.execution.arrow.maxBytesPerBatch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Where it is unset, a temporary one, in local mode only."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
        if not found:
            if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            found = tempfile.mkdtemp(prefix="tidemark-")
            spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def fresh_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, codec: str | None = None, level: int | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors. codec: that of the files, where not the session's; level: zstd's, where not the usual one."""
    bound_batches(df.sparkSession)
    path = fresh_dir(df.sparkSession, label)
    writer = df.write.option("parquet.compression.codec.zstd.level", str(level)) if level else df.write
    writer.parquet(path, compression=codec)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.folder_written = path
    return out


def discard(df: DataFrame) -> None:
    """Deletes the table that ``written`` made, once nothing needs it any more."""
    system, path = open_fs(df.folder_written)
    system.delete_dir(path)


def bound_batches(spark: SparkSession, size: str = "8m") -> None:
    """Lets Spark cut the Arrow batches that go to Python by bytes, not by rows alone, unless the session's own bound is lower."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == DEFAULT_BATCH:
        spark.conf.set(name, size)


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI or a plain local path; works on executors."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def local_path(uri: str) -> str | None:
    """The path to memory-map when ``uri`` is on a mounted file system, else None."""
    system, path = open_fs(uri)
    return path if isinstance(system, fs.LocalFileSystem) else None


def publish(uri: str, data: bytes | memoryview) -> None:
    """Write a file under a name of its own and rename it, so that a repeated task leaves one whole file."""
    system, path = open_fs(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    draft = f"{path}.{uuid.uuid4().hex}.tmp"
    with system.open_output_stream(draft, compression=None) as out:
        out.write(data)
    system.move(draft, path)


def utf8_slices(batch: pa.RecordBatch, column: str, limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, pa.LargeBinaryArray]]:
    """Slices of a batch with at most ``limit`` bytes of text (one document at least), nulls as empty bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = total = 0
    for i, n in enumerate([*sizes, limit + 1]):
        if i > start and total + n > limit or i == len(sizes):
            part = batch.slice(start, i - start)
            if part.num_rows:
                yield part, pc.fill_null(part.column(column).cast(pa.large_binary()), b"")
            start, total = i, 0
        total += n
