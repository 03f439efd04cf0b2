"""Token ids as flat binary files: unsigned integers, with 64-bit document offsets beside them.

A shard is four things under one name: ``.bin`` (little-endian ids, 16-bit where the vocabulary allows, else 32-bit),
``.idx`` (n + 1 offsets in ids, from 0), ``.doc`` (n 64-bit document ids) and its row in the table of shards. Shards hold
ascending ranges of document ids; the ids before a shard (its base) come from a prefix sum over the shards' counts, so no
task waits for another. Readers memory-map the files.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import local_path, open_fs, publish
from tidemark.llm.tokens import Encoder

SHARDS = "shard long, path string, n_docs long, n_tokens long"


@dataclass(frozen=True)
class TokenFormat:
    tokenizer: str
    keeps_spaces: bool
    end_id: int
    vocabulary: int
    shard_ids: int = 1 << 26  # ids in memory before a task's shard is cut

    @property
    def dtype(self) -> str:
        return "<u2" if self.vocabulary <= 1 << 16 else "<u4"


def write_shards(docs: DataFrame, folder: str, form: TokenFormat, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text (null: empty), append ``end_id``, write shards in ascending ``id_col`` order; one row per shard.

    Rows without an id sort first and are stored as id -1. Equal ids keep every row, in any order. An empty table gives
    no shard. Other columns are ignored. A shard's name has its partition, part and task attempt, so a task that runs
    again, or twice at once, leaves the files of the other attempt as they are; the table of shards has those that count.
    """
    ordered = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(-1)).alias("doc"), F.col(text_col).alias("text"))
    ordered = ordered.repartitionByRange("doc").sortWithinPartitions("doc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, attempt, encoder = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), Encoder.get(form.tokenizer, form.keeps_spaces)
        end, cut, held, docs_in, lengths, total = np.array([form.end_id], "<u4").tobytes(), 0, [], [], [], 0

        def flush() -> pa.RecordBatch:
            path = f"{folder}/shard-{part:06d}-{cut:04d}-{attempt}"
            publish(f"{path}.bin", b"".join(held))
            publish(f"{path}.idx", np.concatenate([[0], np.cumsum(lengths)]).astype("<i8").tobytes())
            publish(f"{path}.doc", np.array(docs_in, "<i8").tobytes())
            return pa.RecordBatch.from_pydict({"shard": pa.array([(part << 32) + cut]), "path": [path], "n_docs": [len(docs_in)], "n_tokens": [total]})

        for batch in batches:
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text"), strict=True):
                ids = np.frombuffer(encoder.ids(text.as_py()) + end, "<u4")
                held.append(ids.astype(form.dtype).tobytes())
                docs_in.append(doc)
                lengths.append(len(ids))
                total += len(ids)
                if total >= form.shard_ids:
                    yield flush()
                    cut, held, docs_in, lengths, total = cut + 1, [], [], [], 0
        if docs_in:
            yield flush()

    return ordered.mapInArrow(write, SHARDS)


def with_bases(shards: DataFrame) -> DataFrame:
    """Adds each shard's base: the ids of all shards before it. One row per shard, so one window task is enough."""
    return shards.withColumn("base", F.coalesce(F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def mapped(uri: str, dtype: str) -> np.ndarray:
    """The file memory-mapped, or read where the store isn't mounted."""
    if path := local_path(uri):
        return np.memmap(path, dtype, "r")
    system, path = open_fs(uri)
    with system.open_input_file(path) as file:
        return np.frombuffer(file.read(), dtype)


def read_documents(spark: SparkSession, shards: DataFrame, form: TokenFormat, with_ids: bool = False) -> DataFrame:
    """One row per document of the shards: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and ids if asked for."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, docs = mapped(row["path"] + ".bin", form.dtype), mapped(row["path"] + ".idx", "<i8"), mapped(row["path"] + ".doc", "<i8")
                for at in range(0, len(docs), 8192):
                    bounds = offsets[at : at + 8193]
                    own = [np.asarray(ids[a:b], "<u4") for a, b in zip(bounds, bounds[1:], strict=False)]
                    out = {"doc_id": np.array(docs[at : at + 8192]), "start": row["base"] + np.array(bounds[:-1]), "n_tokens": np.diff(bounds), "ids_crc32": np.array([zlib.crc32(x) for x in own], np.int64)}
                    out = {k: pa.array(v, pa.int64()) for k, v in out.items()}
                    if with_ids:
                        out["ids"] = pa.array([x.astype(np.int64) for x in own], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    return shards.repartition(max(1, min(shards.count(), 1 << 16))).mapInArrow(read, schema)  # a task for each shard, or several
