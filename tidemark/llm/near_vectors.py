"""Near-duplicate embeddings by Euclidean p-stable hashing and exact cosine checks.

A normalised vector's key in a table is a hash of ``projections`` quantised random projections, floor((a.x + b) / w).
The number of projections grows with the logarithm of the vectors under one label, so that a bucket holds about one
unrelated vector, and the number of tables then follows from the recall wanted at the threshold. Within a bucket every
pair is compared by matrix products; a pair counts only in the first table where it meets. Buckets beyond ``chunk``
vectors are compared chunk by chunk, each pair of chunks a task. No pair leaves a task: it gives each vector's count and
a forest of edges. Equal vectors are one, with a multiplicity.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.shared import written


@dataclass(frozen=True)
class Lsh:
    cosine: float = 0.93
    width: float = 1.6
    recall: float = 0.998  # of pairs just at the threshold; closer pairs are found more surely
    chunk: int = 2048
    part_rows: int = 20_000
    seed: int = 5

    def meet(self, distance: float) -> float:
        """Chance that two vectors at a distance share one quantised projection."""
        r = self.width / max(distance, 1e-9)
        tail = 0.5 * math.erfc(r / math.sqrt(2))
        return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))

    def shape(self, n: int) -> tuple[int, int]:
        """Projections and tables for n vectors under a label."""
        k = max(2, math.ceil(math.log(max(n, 2)) / -math.log(self.meet(math.sqrt(2)))))
        found = self.meet(math.sqrt(2 - 2 * self.cosine)) ** k
        return k, max(1, math.ceil(math.log(1 - self.recall) / math.log(1 - found)))


@lru_cache(maxsize=4)
def projections(dims: int, count: int, lsh: Lsh) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Directions, shifts and odd multipliers, drawn once for each worker."""
    rng = np.random.default_rng([lsh.seed, dims])
    return rng.standard_normal((dims, count)), rng.uniform(0, lsh.width, count), rng.integers(1, 1 << 63, count, dtype=np.uint64) | np.uint64(1)


def keys_of(x: np.ndarray, k: int, tables: int, lsh: Lsh) -> np.ndarray:
    """The keys (one for each table) of normalised vectors."""
    planes, shift, odd = projections(x.shape[1], k * tables, lsh)
    cells = np.floor((x @ planes + shift) / lsh.width).astype(np.int64).view(np.uint64).reshape(len(x), tables, k)
    mixed = (cells * odd[:k]).sum(2, dtype=np.uint64)
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(32))).view(np.int64)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths as unit vectors in double precision."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # neither over- nor underflows
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def connected(linked: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges (least, other) that connect what a symmetric matrix links."""
    unseen = linked.any(1)
    for start in np.flatnonzero(unseen):
        if not unseen[start]:
            continue
        front = np.array([start])
        unseen[start] = False
        while len(front):
            front = np.flatnonzero(linked[front].any(0) & unseen)
            unseen[front] = False
            yield from ((start, v) for v in front)


def compare(x: np.ndarray, copies: np.ndarray, side: np.ndarray, table: int, k: int, tables: int, lsh: Lsh) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Of the vectors of a bucket: how many they link with first in this table, and edges that connect them."""
    linked = x @ x.T >= lsh.cosine
    np.fill_diagonal(linked, False)
    if side.any() and not side.all():
        linked &= side[:, None] != side[None, :]
    elif not linked.any():
        return np.zeros(len(x), np.int64), []
    a, b = np.nonzero(np.triu(linked))
    counts = np.zeros(len(x), np.int64)
    if len(a):
        rows = np.flatnonzero(linked.any(1))
        keys = np.zeros((len(x), tables), np.int64)
        keys[rows] = keys_of(x[rows], k, tables, lsh)
        for at in range(0, len(a), 1 << 16):
            i, j = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
            first = ~(keys[i, :table] == keys[j, :table]).any(1)
            np.add.at(counts, i[first], copies[j[first]])
            np.add.at(counts, j[first], copies[i[first]])
    return counts, list(connected(linked))


def near_vectors(vectors: DataFrame, lsh: Lsh = Lsh(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """vec_id, n_links, component_id and kept for every row.

    Vectors link when labels are equal and not null and their cosine is at least ``lsh.cosine``. A null, empty or zero
    vector, one with a null or non-finite component, and a row with a null id link with nothing (component: its own id).
    Vectors of different length don't link. Of equal vectors each links with all others. Rows with equal ids each have a result. An empty table gives an empty result.
    Other columns are ignored.
    """
    bad = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) | ~F.exists("x", lambda v: v != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("x"))
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"  # half the bytes, and exact in double precision
    rows = rows.withColumn("x", F.col("x").cast("array<float>" if single else "array<double>"))
    fine = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & ~F.coalesce(bad, F.lit(True))
    rows = rows.withColumn("x", F.when(fine, F.transform("x", lambda v: v + F.lit(0.0).cast("float" if single else "double"))))
    rows = rows.withColumn("h1", F.xxhash64("label", "x")).withColumn("h2", F.xxhash64(F.lit(1), "x", "label"))
    valid = rows.filter("x IS NOT NULL")
    reps = written(valid.groupBy("h1", "h2").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("x").alias("x")), "vectors")
    most = reps.groupBy("label", F.size("x")).count().agg(F.max("count")).first()[0] or 0
    k, tables = lsh.shape(most)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(batch.column("x").offsets.to_numpy())
            for n in np.unique(lengths):
                part = batch.filter(pa.array(lengths == n))
                for at in range(0, part.num_rows, 1024):
                    some = part.slice(at, 1024)
                    keys = keys_of(matrix(some.column("x")), k, tables, lsh)
                    rep = lambda c: some.column(c).take(pa.array(np.repeat(np.arange(len(keys)), tables)))  # noqa: B023, E731
                    yield pa.RecordBatch.from_arrays([rep("id"), rep("label"), pa.array(np.full(keys.size, n), pa.int32()), pa.array(np.tile(np.arange(tables), len(keys)), pa.int32()), pa.array(keys.reshape(-1))], names=["id", "label", "dims", "tab", "key"])

    keyed = reps.select("id", "label", "x").mapInArrow(hashed, "id long, label string, dims int, tab int, key long")
    keyed = keyed.select("id", "tab", F.xxhash64("label", "dims", "tab", "key").alias("bucket"))
    met = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").withColumn("chunks", F.ceil(F.col("n") / lsh.chunk))
    keyed = keyed.join(met.select("bucket", "chunks"), "bucket").withColumn("own", F.pmod(F.xxhash64("id"), F.col("chunks")))
    tasks = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1), lambda c: F.struct((F.least(c, F.col("own")) * F.col("chunks") + F.greatest(c, F.col("own"))).alias("task"), F.when(F.col("own") > c, 1).otherwise(0).alias("side")))
    parts = max(32, most and int(reps.count() * tables // lsh.part_rows))
    dealt = keyed.select("id", "tab", "bucket", F.explode(tasks).alias("t")).select("id", "tab", "bucket", "t.task", "t.side")
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("bucket", "task"), F.lit(parts))).join(reps.select("id", "copies", "x"), "id")

    def check(table: pa.Table) -> pa.Table:
        table = table.sort_by([("bucket", "ascending"), ("task", "ascending")]).combine_chunks()
        get = lambda c: table.column(c).to_numpy()
        ids, copies, side, tab, bucket, task = (get(c) for c in ("id", "copies", "side", "tab", "bucket", "task"))
        lists = table.column("x").combine_chunks()
        new = np.ones(len(ids), bool)
        new[1:] = (bucket[1:] != bucket[:-1]) | (task[1:] != task[:-1])
        bounds = np.append(np.flatnonzero(new), len(ids))
        out_id, out_links, edges = [], [], []
        for a, b in zip(bounds, bounds[1:], strict=False):
            if b - a < 2:
                continue
            x = matrix(lists.slice(a, b - a))
            counts, found = compare(x, copies[a:b], side[a:b], int(tab[a]), k, tables, lsh)
            hit = np.flatnonzero(counts)
            out_id.extend(ids[a + hit].tolist())
            out_links.extend(counts[hit].tolist())
            edges.extend((int(ids[a + p]), int(ids[a + q])) for p, q in found)
        n = len(out_id)
        return pa.table({"id": pa.array(out_id + [e[0] for e in edges], pa.int64()), "links": pa.array(out_links + [None] * len(edges), pa.int64()), "peer": pa.array([None] * n + [e[1] for e in edges], pa.int64())})

    found = written(dealt.groupBy("part").applyInArrow(check, "id long, links long, peer long"), "links")
    links = found.filter("links IS NOT NULL").groupBy("id").agg(F.sum("links").alias("links"))
    components = connected_components(found.filter("peer IS NOT NULL"), "id", "peer")
    known = reps.select("h1", "h2", "id", "copies").join(links, "id", "left").join(components, "id", "left")
    out = rows.select("vec_id", F.when(F.col("x").isNotNull(), F.col("h1")).alias("h1"), "h2").join(known, ["h1", "h2"], "left")
    component = F.coalesce("component", "id", "vec_id")
    return out.select("vec_id", F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
