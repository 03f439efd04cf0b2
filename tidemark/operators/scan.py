"""Scans along an order (W1, W2, W4): ordinals, fill-down and sticky flags, with the rows of one key spread over many tasks.

A window without end keeps a key in one task. Here rows are cut into runs: ranges of (keys, order), or parts in which they
are laid out already. Each task scans its run as it streams by and tells what it ends with, at most two rows for each run
(its first and its last key); a prefix pass over those rows gives what each run inherits, and that is added to its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tidemark.session import scratch

MOST_BROADCAST = 100_000  # rows of what runs inherit that are sent to every task; more of them are joined by a shuffle


def changes(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """For each row but the first: does it differ from the one before in any of the columns? Nulls are equal."""
    out = np.zeros(max(0, batch.num_rows - 1), bool)
    for name in columns:
        a = batch.column(name)
        one, two = a.slice(0, len(a) - 1), a.slice(1)
        other = pc.fill_null(pc.not_equal(one, two), False)
        out |= np.asarray(pc.or_(other, pc.xor(one.is_null(), two.is_null())))
    return out


class Run:
    """What a task knows of the key that it is in: the rows so far, the last value of each filled column, and where it stood."""

    def __init__(self, keys: list[str], filled: list[str], every: bool):
        self.keys, self.filled, self.every = keys, filled, every
        self.key: tuple | None = None
        self.rows, self.first, self.last, self.held = 0, True, dict.fromkeys(filled), None
        self.stood = dict.fromkeys(filled, 0)

    def scanned(self, batch: pa.RecordBatch, part: pa.Array) -> Iterator[pa.RecordBatch]:
        """The batch with its local columns, and a row that sums up each key that ends here and may go on in another run."""
        n = batch.num_rows
        at = np.arange(n)
        new = np.concatenate([[self.key != tuple(batch.column(k)[0].as_py() for k in self.keys)], changes(batch, self.keys)])
        if new[0]:
            yield from self.ended()
            self.rows = 0
            self.last, self.stood = dict.fromkeys(self.filled), dict.fromkeys(self.filled, 0)
        start = np.maximum.accumulate(np.where(new, at, 0))
        goes_on = start == 0
        rows = at - start + 1 + np.where(goes_on, self.rows, 0)
        columns, names = [*batch.columns, part, pa.array(rows)], [*batch.schema.names, "_part", "_rows"]
        for c in self.filled:
            values = batch.column(c)
            seen = np.maximum.accumulate(np.where(np.asarray(values.is_valid()), at, -1))
            known = seen >= start
            stood = np.where(known, rows[np.maximum(seen, 0)], np.where(goes_on, self.stood[c], 0))
            inherits = goes_on & ~known if self.last[c] is not None else np.zeros(n, bool)
            found = pa.concat_arrays([values, *([self.last[c]] if inherits.any() else [])])
            found = found.take(pa.array(np.where(known, seen, n), mask=~(known | inherits)))
            columns, names = [*columns, found, pa.array(stood)], [*names, f"_fill_{c}", f"_stood_{c}"]
        out = pa.RecordBatch.from_arrays([*columns, pa.array(np.zeros(n, bool))], [*names, "_sum"])
        for i in np.flatnonzero(new):
            if i:
                self.held = out.slice(i - 1, 1)
                yield from self.ended()
            self.key = ()
        self.key, self.rows, self.held = tuple(batch.column(k)[n - 1].as_py() for k in self.keys), int(rows[-1]), out.slice(n - 1, 1)
        for c in self.filled:
            last = out.column(f"_fill_{c}").slice(n - 1, 1)
            self.last[c] = last if last.is_valid()[0].as_py() else None
            self.stood[c] = int(out.column(f"_stood_{c}")[n - 1].as_py())
        yield out

    def ended(self, last: bool = False) -> Iterator[pa.RecordBatch]:
        if self.held is not None and (self.first or last or self.every):
            yield self.held.set_column(self.held.num_columns - 1, "_sum", pa.array([True]))
        self.first = self.held is None


def local_scans(df: DataFrame, keys: list[str], filled: list[str], part: str | None) -> DataFrame:
    """Each task's own scan over its rows, in the order in which they come."""
    own = [*keys, part] if part else keys

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        state, number = Run(own, filled, part is not None), TaskContext.get().partitionId()
        for batch in batches:
            if batch.num_rows:
                yield from state.scanned(batch, batch.column(part).cast(pa.int64()) if part else pa.array(np.full(batch.num_rows, number), pa.int64()))
        yield from state.ended(last=True)

    fields = [StructField("_part", LongType()), StructField("_rows", LongType())]
    for c in filled:
        fields += [StructField(f"_fill_{c}", df.schema[c].dataType), StructField(f"_stood_{c}", LongType())]
    return df.mapInArrow(run, StructType([*df.schema, *fields, StructField("_sum", BooleanType())]))


def segmented_scan(
    df: DataFrame, keys: list[str], order: list[Column] | None = None, part: str | None = None, ordinal: str | None = None,
    fill: dict[str, str] | None = None, since: dict[str, str] | None = None,
) -> DataFrame:
    """``df`` with, for each row among those of its key: ``ordinal`` (from 1), ``fill`` {new: column}, ``since`` {new: column}.

    A filled column holds the last value of ``column`` that isn't null, up to and with the row; null before the first. A
    since-column counts the rows since that value (0 in its own row; null before the first), which is the ordinal within a
    block. A sticky flag is a fill of a column that is true or null. Give either ``order`` (columns; ties come in any
    order) or ``part``: an integer column that ascends within a key, when every task holds whole parts with their rows in
    order and reading them again gives the same rows (a source of byte ranges). Null keys are one key; an empty table stays
    empty; columns named as new ones, or beginning with ``_part``, ``_rows``, ``_fill_``, ``_stood_`` or ``_sum``, are an error.
    """
    fill, since = fill or {}, since or {}
    made = [*([ordinal] if ordinal else []), *fill, *since]
    if taken := [c for c in df.columns if c in made or c.startswith(("_part", "_rows", "_fill_", "_stood_", "_sum", "_before"))]:
        raise ValueError(f"columns in the way: {taken}")
    if (order is None) == (part is None):
        raise ValueError("give order or part")
    filled = sorted({*fill.values(), *since.values()})
    if order is not None:
        at = [*(F.col(k).asc_nulls_first() for k in keys), *order]
        df = df.repartitionByRange(*at).sortWithinPartitions(*at)
    runs = local_scans(df, keys, filled, part)
    if order is not None:  # ranges are drawn anew each time; a written table keeps them
        path = scratch(df.sparkSession, "scan")
        runs.write.parquet(path)
        runs = df.sparkSession.read.schema(runs.schema).parquet(path)
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = [F.sum("_rows").over(earlier).alias("_before_rows")]
    reached = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    sums = runs.filter("_sum").withColumns({f"_stood_{c}": F.when(F.col(f"_fill_{c}").isNotNull(), F.col(f"_stood_{c}") + reached) for c in filled})
    for c in filled:
        before += [F.last(f"{x}_{c}", ignorenulls=True).over(earlier).alias(f"_before{x}_{c}") for x in ("_fill", "_stood")]
    inherited = sums.select(*(F.col(k).alias(f"_before_{i}") for i, k in enumerate(keys)), F.col("_part").alias("_before_part"), *before).filter("_before_rows IS NOT NULL")
    kept = scratch(df.sparkSession, "inherited")
    inherited.write.parquet(kept)
    inherited = df.sparkSession.read.schema(inherited.schema).parquet(kept)
    if inherited.count() <= MOST_BROADCAST:
        inherited = F.broadcast(inherited)
    same = F.col("_part") == F.col("_before_part")
    for i, k in enumerate(keys):
        same &= F.col(k).eqNullSafe(F.col(f"_before_{i}"))
    rows = runs.filter("NOT _sum").join(inherited, same, "left")
    total = F.col("_rows") + F.coalesce("_before_rows", F.lit(0))
    new = {ordinal: total} if ordinal else {}
    new |= {out: F.coalesce(f"_fill_{c}", f"_before_fill_{c}") for out, c in fill.items()}
    for out, c in since.items():
        local = F.when(F.col(f"_fill_{c}").isNotNull(), F.col("_rows") - F.col(f"_stood_{c}"))
        new[out] = F.coalesce(local, total - F.col(f"_before_stood_{c}"))
    return rows.select(*df.columns, *(x.alias(name) for name, x in new.items()))
