"""Best-fit packing of documents into sequences of fixed length, by linear grouping.

The lengths of all pieces form a histogram of at most ``capacity`` entries, so the plan is made from counts alone:

1. the large lengths (at least an eighth or a quarter of the capacity, whichever ends in fewer sequences), in descending
   order, are cut into ``groups`` groups of equal cardinality, and each is rounded up to the largest of its group;
2. configurations of these few sizes are optimised: the fewest sequences that hold them, by column generation with a
   knapsack, of which the whole parts are taken;
3. actual lengths take the rounded places, the longest of a group first; the last place of a sequence may take a longer
   one, up to all the room that the others left. Half of each configuration is filled so; what is left is grouped and
   configured anew, until no whole part is left;
4. the small lengths and what the whole parts left over go, longest first, where the room left is the least that suffices
   (best fit), or into new sequences.

A plan is a list of runs: so many sequences that hold the same actual lengths. Documents find their place by their rank
among those of equal length; ranks come from prefix sums over hashed buckets, so no length, however common, meets in one
task.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.shared import bound_batches, written
from tidemark.llm.tokens import Encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces_of(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, keeps_spaces: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's ids and ``end_id`` (null: empty), cut from the end into pieces of ``capacity``, so that only the first may be shorter."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = Encoder.get(tokenizer, keeps_spaces), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encoder.ids(text.as_py()) + end
                n = len(ids) // 4
                first = n % capacity or capacity
                for k, stop in enumerate(range(first, n + 1, capacity)):
                    begin = stop - capacity if k else 0
                    rows.append((doc, k, begin, stop - begin, zlib.crc32(ids[4 * begin : 4 * stop])))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), *[pa.int64()] * 3), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    bound_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECES)


def dearest(sizes: np.ndarray, worth: np.ndarray, capacity: int) -> np.ndarray:
    """Counts of ``sizes`` that fit into ``capacity`` and are worth most together (unbounded knapsack)."""
    best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)  # and the size that was put in last
    for i, size in enumerate(sizes):
        if worth[i] > 1e-12:
            for _ in range(capacity // int(size)):
                more = best[:-size] + worth[i]
                gain = np.flatnonzero(more > best[size:] + 1e-12)
                if not len(gain):
                    break
                best[gain + size], last[gain + size] = more[gain], i
    counts, at = np.zeros(len(sizes), np.int64), int(best.argmax())
    left = best[at]
    while left > 1e-12 and last[at] >= 0:
        counts[last[at]] += 1
        at -= int(sizes[last[at]])
        left = best[at]
    return counts


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(counts of each size, number of sequences): whole parts of the least fractional number of sequences that hold ``demand``.

    Column generation: the simplex method on one row for each size, which prices configurations by a knapsack. It ends
    when no configuration is worth more than a sequence, or after 20 steps for each size, which only costs quality.
    """
    columns = [np.eye(len(sizes), dtype=np.int64)[i] * (capacity // int(s)) for i, s in enumerate(sizes)]
    inverse = np.diag([1 / c.max() for c in columns])
    amount = inverse @ demand
    for _ in range(20 * len(sizes)):
        worth = inverse.sum(0)
        new = dearest(sizes, worth, capacity)
        if worth @ new <= 1 + 1e-9:
            break
        step = inverse @ new
        ratio = np.where(step > 1e-9, amount / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        amount = amount - ratio[out] * step
        amount[out] = ratio[out]
        row = inverse[out] / step[out]
        inverse = inverse - np.outer(step, row)
        inverse[out] = row
        columns[out] = new
    whole = np.floor(np.maximum(amount, 0) + 1e-6).astype(np.int64)
    short = demand.astype(np.int64).copy()
    chosen = []
    for c, n in zip(columns, whole, strict=True):
        n = min(int(n), *(int(short[i]) // int(c[i]) for i in np.flatnonzero(c)))
        if n:
            short -= n * c
            chosen.append((c, n))
    return chosen


def groups_of(left: np.ndarray, groups: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rounded sizes (descending), how many lengths each stands for, and its shortest length; ``left`` counts each length."""
    lengths = np.arange(len(left) - 1, int(np.ceil(least)) - 1, -1)
    below = np.cumsum(left[lengths])
    total = int(below[-1]) if len(below) else 0
    ends = np.arange(1, min(groups, total) + 1) * total // max(min(groups, total), 1)
    starts = np.concatenate([[0], ends])[:-1]
    longest, shortest = lengths[np.searchsorted(below, starts, side="right")], lengths[np.searchsorted(below, ends - 1, side="right")]
    sizes = np.unique(longest)[::-1]  # groups with one longest length are one
    return sizes, np.array([(ends - starts)[longest == s].sum() for s in sizes], np.int64), np.array([shortest[longest == s].min() for s in sizes], np.int64)


def substituted(places: list[tuple[int, int]], left: np.ndarray, capacity: int) -> list[int]:
    """For each place (size, shortest length of its group) the longest length left in its group; the last one's may fill all the room. Empty where one is lacking."""
    own: list[int] = []
    for k, (size, shortest) in enumerate(places):
        top = capacity - sum(own) if k == len(places) - 1 else size
        found = next((int(n) for n in range(top, shortest - 1, -1) if left[n] > own.count(n)), 0)
        if not found:
            return []
        own.append(found)
    return own


def grouped(histogram: dict[int, int], capacity: int, groups: int, small: float) -> list[tuple[int, list[int]]]:
    """Rounds of linear grouping of the lengths of at least ``small`` of the capacity, then best fit of all that has no place yet.

    The rounds go on until none gives a whole part: at most about two for each doubling of the number of lengths.
    """
    left = np.zeros(capacity + 1, np.int64)
    left[list(histogram)] = list(histogram.values())
    runs: list[tuple[int, list[int]]] = []
    placed = True
    while placed:
        placed = False
        sizes, demand, shortest = groups_of(left, groups, small * capacity)
        for counts, whole in configurations(sizes, demand, capacity) if len(sizes) else []:
            slots = [(int(sizes[i]), int(shortest[i])) for i in np.repeat(np.arange(len(sizes)), counts)]
            times = -(-whole // 2)
            while times and (own := substituted(slots, left, capacity)):
                step = min(times, *(int(left[n]) // own.count(n) for n in own))  # sequences that hold the same lengths, as long as those last
                left[own] -= np.array([own.count(n) * step for n in own])
                runs.append((step, own))
                times, placed = times - step, True
    return best_fit(runs, {int(n): int(left[n]) for n in np.flatnonzero(left)}, capacity)


def plan(histogram: dict[int, int], capacity: int, groups: int = 64, small: tuple[float, ...] = (1 / 8, 1 / 4)) -> list[tuple[int, list[int]]]:
    """Runs (number of sequences, lengths in each) that hold every length of the histogram once for each of its count.

    Which lengths are small is tried in turn: what is left to best fit should fill the room that the groups leave.
    """
    return min((grouped(histogram, capacity, groups, s) for s in small), key=lambda runs: sum(times for times, _ in runs))


def best_fit(runs: list[tuple[int, list[int]]], small: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Adds the small lengths, longest first, each where the least room that suffices is left."""
    by_room: dict[int, list[tuple[int, list[int]]]] = defaultdict(list)
    for times, lengths in runs:
        by_room[capacity - sum(lengths)].append((times, lengths))
    for n in sorted(small, reverse=True):
        left = small[n]
        for room in range(n, capacity + 1):
            while left and by_room[room]:
                times, lengths = by_room[room].pop()
                fit = min(room // n, left)
                use = min(times, left // fit)
                if use < times:
                    by_room[room].append((times - use, lengths))
                by_room[room - fit * n].append((use, lengths + [n] * fit))
                left -= fit * use
        while left:
            fit = min(capacity // n, left)
            by_room[capacity - fit * n].append((left // fit, [n] * fit))
            left -= fit * (left // fit)
    return [run for room in sorted(by_room) for run in by_room[room]]


def places(runs: list[tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """For each length the columns first rank, first sequence, sequences, how often in a sequence, offset of the first there."""
    out: dict[int, list[tuple[int, int, int, int, int]]] = defaultdict(list)
    rank: dict[int, int] = defaultdict(int)
    sequence = 0
    for times, lengths in runs:
        offset = 0
        for n in sorted(set(lengths), reverse=True):
            each = lengths.count(n)
            out[n].append((rank[n], sequence, times, each, offset))
            rank[n] += times * each
            offset += n * each
        sequence += times
    return {n: np.array(x, np.int64) for n, x in out.items()}


def pack(pieces: DataFrame, capacity: int = 1024, groups: int = 64, bucket_rows: int = 1_000_000) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces (doc_id, piece, length, ...); lengths are 1 to ``capacity``.

    Repeated rows each get a place of their own. A null doc_id is a value like any other. An empty table stays empty.
    Other columns are kept; columns named sequence_id or offset are replaced.
    """
    pieces = written(pieces.drop("sequence_id", "offset"), "pieces")
    pieces = pieces.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(1024 + pieces.count() // bucket_rows)).cast("int"))
    counts = written(pieces.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n")), "lengths")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()}  # at most ``capacity`` rows
    lookup = places(plan(histogram, capacity, groups))
    base = counts.withColumn("_base", F.sum("_n").over(Window.partitionBy("length").orderBy("_bucket")) - F.col("_n")).drop("_n")
    local = F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece")) - 1
    ranked = pieces.withColumn("_local", local).join(base, ["length", "_bucket"]).withColumn("_rank", F.col("_base") + F.col("_local")).drop("_base", "_local", "_bucket")
    shared = ranked.sparkSession.sparkContext.broadcast(lookup)  # at most a few rows for each length and run
    names = [c for c in ranked.columns if c != "_rank"]

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                rows, runs = np.flatnonzero(length == n), shared.value[int(n)]
                first, begin, _, each, at = runs[np.searchsorted(runs[:, 0], rank[rows], side="right") - 1].T
                sequence[rows] = begin + (rank[rows] - first) // each
                offset[rows] = at + (rank[rows] - first) % each * n
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema.fields if f.name != "_rank")
    return ranked.mapInArrow(locate, f"{schema}, sequence_id long, offset long")
