"""Exact Jaccard self-join of shingle sets by partitioning the universe.

Sizes fall into bands. A pair is found in the band of its larger set, where the universe of shingles is hashed into
segments: two sets with Jaccard similarity of at least t differ in at most H = (1 - t) / (1 + t) * (sum of sizes) shingles,
so if a set assigns its segments values 0 (skip), 1 (equal) or 2 (equal up to one shingle) that add up to H + 1, a similar
set must agree with it in one of them. Every set is indexed by a signature of each segment, in the band of its own size
and in the next if a larger partner may be there; in bands where that pays, also by the segment's one-deletion
neighbourhood.

The values are chosen for least cost, and costs are counted: the first pass over the texts counts the signatures of all
segments by band and number of shingles in hashed buckets, whose sums of squares tell how many other sets share such a
signature. A value of 1 costs the sets that share the segment, a value of 2 those that share it without one of its
shingles. A band gets one-deletion neighbourhoods if the comparisons that they save its sets outweigh the entries.

Sets that share a signature some of them chose meet in the group of the least that chose it. There, those that chose one
are compared exactly with each other and with the rest; the rest are not compared among themselves, as a similar pair has a
signature that its larger set chose. So a signature that very many sets have and few chose, as of an empty segment, costs
as many comparisons as it has sets for each of those few. A signature that more sets have than a task should hold is dealt
out: the sets that chose it go to all of its shares, every other one to one.
Groups of more than ``chunk`` sets or ``chunk_shingles`` shingles are compared chunk by chunk: each pair of chunks of sets
that chose one is a task, and each of those chunks with a chunk of the rest.
Equal sets are one set from the start. Results are forests, not pairs: enough edges to connect what is linked, each of
them a verified link.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.llm.components import connected_components
from tidemark.llm.shared import utf8_slices, written
from tidemark.llm.textbytes import mix, shingle_sets

PROBES, DOC = np.int64(1), np.int64(-2)  # the lowest bit of an entry tells whether the set chose the segment


@dataclass(frozen=True)
class Join:
    numerator: int = 80  # of the threshold, in percent
    width: int = 5
    ratio: float = 1.5  # of the sizes in a band
    slack: float = 1.12  # segments beyond the fewest needed
    entry_cost: float = 1.0  # of one more entry in the index, where a comparison costs 10 and one for each 8 shingles
    chunk: int = 4096
    chunk_shingles: int = 1 << 21
    part_entries: int = 400_000

    def differ(self, total: np.ndarray | int) -> np.ndarray | int:
        """Most shingles in which two similar sets of together ``total`` can differ."""
        return (100 - self.numerator) * total // (100 + self.numerator)

    def bands(self) -> np.ndarray:
        """First sizes of the bands, as many as any text can need."""
        out = [1]
        while out[-1] < 1 << 40:
            out.append(max(out[-1] + 1, int(out[-1] * self.ratio)))
        return np.array(out, np.int64)


CLASSES, BUCKETS = 16, 1024  # numbers of shingles in a segment (the last: that many or more), and buckets to count signatures in


def set_id(values: np.ndarray) -> int:
    """63 bits (the lowest is 0) of a digest of a set."""
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True) & ~1


def describe_sets(docs: DataFrame, join: Join) -> DataFrame:
    """doc_id, n_shingles and set (an id that equal sets share; null if empty), one row per row of docs (id, text); and for each task one row of counts of signatures (cells, counts), where the others have null."""
    first_of = join.bands()

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_shingles", "set", "cells", "counts"]
        lists = lambda n: [pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.int64()))]
        counted, seen = np.zeros(len(first_of) * CLASSES * BUCKETS, np.int64), set()
        for batch in batches:
            for part, texts in utf8_slices(batch, "text", SLICE):
                values, first, _ = shingle_sets(texts, join.width)
                sets = [set_id(values[a:b]) if b > a else None for a, b in zip(first, first[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(first), pa.int64()), pa.array(sets, pa.int64()), *lists(len(sets))], names=names)
                values, owner, sizes, _ = distinct_sets(values, first, [x or 0 for x in sets], seen)
                if len(sizes):
                    band = np.searchsorted(first_of, sizes, side="right") - 1
                    found = Segments(values, owner, sizes, band, first_of, join)
                    bucket = (found.exact >> np.uint64(40)) % np.uint64(BUCKETS)
                    cell = (band[found.holder] * CLASSES + np.minimum(found.count, CLASSES - 1)) * BUCKETS + bucket.astype(np.int64)
                    counted += np.bincount(cell, minlength=len(counted))
        used = np.flatnonzero(counted)
        if len(used):
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, pa.int64()) for _ in range(3)), pa.array([used], pa.list_(pa.int32())), pa.array([counted[used]], pa.list_(pa.int64()))], names=names)

    return docs.mapInArrow(describe, "doc_id long, n_shingles long, set long, cells array<int>, counts array<long>")


SLICE = 2 << 20  # bytes of text that a task works on at once


def distinct_sets(values: np.ndarray, first: np.ndarray, ids: list[int], seen: set[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Values, their owners, sizes and ids of the sets that a task has not seen yet."""
    sizes, keep = np.diff(first), np.zeros(len(ids), bool)
    for i, x in enumerate(ids):
        if sizes[i] and x not in seen:
            keep[i] = True
            seen.add(x)
    rows = np.repeat(keep, sizes)
    return values[rows], np.repeat(np.cumsum(keep) - 1, sizes)[rows], sizes[keep], np.array(ids, np.int64)[keep]


@dataclass(frozen=True)
class Costs:
    """By band and number of shingles in a segment: cost of the values 1 and 2 above that, and shares into which a signature is
    dealt. By band: whether it has one-deletion neighbourhoods."""

    one: np.ndarray
    two: np.ndarray
    deletions: np.ndarray
    shares: np.ndarray


def costs(described: DataFrame, join: Join) -> Costs:
    """From the counts of all signatures, added up natively; a row for each band and number of shingles comes to the driver."""
    first_of = join.bands()
    cells = described.filter("cells IS NOT NULL").select(F.explode(F.arrays_zip("cells", "counts")).alias("c")).groupBy("c.cells").agg(F.sum("c.counts").alias("n"))
    n = F.col("n").cast("double")
    rows = cells.groupBy(F.floor(F.col("cells") / BUCKETS).alias("kind")).agg(F.sum(n).alias("n"), F.sum(n * n).alias("squares")).collect()
    total, squares = np.zeros(len(first_of) * CLASSES), np.zeros(len(first_of) * CLASSES)
    for r in rows:
        total[r["kind"]], squares[r["kind"]] = r["n"], r["squares"]
    total, squares = total.reshape(-1, CLASSES), squares.reshape(-1, CLASSES)
    # unequal signatures in one bucket add total ** 2 / BUCKETS to the squares; two standard errors count as none
    others = np.maximum((squares - total * total / BUCKETS) / (1 - 1 / BUCKETS) / np.maximum(total, 1) - 1 - 2 * (2 / BUCKETS) ** 0.5, 0)
    size = np.arange(CLASSES)
    one = others + 1e-3 / (size + 1)  # of segments that cost the same, the larger
    two = np.where(size > 0, size * np.roll(one, 1, axis=1), np.inf)
    deletions = np.zeros(len(first_of), bool)
    for b in np.flatnonzero(total.sum(1)):
        top = int(first_of[b + 1]) - 1 if b + 1 < len(first_of) else int(first_of[b])
        sets = total[b].sum() / segments_of(np.array([top]), join)[0]
        each, mean = total[b] / sets, float(total[b] @ size) / sets  # segments of each kind that a set has, and its shingles
        need = float(join.differ(2 * mean) // 1 + 1)

        def least(price: np.ndarray, amount: np.ndarray, left: float) -> float:
            spent = 0.0
            for i in np.argsort(price, kind="stable"):
                take = min(left, amount[i])
                spent, left = spent + (take * price[i] if take else 0.0), left - take
            return spent

        saved = least(one[b], each, need) - least(np.concatenate([one[b], two[b][1:]]), np.concatenate([each, each[1:]]), need)
        deletions[b] = saved * (10 + mean / 8) > mean * join.entry_cost
    # sets of the band before may be there as well, so twice the sets of the band itself
    shares = np.maximum(np.ceil(2 * others / join.part_entries), 1).astype(np.int64)
    return Costs(one, two, deletions, shares)


def segments_of(top: np.ndarray, join: Join) -> np.ndarray:
    """Segments in bands whose largest size is ``top``."""
    return np.ceil((join.differ(2 * top) + 1) * np.where(top >= 8, join.slack, 1)).astype(np.int64)


class Segments:
    """Segments of sets in given bands. holder: of each segment its set; count: its shingles; exact: its signature; at: of each shingle its segment."""

    def __init__(self, values: np.ndarray, owner: np.ndarray, sizes: np.ndarray, band: np.ndarray, first_of: np.ndarray, join: Join):
        segments = segments_of(first_of[band + 1] - 1, join)
        base = np.concatenate([[0], np.cumsum(segments)])
        salt = mix(band.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(1))
        self.mixed = mix(values ^ salt[owner])
        self.at = base[:-1][owner] + ((self.mixed >> np.uint64(33)) % segments.astype(np.uint64)[owner]).astype(np.int64)
        self.count = np.bincount(self.at, minlength=base[-1])
        self.total = np.zeros(base[-1], np.uint64)
        np.add.at(self.total, self.at, self.mixed)
        self.holder = np.repeat(np.arange(len(sizes)), segments)
        self.place = mix(salt[self.holder] + (np.arange(base[-1]) - base[:-1][self.holder]).astype(np.uint64))
        self.exact = mix(self.total ^ self.place)


def dealt_out(sig: np.ndarray, entry: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures that very many sets have (an empty segment, above all) in shares: sets that chose one go to every share of
    it, any other to the share that its id says. So all shares know the least set that chose it."""
    if (shares == 1).all():
        return sig, entry
    times = np.where(entry & PROBES, shares, 1)
    row = np.repeat(np.arange(len(sig)), times)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    own = (mix((entry & DOC).view(np.uint64)) % shares.astype(np.uint64)).astype(np.int64)
    share = np.where(entry[row] & PROBES, nth, own[row])
    return np.where(shares[row] > 1, mix(sig[row] ^ mix(share.astype(np.uint64) + np.uint64(1))), sig[row]), entry[row]


def signatures(values: np.ndarray, owner: np.ndarray, sizes: np.ndarray, ids: np.ndarray, band: np.ndarray, first_of: np.ndarray, own: bool, known: Costs, join: Join) -> tuple[np.ndarray, np.ndarray]:
    """Signatures and entries of sets in given bands. owner: each value's set; own: whether the sets choose segments (in their own band) or are only found."""
    s = Segments(values, owner, sizes, band, first_of, join)
    n, holder, at = len(s.exact), s.holder, s.at
    small = known.deletions[band]
    probes, twice = np.zeros(n, bool), np.zeros(n, bool)
    if own:
        need, kind = join.differ(2 * sizes) + 1, np.minimum(s.count, CLASSES - 1)
        upgrade = np.flatnonzero(small[holder] & (s.count > 0))
        item = np.concatenate([np.arange(n), upgrade])
        # a value of 2 is one more than a value of 1, so it comes after that
        price = np.concatenate([known.one[band[holder], kind], np.maximum(known.two[band[holder[upgrade]], kind[upgrade]], known.one[band[holder[upgrade]], kind[upgrade]])])
        order = np.lexsort((price, holder[item]))
        begin = np.searchsorted(holder[item][order], np.arange(len(sizes)))
        rank = np.arange(len(item)) - begin[holder[item][order]]
        chosen = order[rank < need[holder[item][order]]]
        probes[item[chosen[chosen < n]]] = True
        twice[item[chosen[chosen >= n]]] = True
    sig, entry, size = [s.exact], [ids[holder] | np.where(probes, PROBES, 0)], [s.count]
    if small.any():  # without one shingle: as found by sets one smaller, and, where the set chose 2, as the others have it
        here = np.flatnonzero(small[owner])
        sig.append(mix((s.total[at[here]] - s.mixed[here]) ^ s.place[at[here]]))
        entry.append(ids[owner[here]] | np.where(twice[at[here]], PROBES, 0))
        size.append(s.count[at[here]] - 1)
    of_band = np.concatenate([band[holder], *([band[owner[here]]] if small.any() else [])])
    sig, entry = dealt_out(np.concatenate(sig), np.concatenate(entry), known.shares[of_band, np.minimum(np.concatenate(size), CLASSES - 1)])
    return sig.view(np.int64), entry


def index(docs: DataFrame, join: Join, parts: int, known: Costs) -> DataFrame:
    """part, sigs, entries: the signatures of all distinct sets, dealt by signature, in arrays."""
    first_of = join.bands()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for _, texts in utf8_slices(batch, "text", SLICE):
                values, first, _ = shingle_sets(texts, join.width)
                values, owner, sizes, ids = distinct_sets(values, first, [set_id(values[a:b]) if b > a else 0 for a, b in zip(first, first[1:], strict=False)], seen)
                if not len(sizes):
                    continue
                band = np.searchsorted(first_of, sizes, side="right") - 1
                found = [signatures(values, owner, sizes, ids, band, first_of, True, known, join)]
                reach = sizes * 100 // join.numerator >= first_of[band + 1]  # a larger partner may be in the next band
                step = 1
                while reach.any():
                    chosen = np.cumsum(reach) - 1
                    rows = reach[owner]
                    found.append(signatures(values[rows], chosen[owner[rows]], sizes[reach], ids[reach], band[reach] + step, first_of, False, known, join))
                    step += 1
                    reach = sizes * 100 // join.numerator >= first_of[np.minimum(band + step, len(first_of) - 1)]
                sig, entry = (np.concatenate(x) for x in zip(*found, strict=True))
                part = (sig.view(np.uint64) >> np.uint64(20)) % np.uint64(parts)
                order = np.argsort(part, kind="stable")
                sig, entry, bounds = sig[order], entry[order], np.searchsorted(part[order], np.arange(parts + 1, dtype=np.uint64))
                used = np.flatnonzero(np.diff(bounds))
                offsets = pa.array(np.append(bounds[used], len(sig)), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(sig)), pa.ListArray.from_arrays(offsets, pa.array(entry))], names=["part", "sigs", "entries"])

    return docs.select("text").mapInArrow(emit, "part int, sigs array<long>, entries array<long>")


def meetings(indexed: DataFrame) -> DataFrame:
    """center, member, chose: for each signature with a set that chose it and another set, its sets, the least that chose it, and whether the set chose one of those that it shares with this center."""

    def meet(table: pa.Table) -> pa.Table:
        sig = table.column("sigs").combine_chunks().flatten().to_numpy()
        entry = table.column("entries").combine_chunks().flatten().to_numpy()
        order = np.lexsort((entry, sig))
        sig, entry = sig[order], entry[order]
        doc = entry & DOC
        new = np.ones(len(sig), bool)
        new[1:] = sig[1:] != sig[:-1]
        run = np.cumsum(new) - 1
        begin = np.flatnonzero(new)
        chosen = np.maximum.reduceat(entry & PROBES, begin) > 0 if len(begin) else np.zeros(0, bool)
        last = np.append(begin[1:], len(sig)) - 1
        keep = (chosen & (doc[last] != doc[begin]))[run]
        least = np.minimum.reduceat(np.where(entry & PROBES, doc, np.iinfo(np.int64).max), begin) if len(begin) else doc
        center, member = least[run][keep], entry[keep]
        pairs = np.unique(np.stack([center, member], 1), axis=0) if len(center) else np.zeros((0, 2), np.int64)
        return pa.table({"center": pa.array(pairs[:, 0]), "member": pa.array(pairs[:, 1] & DOC), "chose": pa.array((pairs[:, 1] & PROBES) > 0)})

    return indexed.groupBy("part").applyInArrow(meet, "center long, member long, chose boolean").groupBy("center", "member").agg(F.max("chose").alias("chose"))


def in_tasks(met: DataFrame, sizes: DataFrame, join: Join) -> DataFrame:
    """center, member, chose, task, side: the sets of each group in the tasks that compare them; side tells apart what is compared across only.

    sizes: member, size. With p chunks of sets that chose and q of the rest, task a * p + b, for each a <= b, has chunks a and b
    of the former (both side 0 where a = b), task p * p + a * q + c chunk a of the former and c of the rest.
    """
    chunks = lambda row: F.ceil(F.greatest(F.count(F.when(row, 1)) / join.chunk, F.coalesce(F.sum(F.when(row, F.col("size"))), F.lit(0)) / join.chunk_shingles))
    chose, p, q = F.col("chose"), F.col("p"), F.col("q")
    many = met.join(sizes, "member").groupBy("center").agg(chunks(F.lit(True)).alias("chunks"), chunks(chose).alias("p"), chunks(~chose).alias("q")).filter("chunks > 1").drop("chunks")
    dealt = met.join(many, "center", "left").withColumn("own", F.pmod(F.xxhash64("member"), F.when(chose, p).otherwise(q)))
    each = lambda n, task, side: F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda x: F.struct(task(x).cast("bigint").alias("task"), side(x).cast("int").alias("side")))).otherwise(F.expr("CAST(array() AS array<struct<task:bigint,side:int>>)"))
    own = F.col("own")
    met_all = each(p, lambda x: F.least(x, own) * p + F.greatest(x, own), lambda x: F.when(own > x, 1).otherwise(0))
    met_rest = each(q, lambda x: p * p + own * q + x, lambda x: F.lit(0))
    as_rest = each(p, lambda x: p * p + x * q + own, lambda x: F.lit(1))
    one = F.expr("array(named_struct('task', 0L, 'side', 0))")
    tasks = F.when(p.isNull(), one).when(chose, F.concat(met_all, met_rest)).otherwise(as_rest)
    return dealt.select("center", "member", "chose", F.explode(tasks).alias("t")).select("center", "member", "chose", "t.task", "t.side")


SKETCH_BITS = 8  # at least, for each shingle of a task's largest set


def parity_sketches(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of bits for each set, of which every shingle flips one. Two sets differ in no fewer shingles than their rows in bits.

    values ascend within each set, so the bits that their leading digits name do so too.
    """
    sizes = np.diff(first)
    log = max(6, int(SKETCH_BITS * sizes.max(initial=1) - 1).bit_length())
    place = (np.repeat(np.arange(len(sizes)), sizes) << log) + (values >> np.uint64(64 - log)).astype(np.int64)
    out = np.zeros(len(sizes) << (log - 6), np.uint64)
    if len(place):
        begin = np.flatnonzero(np.diff(place, prepend=-1))
        odd = place[begin][np.diff(np.append(begin, len(place))) % 2 == 1]
        word = odd >> 6
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        if len(odd):
            out[word[starts]] = np.bitwise_or.reduceat(np.uint64(1) << (odd & 63).astype(np.uint64), starts)
    return out.reshape(len(sizes), -1)


def forest(values: np.ndarray, first: np.ndarray, ids: np.ndarray, side: np.ndarray, join: Join, chose: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges that connect all linked sets: each set in turn is compared with those not yet connected to it.

    Sketches rule out what differs in too many shingles; shingles are compared for the rest alone. side: with 0 and 1 both
    there, only pairs between the two matter, as pairs within a side are another task's. chose: only pairs with such a set matter.
    """
    sizes = np.diff(first)
    order = np.argsort(-sizes, kind="stable")
    size, place, of_side = sizes[order], first[:-1][order], side[order]
    until = np.searchsorted(-100 * size, -join.numerator * size, side="right")  # those after are too small for a link
    sketch = parity_sketches(values, first)[order]
    _, token = np.unique(values, return_inverse=True)
    mark = np.zeros(int(token.max(initial=-1)) + 1, np.int64)
    root = np.arange(len(ids))
    edges: list[tuple[int, int]] = []
    cross = len(np.unique(side)) > 1
    of_choice = np.ones(len(ids), bool) if chose is None else chose[order]
    choosers = np.flatnonzero(of_choice)
    for i in range(len(ids)):
        if of_choice[i]:
            rest = np.flatnonzero(root[i + 1 : until[i]] != root[i]) + i + 1
        else:
            rest = choosers[np.searchsorted(choosers, i + 1) : np.searchsorted(choosers, until[i])]
            rest = rest[root[rest] != root[i]]
        if cross:
            rest = rest[of_side[rest] != of_side[i]]
        if len(rest):
            rest = rest[np.bitwise_count(sketch[rest] ^ sketch[i]).sum(1, dtype=np.int64) <= join.differ(size[i] + size[rest])]
        if not len(rest):
            continue
        own = token[place[i] : place[i] + size[i]]
        mark[own] = 1
        start = np.cumsum(size[rest]) - size[rest]
        rows = np.arange(start[-1] + size[rest[-1]]) + np.repeat(place[rest] - start, size[rest])
        shared = np.add.reduceat(mark[token[rows]], start)
        mark[own] = 0
        for j in rest[100 * shared >= join.numerator * (size[rest] + size[i] - shared)]:
            if root[j] != root[i]:
                edges.append((int(ids[order[i]]), int(ids[order[j]])))
                root[root == root[j]] = root[i]
    return edges


def verified(groups: DataFrame, join: Join) -> DataFrame:
    """src, dst of verified links within each group (center, task) of sets as ``in_tasks`` deals them, with their texts."""

    def verify(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        values, first, ids, side, chose, seen = [], [0], [], [], [], set()
        for batch in table.to_batches():
            for part, texts in utf8_slices(batch, "text"):
                v, f, _ = shingle_sets(texts, join.width)
                for i, (member, own, choice) in enumerate(zip(*(part.column(c).to_pylist() for c in ("member", "side", "chose")), strict=True)):
                    mine = v[f[i] : f[i + 1]]
                    if member in seen or set_id(mine) != member:  # another text under the same id
                        continue
                    seen.add(member)
                    first.append(first[-1] + len(mine))
                    values.append(mine)
                    ids.append(member)
                    side.append(own)
                    chose.append(choice)
        found = forest(np.concatenate(values), np.array(first), np.array(ids), np.array(side), join, np.array(chose)) if ids else []
        return pa.table({"src": pa.array([a for a, _ in found], pa.int64()), "dst": pa.array([b for _, b in found], pa.int64())})

    return groups.groupBy("center", "task").applyInArrow(verify, "src long, dst long")


def jaccard_components(docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest doc_id reachable by links, itself included) for every row.

    A null or blank text has no shingle and links with nothing, not even with another such text. Rows with equal texts
    link; so do rows with equal ids. Rows with a null id have a null component and connect nothing. An empty table gives
    an empty result. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    described = written(describe_sets(docs, join), "sets")
    sets = described.filter("cells IS NULL").drop("cells", "counts")
    known = sets.filter("doc_id IS NOT NULL AND set IS NOT NULL")
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    parts = max(64, total // 2 // join.part_entries)
    # one document stands for all with an equal set; written, as several places below need it
    alike = written(known.groupBy("set").agg(F.min("doc_id").alias("first"), F.first("n_shingles").alias("size")), "alike")
    met = written(meetings(index(docs.filter("doc_id IS NOT NULL"), join, int(parts), costs(described, join))), "meetings")
    dealt = in_tasks(met, alike.select(F.col("set").alias("member"), "size"), join)
    texts = docs.join(alike.select(F.col("first").alias("doc_id"), "set").join(met.select(F.col("member").alias("set")).distinct(), "set", "left_semi"), "doc_id").select(F.col("set").alias("_set"), "text")
    texts = texts.distinct()
    groups = dealt.join(texts, F.col("member") == F.col("_set")).select("center", "task", "side", "member", "chose", "text")
    # components are those of sets: copies of a text are one vertex, and rows with one id and different sets are links
    several = known.groupBy("doc_id").agg(F.min("set").alias("src"), F.max("set").alias("most")).filter("src < most")
    one_id = known.join(several.select("doc_id", "src"), "doc_id").filter("set <> src").select("src", F.col("set").alias("dst"))
    found = connected_components(verified(groups, join).unionByName(one_id))
    reached = alike.select("set", "first").join(found.withColumnRenamed("id", "set"), "set")
    least = reached.groupBy("component").agg(F.min("first").alias("least"))
    labels = alike.select("set", "first").join(reached.select("set", "component").join(least, "component").select("set", "least"), "set", "left").select("set", F.coalesce("least", "first").alias("label"))
    out = sets.withColumn("set", F.when(F.col("doc_id").isNotNull(), F.col("set"))).join(labels, "set", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("label", "doc_id").alias("component_id"))


def deduplicated(docs: DataFrame, join: Join = Join(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that a document with a smaller id in the same component stands for.

    Of rows with equal ids (or null ids) and equal sets of shingles one stays, whichever it is; those without a shingle all
    stay. A column "_set" of ``docs`` is not allowed.
    """
    found = jaccard_components(docs, join, id_col, text_col)
    away = found.filter("doc_id > component_id").select(F.col("doc_id").alias("_gone"))
    left = docs.join(away, F.col(id_col) == F.col("_gone"), "left_anti")
    again = found.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select(F.col("doc_id").alias("_again"))
    once = left.filter(F.col(id_col).isNotNull()).join(again, F.col(id_col) == F.col("_again"), "left_anti")
    twice = left.filter(F.col(id_col).isNull()).unionByName(left.join(again, F.col(id_col) == F.col("_again"), "left_semi"))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in utf8_slices(batch, text_col):
                values, first, _ = shingle_sets(texts, join.width)
                sets = [set_id(values[a:b]) if b > a else None for a, b in zip(first, first[1:], strict=False)]
                yield part.append_column("_set", pa.array(sets, pa.int64()))

    known = twice.mapInArrow(describe, StructType([*twice.schema.fields, StructField("_set", LongType())]))
    alike = known.filter("_set IS NOT NULL").dropDuplicates([id_col, "_set"]).unionByName(known.filter("_set IS NULL"))
    return once.unionByName(alike.drop("_set"))
