"""The trie of all prefixes of conversations, by a van Emde Boas recursion over their depth.

A conversation is a sequence of turns; a node is a distinct sequence of its first d turns. Sequences are cut into cells of
64 turns, so that no row grows with a conversation. Inside a cell they are cut at half its height again and again: what
stands before a cut is a prefix, which gets a name (a digest of the name it hangs on and of its turns); the turns above
the cut make the upper trie, those below it a forest whose trees hang on that name, and both are built alike, each with
half the height. Whole cells are the turns of an upper trie of their own, 64 times lower, built by the same function: its
names are those that the cells below hang on. So all trees of one level are built in parallel, and names need no order.

Each node's weight is known once its members are counted. Weights go along the path of the smallest member of a node, cut
as above: the total of what is below a cut is grafted on all that is above it. Where a path branches off a node of another
member, its total is grafted on every node of the prefix that they share; those grafts are summed by name. No step brings
the members of a node, or the children of one, together in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import bound_batches, written
from tidemark.operators.scan import segmented_scan

CELL = 64  # turns in a cell, a power of two
ROOT = bytes(32)  # the name of the empty prefix
CHUNK = 1 << 18  # bytes of ids in a row while the members that end at one node are hashed
Scan = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
WORD = r"[^\x20\x09-\x0D]+"


def turns_of(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows (conv_id, pos from 1, label, words): each conversation's turns in the order of ``turn_col``, null first.

    Null roles and texts are empty; ``label`` is a digest of both. Equal turns of a conversation are ordered by label, so
    repeated rows are turns of their own. Rows without an id belong to no conversation and are left out.
    """
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    label = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(" "), role, text), 256))
    words = F.regexp_count(text, F.lit(WORD)).cast("long")
    rows = conversations.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), label.alias("label"), words.alias("words"))
    return segmented_scan(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("label")], ordinal="pos").select("conv_id", "pos", "label", "words")


def rebuilt(turns: DataFrame, family: int = 20, longest: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns of each conversation c after its head is taken from the first of its family, and all conversations (conv_id).

    The first h turns of c - c % family (all if fewer, none if absent), then c's own after its first h, where h is the
    crc32 of c in decimal, modulo ``longest``. The sign of % is that of SQL.
    """
    turns = written(turns, "turns")
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % longest
    first = F.col("conv_id") - F.col("conv_id") % family
    convs = written(turns.groupBy("conv_id").agg(F.max("pos").alias("own")).select("conv_id", head.alias("head"), first.alias("first"), "own"), "convs")
    heads = turns.filter(F.col("pos") < longest).filter(F.col("conv_id") == first)
    sizes = convs.filter("conv_id = first").select(F.col("conv_id").alias("first"), "own")
    lead = F.least("head", F.coalesce("own", F.lit(0)))
    taken = convs.drop("own").join(heads.withColumnRenamed("conv_id", "first"), "first").filter("pos <= head").select("conv_id", "pos", "label", "words")
    own = turns.select("conv_id", "pos", "label", "words", first.alias("first"), head.alias("head")).filter("pos > head").join(sizes, "first", "left")
    own = own.select("conv_id", (F.col("pos") - F.col("head") + lead).alias("pos"), "label", "words")
    return taken.unionByName(own), convs.select("conv_id")


def digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).digest()


def cut(root: bytes, labels: list[bytes], height: int) -> tuple[list[bytes], bytes | None]:
    """Names of the prefixes of ``labels`` (at most ``height``, a power of two) below ``root``; the digest of them all if they are ``height``."""
    if height == 1:
        return [digest(b"name", root, labels[0])], labels[0]
    half = height // 2
    upper, block = cut(root, labels[:half], half)
    if block is None:
        return upper, None
    upper[-1] = digest(b"name", root, block)
    if len(labels) == half:
        return upper, None
    lower, rest = cut(upper[-1], labels[half:], half)
    return upper + lower, None if rest is None else digest(b"block", block, rest)


def in_cells(rows: DataFrame, height: int, *columns: str) -> DataFrame:
    """Rows (conv_id, pos, ...) as (conv_id, cell, items): at most ``height`` items (pos, ...) in the order of pos."""
    items = F.array_sort(F.collect_list(F.struct("pos", *columns)))
    return rows.groupBy("conv_id", F.floor((F.col("pos") - 1) / height).alias("cell")).agg(items.alias("items"))


def named(rows: DataFrame, height: int, *columns: str) -> DataFrame:
    """Rows (conv_id, pos, label, ...) with ``name``, that of the prefix which ends there, and ``parent``, that of the one before."""
    cells = in_cells(rows, height, "label", *columns)
    kind = cells.schema["items"].dataType.simpleString()
    depth = rows.agg(F.max("pos")).first()[0] or 0
    if depth >= height:
        cells = written(cells, "cells")
        blocks = cells.filter(F.size("items") == height).mapInArrow(block_digests(height), "conv_id long, pos long, label binary")
        upper = written(named(blocks, height).select("conv_id", "pos", "name"), "cuts")
        roots = upper.select("conv_id", F.col("pos").alias("cell"), F.col("name").alias("root"))
        ends = upper.select("conv_id", (F.col("pos") - 1).alias("cell"), F.col("name").alias("end"))
        cells = cells.join(roots, ["conv_id", "cell"], "left").join(ends, ["conv_id", "cell"], "left")
    else:
        cells = cells.withColumns({"root": F.lit(None).cast("binary"), "end": F.lit(None).cast("binary")})
    cells = cells.select("conv_id", "items", F.coalesce("root", F.lit(bytearray(ROOT))).alias("root"), "end")
    chains = cells.mapInArrow(cell_names(height), f"conv_id long, items {kind}, names array<binary>, parents array<binary>")
    row = F.explode(F.arrays_zip("items", "names", "parents")).alias("row")
    kept = [F.col(f"row.items.{c}").alias(c) for c in ("pos", *columns)]
    return chains.select("conv_id", row).select("conv_id", *kept, F.col("row.names").alias("name"), F.col("row.parents").alias("parent"))


def block_digests(height: int) -> Scan:
    """(conv_id, pos, label) of each whole cell, as a turn of the upper trie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = [cut(ROOT, [x["label"] for x in items], height)[1] for items in batch.column("items").to_pylist()]
            pos = pa.array([x + 1 for x in batch.column("cell").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), pos, pa.array(labels, pa.binary())], ["conv_id", "pos", "label"])

    return run


def cell_names(height: int) -> Scan:
    """Cells with the names of their prefixes below ``root``, and each one's parent; that of a whole cell is ``end``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, parents = [], []
            for items, root, end in zip(*(batch.column(c).to_pylist() for c in ("items", "root", "end")), strict=True):
                own = cut(root, [x["label"] for x in items], height)[0]
                if end is not None:
                    own[-1] = end
                names.append(own)
                parents.append([root, *own[:-1]])
            made = [pa.array(x, pa.list_(pa.binary())) for x in (names, parents)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("items"), *made], ["conv_id", "items", "names", "parents"])

    return run


def grafted(paths: DataFrame, height: int) -> DataFrame:
    """Rows (conv_id, pos, name, saved, leaves) with the sums of both from each on to the end of its path."""
    cells = in_cells(paths, height, "name", "saved", "leaves")
    whole = lambda c: F.aggregate("items", F.lit(0).cast("long"), lambda s, x: s + x[c])
    depth = paths.agg(F.max("pos")).first()[0] or 0
    if depth > height:
        cells = written(cells, "paths")
        sums = [whole("saved").alias("saved"), whole("leaves").alias("leaves")]
        upper = cells.select("conv_id", (F.col("cell") + 1).alias("pos"), F.lit(None).cast("binary").alias("name"), *sums)
        below = grafted(upper, height).select("conv_id", (F.col("pos") - 2).alias("cell"), F.col("saved").alias("saved_below"), F.col("leaves").alias("leaves_below"))
        cells = cells.join(below, ["conv_id", "cell"], "left")
    else:
        cells = cells.withColumns({"saved_below": F.lit(None).cast("long"), "leaves_below": F.lit(None).cast("long")})
    one = F.explode("items").alias("x")
    none = F.lit(0).cast("long")
    on = lambda y: y["pos"] >= F.col("x.pos")
    above = lambda c: F.aggregate(F.filter("items", on), F.coalesce(f"{c}_below", none), lambda s, y: s + y[c])
    rows = cells.select("conv_id", "items", "saved_below", "leaves_below", one)
    return rows.select("conv_id", F.col("x.pos").alias("pos"), F.col("x.name").alias("name"), above("saved").alias("saved"), above("leaves").alias("leaves"))


def end_digests(ends: DataFrame, chunk: int) -> DataFrame:
    """Of rows (name, conv_id) for each name the SHA-256 of its decimal ids, ascending, joined by commas.

    Ids are put in order over all tasks and joined to chunks there; one task reads a name's chunks, as the digest demands.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, firsts, texts = [], [], []
        held, size = [], 0
        own: bytes | None = None
        for batch in batches:
            for name, conv in zip(batch.column("name").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if held and (name != own or size > chunk):
                    names.append(own)
                    firsts.append(held[0])
                    texts.append(",".join(map(str, held)))
                    held, size = [], 0
                own = name
                held.append(conv)
                size += 20
            if names:
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(firsts, pa.int64()), pa.array(texts)], ["name", "first", "ids"])
                names, firsts, texts = [], [], []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([own], pa.binary()), pa.array([held[0]], pa.int64()), pa.array([",".join(map(str, held))])], ["name", "first", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state = None, None
        for batch in batches:
            names, out = [], []
            for name, ids in zip(batch.column("name").to_pylist(), batch.column("ids"), strict=True):
                if name == own:
                    state.update(b"," + ids.as_buffer())
                    continue
                if state is not None:
                    names.append(own)
                    out.append(state.hexdigest())
                own, state = name, hashlib.sha256(ids.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(out, pa.string())], ["name", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([own], pa.binary()), pa.array([state.hexdigest()])], ["name", "ends_sha256"])

    ordered = ends.select("name", "conv_id").repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
    pieces = ordered.mapInArrow(chunks, "name binary, first long, ids string")
    return pieces.repartition("name").sortWithinPartitions("name", "first").mapInArrow(hashes, "name binary, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, height: int = CELL, chunk: int = CHUNK) -> DataFrame:
    """A row for each node of the trie of ``turns`` (conv_id, pos from 1 without gaps, label binary, words), the root included.

    ``convs`` has each conversation once, also those without turns. Columns: conv_id (the smallest member), depth,
    parent_conv_id (the parent's conv_id; null for the root), n_convs (members), n_children, n_leaves (childless nodes in
    the subtree, itself included), saved_tokens (over the subtree, each node's (n_convs - 1) times its last turn's words),
    ends_sha256 (of the members that end here). Without conversations there is no row. ``height`` is the turns of a cell, a
    power of two; ``chunk`` bounds the bytes of ids in a row.
    """
    bound_batches(turns.sparkSession)
    rows = written(named(turns, height, "words"), "named")
    convs = convs.select("conv_id")
    root = F.lit(bytearray(ROOT))
    inner = rows.groupBy("name").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.first("parent").alias("parent"), F.first("pos").alias("depth"), F.first("words").alias("words")
    )
    top = convs.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    top = top.select(root.alias("name"), "conv_id", "n_convs", F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("words"))
    nodes = inner.unionByName(top)
    children = inner.groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.join(children, "name", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    saved, leaves = (F.col("n_convs") - 1) * F.col("words"), (F.col("n_children") == 0).cast("long")
    nodes = written(counted.withColumns({"saved": saved, "leaves": leaves}), "nodes")

    below = nodes.filter("depth > 0")
    totals = written(grafted(below.select("conv_id", F.col("depth").alias("pos"), "name", "saved", "leaves"), height), "totals")
    path = F.struct(*(F.col(c) for c in ("pos", "saved", "leaves")))
    branch = totals.groupBy("conv_id").agg(F.min(path).alias("at")).filter("at.pos > 1").select("conv_id", "at")
    grafts = rows.select("conv_id", "pos", "name").join(branch, "conv_id").filter("pos < at.pos").select("name", "at.saved", "at.leaves")
    whole = nodes.agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")).filter("leaves IS NOT NULL").select(root.alias("name"), "saved", "leaves")
    sums = totals.select("name", "saved", "leaves").unionByName(grafts).unionByName(whole).groupBy("name").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))

    last = rows.groupBy("conv_id").agg(F.max_by("name", "pos").alias("name"))
    ends = end_digests(convs.join(last, "conv_id", "left").select(F.coalesce("name", root).alias("name"), "conv_id"), chunk)
    parents = nodes.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.drop("saved", "leaves").join(sums, "name").join(ends, "name", "left").join(parents, "parent", "left")
    none = F.lit(hashlib.sha256().hexdigest())
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))
