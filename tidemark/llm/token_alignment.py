"""Alignment of two tokenizers on the same texts: groups of tokens between shared cuts, and how often ids are linked.

A byte offset where tokens of both end is a shared cut. Cuts are found by division: of the ends of A in an interval the
one nearest its middle that bisection finds among the ends of B is a cut; both halves go on alike, without the ends that
are known to be none, so each end is looked up once. An interval without a cut is a leaf: one group.

Neither tokenizer joins a blank or newline to the letter before it. So a text falls into chunks that are tokenised alike
wherever they stand, and a slice of documents needs each of its distinct chunks only once. Tokens overlap within groups
alone, and each stretch between neighbouring ends of either kind is one link. Links are counted by slice, then over the
corpus; each slice gets the counts of its own pairs back, not those of the corpus.
"""

from __future__ import annotations

import hashlib
import os
import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.shared import bound_batches, written
from tidemark.llm.tokens import SPACES, visible_bytes

SLICE_BYTES = 32 << 20  # text in a slice (or one longer text)
BLOCK_CHARS = 1 << 16  # characters that are tokenised at once (or one longer chunk)
ODD = re.compile(f"[{SPACES}][{SPACES}]|(?![ \n])[{SPACES}]|[{SPACES}]\\Z")
PLAIN = re.compile("[ \n][^ \n]+")
BEFORE_CHUNK = re.compile(f"(?<=[^{SPACES}])(?=[ \n][^{SPACES}])")
SLICES = "slice long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, chunks binary, links binary, pairs binary, uses binary"
DIGESTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def shared_cuts(a: list[int], b: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Places i and j of equal ends a[i] = b[j], ascending, by division at the cut nearest the middle. Both lists ascend."""
    at_a, at_b, todo = [], [], [(0, len(a), 0, len(b))]
    while todo:
        low, high, b_low, b_high = todo.pop()
        left = (low + high - 1) // 2
        right = left + 1
        while left >= low or right < high:
            if left >= low:
                j = bisect_left(b, a[left], b_low, b_high)
                if j < b_high and b[j] == a[left]:
                    at_a.append(left)
                    at_b.append(j)
                    if low < left and b_low < j:
                        todo.append((low, left, b_low, j))
                    if right < high and j + 1 < b_high:
                        todo.append((right, high, j + 1, b_high))
                    break
                left -= 1
            if right < high:
                j = bisect_left(b, a[right], b_low, b_high)
                if j < b_high and b[j] == a[right]:
                    at_a.append(right)
                    at_b.append(j)
                    if low <= left and b_low < j:
                        todo.append((low, left + 1, b_low, j))
                    if right + 1 < high and j + 1 < b_high:
                        todo.append((right + 1, high, j + 1, b_high))
                    break
                right += 1
    return np.sort(np.array(at_a, np.int64)), np.sort(np.array(at_b, np.int64))  # both ascend together


class Pair:
    """The two tokenizers, and the bytes that each of their ids stands for."""

    _kept: dict[tuple[str, str], Pair] = {}

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {c: b for b, c in visible_bytes().items()}
        self.a_bytes = {i: bytes(byte_of[c] for c in s) if all(c in byte_of for c in s) else s.encode() for s, i in self.a.get_vocab().items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(s[3:5], 16)]) if self.b.is_byte(i) else s.replace("▁", " ").encode() for i, s in enumerate(pieces)]
        self.a_size = np.array([len(self.a_bytes.get(i, b"")) for i in range(max(self.a_bytes) + 1)])
        self.b_size = np.array([len(x) for x in self.b_bytes])
        self.shown = [f"{i}{mark}" for i in range(max(len(self.a_size), len(self.b_size))) for mark in ",|;"]
        if any("\n" in s or "▁" in s.lstrip("▁") for i, s in enumerate(pieces) if not self.b.is_byte(i)):
            raise ValueError("only pieces without newlines, and with blanks at their beginning alone")

    @classmethod
    def get(cls, a_path: str, b_path: str) -> Pair:
        if (a_path, b_path) not in cls._kept:
            cls._kept[a_path, b_path] = cls(a_path, b_path)
        return cls._kept[a_path, b_path]

    def tokens(self, text: str) -> tuple[list[int], list[int]] | None:
        """Ids of both for a text that begins with a blank; None where their bytes aren't those of the text."""
        a, b, data = self.a.encode(text, add_special_tokens=False).ids, self.b.encode(text[1:]), text.encode()
        same = b"".join(map(self.a_bytes.__getitem__, a)) == data and b"".join(map(self.b_bytes.__getitem__, b)) == data
        return (a, b) if same else None


def chunks_of(text: str) -> list[str]:
    """A text, with the blank that both tokenizers see before it, cut before each single blank or newline between other characters."""
    text = " " + text
    return BEFORE_CHUNK.split(text) if ODD.search(text) else PLAIN.findall(text)


class Slice(dict):
    """Distinct chunks of some documents, numbered as they come; ``documents`` are their ids and chunk numbers (None: no text)."""

    def __init__(self, pair: Pair):
        super().__init__()
        self.pair, self.size = pair, 0
        self.documents: list[tuple[int | None, np.ndarray | None]] = []

    def __missing__(self, chunk: str) -> int:
        self[chunk] = number = len(self)
        return number

    def add(self, doc: int | None, text: str | None) -> None:
        self.size += len(text or "") + 64
        self.documents.append((doc, np.fromiter(map(self.__getitem__, chunks_of(text)), np.uint32) if text else None))

    def blocks(self) -> Iterator[tuple[int, list[str]]]:
        """The first number and the chunks of runs to tokenise at once; a chunk that ends in white space is the last of its run."""
        first, run, size = 0, [], 0
        for i, chunk in enumerate(self):
            run.append(chunk)
            size += len(chunk)
            if size > BLOCK_CHARS or chunk[-1].isspace():
                yield first, run
                first, run, size = i + 1, [], 0
        if run:
            yield first, run

    def align(self) -> None:
        """Fills the tables of chunks: counts of tokens, groups and links, groups as text, links as pairs of ids; ``bad`` ones have none."""
        n = len(self)
        self.counts = np.zeros((4, n), np.int64)  # of A's tokens, B's, groups, links
        self.text, self.bad, pairs = [""] * n, np.zeros(n, bool), []
        for first, run in self.blocks():
            for start, part in self.readable(first, run):
                pairs.append(self.align_run(start, part))
        self.links = np.concatenate([*pairs, np.zeros(0, np.int64)])

    def readable(self, first: int, run: list[str]) -> Iterator[tuple[int, tuple]]:
        """Runs with their tokens: whole, or chunk by chunk where one of them has other bytes than its text."""
        ids = self.pair.tokens(" a" + "".join(run))
        if ids:
            yield first, (run, *ids)
        elif len(run) > 1:
            for i, chunk in enumerate(run):
                yield from self.readable(first + i, [chunk])
        else:
            self.bad[first] = True

    def align_run(self, first: int, part: tuple) -> np.ndarray:
        run, a, b = part
        ids = np.array(a), np.array(b)
        ends_a, ends_b = np.cumsum(self.pair.a_size[ids[0]]), np.cumsum(self.pair.b_size[ids[1]])
        cuts = shared_cuts(ends_a.tolist(), ends_b.tolist())
        ends = np.cumsum([2, *(len(x.encode()) for x in run)])
        stretch = np.union1d(ends_a, ends_b)
        own = slice(first, first + len(run))
        for row, x in zip(self.counts, (ends_a, ends_b, ends_a[cuts[0]], stretch), strict=True):
            row[own] = np.diff(np.searchsorted(x, ends, "right"))
        group = [np.searchsorted(cut, np.arange(len(x))) for cut, x in zip(cuts, ids, strict=True)]
        mark = [np.zeros(len(x), np.int64) for x in ids]
        mark[0][cuts[0]], mark[1][cuts[1]] = 1, 2  # what follows a token: a comma, the bar after A's, the semicolon after a group
        order = np.argsort(np.concatenate(group), kind="stable")
        words = [*map(self.pair.shown.__getitem__, np.concatenate([x * 3 + m for x, m in zip(ids, mark, strict=True)])[order].tolist())]
        at = (np.searchsorted(ends_a, ends, "right") + np.searchsorted(ends_b, ends, "right")).tolist()
        self.text[own] = ["".join(words[x:y])[:-1] for x, y in zip(at, at[1:], strict=False)]
        stretch = stretch[np.searchsorted(stretch, 2, "right") :]
        return ids[0][np.searchsorted(ends_a, stretch)] << 32 | ids[1][np.searchsorted(ends_b, stretch)]

    def rows(self, number: int) -> Iterator[dict]:
        """A row for each document, then one with the slice's own tables: links of each chunk, distinct pairs and their uses."""
        self.align()
        uses = np.zeros(len(self), np.int64)
        blank = dict.fromkeys(("links", "pairs", "uses"))
        for doc, chunks in self.documents:
            if chunks is None or self.bad[chunks].any():
                yield {"slice": number, "doc_id": doc, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "chunks": b"", **blank}
                continue
            sums = self.counts[:, chunks].sum(1).tolist()
            digest = hashlib.sha256(";".join(map(self.text.__getitem__, chunks.tolist())).encode()).hexdigest()
            uses += np.bincount(chunks, minlength=len(self))
            yield {"slice": number, "doc_id": doc, **dict(zip(("n_a", "n_b", "n_groups", "n_links"), sums, strict=True)), "groups_sha256": digest, "chunks": chunks.tobytes(), **blank}
        pairs, which = np.unique(self.links, return_inverse=True)
        weights = np.bincount(which, np.repeat(uses, self.counts[3]), len(pairs)).astype(np.int64)
        tables = {"chunks": self.counts[3].astype("<u4").tobytes(), "links": which.astype("<u4").tobytes(), "pairs": pairs.tobytes(), "uses": weights.tobytes()}
        yield {"slice": number, **dict.fromkeys(("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")), **tables}


def slices(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Documents aligned, slice by slice: rows of documents, and for each slice one with its pairs (``pairs`` isn't null)."""
    bound_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pair, number = Pair.get(a_path, b_path), TaskContext.get().partitionId() << 32
        schema, own = None, Slice(pair)

        def out() -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for row in own.rows(number):
                held.append(row)
                size += len(row["chunks"]) + len(row["links"] or b"")
                if size > 4 << 20:
                    yield pa.RecordBatch.from_pylist(held, schema)
                    held, size = [], 0
            yield pa.RecordBatch.from_pylist(held, schema)

        kinds = {"doc_id": pa.int64(), "groups_sha256": pa.string()} | dict.fromkeys(("chunks", "links", "pairs", "uses"), pa.binary())
        schema = pa.schema([(x.split()[0], kinds.get(x.split()[0], pa.int64())) for x in SLICES.split(", ")])
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own.add(doc, text.as_py())
                if own.size > slice_bytes:
                    yield from out()
                    own, number = Slice(pair), number + 1
        if own.documents:
            yield from out()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, SLICES)


def pair_uses(made: DataFrame) -> DataFrame:
    """Rows (slice, place, pair, uses): the distinct pairs of each slice, and how many links of its documents hold them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                pairs, uses = (np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in ("pairs", "uses"))
                for at in range(0, len(pairs), 65536):
                    part = slice(at, at + 65536)
                    place = np.arange(at, at + len(pairs[part]))
                    own = np.full(len(place), batch.column("slice")[i].as_py())
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (own, place, pairs[part], uses[part])], ["slice", "place", "pair", "uses"])

    return made.filter("pairs IS NOT NULL").select("slice", "pairs", "uses").mapInArrow(run, "slice long, place long, pair long, uses long").filter("uses > 0")


def pair_counts(uses: DataFrame) -> DataFrame:
    """Rows (pair, n, best): links of the whole corpus that hold the pair (A's id << 32 | B's), and whether no pair of that B has more.

    The highest counts are a row for each id of B, so the vocabulary bounds what is broadcast.
    """
    counts = uses.groupBy("pair").agg(F.sum("uses").alias("n"))
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    highest = counts.groupBy(b_id.alias("b")).agg(F.max("n").alias("highest"))
    return counts.join(F.broadcast(highest), b_id == F.col("b")).select("pair", "n", (F.col("n") == F.col("highest")).alias("best"))


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """A row for each document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` counts the links whose id pair is the corpus's most frequent (ties included) for its id of B; ``count_sum``
    sums the corpus's counts over the links. A text that is null or empty, or that either tokenizer's bytes don't give
    back, has zeros and an empty digest. Repeated and null ids keep a row each; other columns are ignored; an empty table
    stays empty.
    """
    made = written(slices(docs, a_path, b_path, id_col, text_col, slice_bytes), "slices")
    uses = written(pair_uses(made), "pairs")
    counts = uses.select("slice", "place", "pair").join(pair_counts(uses), "pair").select("slice", "place", "n", "best")

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        own = left.filter(left.column("pairs").is_valid()).to_pylist()[0]
        links, of_chunk = np.frombuffer(own["links"], "<u4"), np.frombuffer(own["chunks"], "<u4").astype(np.int64)
        values = np.zeros((2, len(own["pairs"]) // 8), np.int64)
        place = right.column("place").to_numpy()
        values[0, place], values[1, place] = right.column("n").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        at = np.concatenate([[0], np.cumsum(of_chunk)])
        totals = np.concatenate([np.zeros((2, 1), np.int64), values[:, links].cumsum(1)], 1)
        by_chunk = totals[:, at[1:]] - totals[:, at[:-1]]
        docs = left.filter(left.column("pairs").is_null())
        sums = [by_chunk[:, np.frombuffer(x.as_buffer(), "<u4")].sum(1).tolist() for x in docs.column("chunks")]
        out = {c: docs.column(c) for c in docs.column_names} | {"count_sum": pa.array([x[0] for x in sums], pa.int64()), "n_best": pa.array([x[1] for x in sums], pa.int64())}
        return pa.table({x.split()[0]: out[x.split()[0]] for x in DIGESTS.split(", ")})

    return made.drop("uses").groupBy("slice").cogroup(counts.groupBy("slice")).applyInArrow(summed, DIGESTS)
