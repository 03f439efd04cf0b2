"""BPE encoding and decoding of whole texts: a priority queue of merge ranks over a doubly linked list of symbols.

The vocabulary file is a tokenizer's JSON: normalisers, a pattern that cuts a text into parts, byte-level symbols and the
ranked merges. Of each part, every pair of neighbours that can merge is an entry (rank, place) of a heap. The least entry
is taken; if its pair is no longer there it is stale and skipped, else the right symbol is unlinked, the left one becomes
the merged symbol, and its two new pairs are pushed: O(n log n) for a part of n symbols, whatever its length.

No part crosses a blank, so the ids of a text are those of its blank-separated pieces in turn. Pieces seen lately are kept
in two bounded generations of a cache. Decoding writes the vocabulary strings one after the other, with the separator
that the file's decoder asks for.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, DataType, StringType, StructField, StructType

from tidemark.llm.shared import bound_batches, utf8_slices
from tidemark.llm.tokens import SPACES, visible_bytes

PIECES_KEPT, PIECE_CHARS = 600_000, 40  # pieces in each of the two generations, together some 300 MB a worker at most


def lower(text: str) -> str:
    """Lower case character by character; str.lower alone would write a sigma at a word's end in its final form."""
    return text.replace("Σ", "σ").lower()


class Bpe(dict):
    """``ids(text)`` and ``text(ids)`` of one vocabulary file. As a dict: the ids of pieces seen lately."""

    _kept: dict[str, Bpe] = {}

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut, level = spec["model"], *self.parts_of(spec["pre_tokenizer"])
        if model["type"] != "BPE" or model.get("dropout") or model.get("unk_token") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or level.get("add_prefix_space"):
            raise ValueError("only byte-level BPE without dropout, unknown token, subword prefix, byte fallback or prefix space")
        if spec["post_processor"] or spec["decoder"]:
            raise ValueError("only files without post-processor and decoder")
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] or x["normalized"] for x in spec["added_tokens"]):
            raise ValueError("only added tokens that stand for themselves")
        self.steps = [self.normaliser(x) for x in self.listed(spec["normalizer"], "normalizers")]
        self.cut = regex.compile(cut["pattern"]["Regex"].replace(r"\s", SPACES))
        vocabulary: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.shown = visible_bytes()
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.added_pattern = regex.compile("|".join(map(regex.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self.inner = {c: vocabulary[c] for c in self.shown.values()}
        self.last = {c: vocabulary[c + self.suffix] for c in self.shown.values()}
        pairs = [x.split(" ") if isinstance(x, str) else x for x in model["merges"]]
        self.rank = {vocabulary[a] << 32 | vocabulary[b]: i for i, (a, b) in enumerate(pairs)}
        self.merged = [vocabulary[a + b] for a, b in pairs]
        self.strings = {i: s for s, i in (vocabulary | self.added).items()}
        self.older: dict[str, bytes] = {}

    @classmethod
    def get(cls, path: str) -> Bpe:
        """One for each worker process, whatever the number of its tasks."""
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    @staticmethod
    def listed(spec: dict | None, key: str) -> list[dict]:
        return [] if spec is None else spec[key] if spec["type"] == "Sequence" else [spec]

    @classmethod
    def parts_of(cls, spec: dict) -> list[dict]:
        steps = cls.listed(spec, "pretokenizers")
        if [x["type"] for x in steps] != ["Split", "ByteLevel"] or steps[0]["behavior"] != "Removed" or not steps[0]["invert"] or steps[1]["use_regex"]:
            raise ValueError("only a pattern whose matches are the parts, then bytes as symbols")
        return steps

    @staticmethod
    def normaliser(spec: dict) -> Callable[[str], str]:
        if spec["type"] == "NFC":
            return lambda x: unicodedata.normalize("NFC", x)
        if spec["type"] == "Lowercase":
            return lower
        if spec["type"] == "Replace" and "Regex" in spec["pattern"]:
            pattern, content = regex.compile(spec["pattern"]["Regex"].replace(r"\s", f"[{SPACES}]")), spec["content"]
            return lambda x: pattern.sub(lambda _: content, x)
        raise ValueError(f"unknown normaliser {spec['type']}")

    def merge(self, symbols: list[int]) -> list[int]:
        """The symbols after all merges: of the pairs present always the one of least rank, of equal ones the leftmost."""
        n, rank, merged = len(symbols), self.rank.get, self.merged
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [r << 32 | i for i, (a, b) in enumerate(zip(symbols, symbols[1:], strict=False)) if (r := rank(a << 32 | b)) is not None]
        heapify(queue)
        while queue:
            least = heappop(queue)
            i = least & 0xFFFFFFFF
            j = after[i]
            if j == n or symbols[i] < 0 or rank(symbols[i] << 32 | symbols[j]) != least >> 32:
                continue  # stale: one of the pair has merged with another since
            own = symbols[i] = merged[least >> 32]
            symbols[j] = -1
            after[i] = j = after[j]
            if j < n:
                before[j] = i
                if (r := rank(own << 32 | symbols[j])) is not None:
                    heappush(queue, r << 32 | i)
            j = before[i]
            if j >= 0 and (r := rank(symbols[j] << 32 | own)) is not None:
                heappush(queue, r << 32 | j)
        return [x for x in symbols if x >= 0]

    def part(self, part: str) -> bytes:
        """Ids of one part of a normalised text."""
        shown = part if part.isascii() and part.isprintable() else part.encode().decode("latin-1").translate(self.shown)
        symbols = [*map(self.inner.__getitem__, shown)]
        symbols[-1] = self.last[shown[-1]]
        ids = self.merge(symbols) if len(symbols) > 1 else symbols
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            text = piece
            for step in self.steps:
                text = step(text)
            seen, older = dict.get, self.older.get
            ids = b"".join([(seen(self, x) or older(x) if x != piece else None) or self.part(x) for x in self.cut.findall(text)])
        if len(piece) <= PIECE_CHARS:
            self[piece] = ids
        return ids

    def plain(self, text: str) -> bytes:
        if len(self) > PIECES_KEPT:
            self.older = dict(self)
            self.clear()
        return b"".join(map(self.__getitem__, filter(None, text.replace("\n", " ").split(" "))))

    def ids(self, text: str | None) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers; the string of an added token is its one id."""
        if not text:
            return b""
        if self.added_pattern is None or not any(x in text for x in self.added):
            return self.plain(text)
        out, at = [], 0
        for found in self.added_pattern.finditer(text):
            out += [self.plain(text[at : found.start()]), struct.pack("<I", self.added[found[0]])]
            at = found.end()
        return b"".join([*out, self.plain(text[at:])])

    def text(self, ids: bytes | None) -> str:
        """The vocabulary strings of the ids, joined as by a file without decoder: with one blank between. Unknown ids are left out."""
        numbers = np.frombuffer(ids or b"", "<u4").tolist()
        try:
            return " ".join(map(self.strings.__getitem__, numbers))
        except KeyError:
            return " ".join(self.strings[x] for x in numbers if x in self.strings)


def mapped(df: DataFrame, column: str, name: str, kind: DataType, each: Callable[[pa.RecordBatch, pa.LargeBinaryArray], pa.Array]) -> DataFrame:
    """``df`` with one more column, which ``each`` makes of slices of bounded size. A column of that name is an error."""
    if name in df.columns:
        raise ValueError(f"there is a column {name} already")
    bound_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, values in utf8_slices(batch, column):
                yield pa.RecordBatch.from_arrays([*part.columns, each(part, values)], [*part.schema.names, name])

    return df.mapInArrow(run, StructType([*df.schema, StructField(name, kind)]))


def encode(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``ids_col``: each whole text's ids as little-endian unsigned 32-bit integers (binary).

    A null or empty text has no ids (empty binary). Repeated rows and all other columns stay; an empty table stays empty.
    """
    return mapped(docs, text_col, ids_col, BinaryType(), lambda part, _: pa.array(map(Bpe.get(path).ids, part.column(text_col).to_pylist()), pa.binary()))


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``df`` with ``text_col``: the text of ``ids_col`` (empty where that is null or empty). Ids outside the vocabulary are left out."""
    return mapped(df, ids_col, text_col, StringType(), lambda _, ids: pa.array((Bpe.get(path).text(x.as_py()) for x in ids), pa.string()))
