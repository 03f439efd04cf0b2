"""Token ids of whole texts with the tokenizers library, through a bounded cache of space-separated pieces.

Both vocabularies split a text before merging, and no part of that split crosses from a non-space to a following space.
So a text's ids are those of its pieces in turn, and a piece seen before needs no second encoding. A piece of Latin
letters is one part for the library's BPE model; any other goes through the whole tokenizer. So do whole texts in which
the string of a special token stands (the library gives that its one id), and white space of several characters.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np

# The characters with the Unicode property White_Space, as in \s of the tokenizers' patterns.
SPACES = "\t-\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPACED = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+")
LETTERS = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,]?)")
AFTER_NEWLINE = re.compile(f"\n[{SPACES}]")
CACHE_PIECES, CACHE_PIECE_CHARS = 600_000, 40  # pieces in each of two generations, together at most some 300 MB a worker


def visible_bytes() -> dict[int, str]:
    """Byte-level BPE writes a byte as its Latin-1 character where that is visible, else as one from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder(dict):
    """``ids(text)``: the text's ids as little-endian unsigned 32-bit integers. As a dict: those of pieces seen lately."""

    _kept: dict[tuple[str, bool], Encoder] = {}

    def __init__(self, path: str, keeps_spaces: bool):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.added = [x.content for x in self.whole.get_added_tokens_decoder().values()]
        self.model = self.whole.model
        self.older: dict[str, bytes] = {}
        self.keeps_spaces = keeps_spaces
        self.shown = visible_bytes()
        self.newline, self.marks = self.encoded("\n"), {x: self.encoded(x) for x in ("", ".", ",")}

    @classmethod
    def get(cls, path: str, keeps_spaces: bool) -> Encoder:
        """One for each worker process, whatever the number of its tasks."""
        if (path, keeps_spaces) not in cls._kept:
            cls._kept[path, keeps_spaces] = cls(path, keeps_spaces)
        return cls._kept[path, keeps_spaces]

    def encoded(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def merged(self, letters: str) -> bytes:
        """Ids of one part of letters (after a space, if any)."""
        if not self.keeps_spaces:
            letters = letters.lower()
        if not letters.isascii() or letters[0] == " ":
            letters = letters.encode().decode("latin-1").translate(self.shown)
        ids = [x.id for x in self.model.tokenize(letters)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def __missing__(self, piece: str) -> bytes:
        """The ids of a piece; where spaces are kept, of it after a space, or of what follows its newline."""
        if (ids := self.older.get(piece)) is not None:
            self[piece] = ids
            return ids
        if found := LETTERS.fullmatch(piece):
            word, mark = found.groups()
            ids = (self.get_seen(word) if mark else None) or self.merged(" " + word if self.keeps_spaces else word)
            ids += self.marks[mark]
        elif not self.keeps_spaces:
            ids = self.encoded(piece)
        elif piece[0] == "\n" and len(piece) > 1:
            found = LETTERS.fullmatch(piece, 1)
            ids = self.newline + (self.merged(found[1]) + self.marks[found[2]] if found else self.encoded(piece[1:]))
        else:
            ids = self.encoded(" " + piece)
        if len(piece) <= CACHE_PIECE_CHARS:
            self[piece] = ids
        return ids

    get_seen = dict.get

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if any(x in text for x in self.added):
            return self.encoded(text)
        if len(self) > CACHE_PIECES:
            self.older = dict(self)
            self.clear()
        if not self.keeps_spaces:
            return b"".join(map(self.__getitem__, filter(None, text.replace("\n", " ").split(" "))))
        pieces = text.replace("\n", " \n").split(" ")
        if "" in pieces or "\n" in pieces or AFTER_NEWLINE.search(text):  # white space of more than one character, or at an end
            return b"".join([self[x[1:]] if x[0] == " " and len(x) > 1 and not x[1:].isspace() else self.encoded(x) for x in SPACED.findall(text)])
        return self.encoded(pieces[0]) + b"".join(map(self.__getitem__, pieces[1:]))
