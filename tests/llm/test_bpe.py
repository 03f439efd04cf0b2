"""The heap encoder against the tokenizers library, on prose, on hostile texts and through the query."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe, queries

PATH = queries.tokenizer_path("word_bpe_49k.json")
# Characters with odd normal forms, cases, widths or classes, and strings of special tokens.
ODD = "a|b|İ|Σ|ς|é|é|̣́|K|ﬁ|ß|ẞ|Ǆ|日|각|각|😀|½|٣|Ⅷ|ª|'s|'LL|'|1|!!|...|▁|​|﻿|\x00|\x1c|\x1f|\x85|\xa0| | |  |\n|\t|<|<|endoftext|>".split("|")
ODD += ["<|endoftext|>", "<|startoftext|>", "<|"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def both(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


def texts():
    draw = random.Random(5)
    made = ["".join(draw.choices(ODD, k=draw.randint(0, 25))) for _ in range(4000)]
    return [*made, None, "", " ", "The cat sat.", "a" * 3000, "&" * 4000, "ab" * 2000, "Ünïcode " * 5000, "same", "same"]


def test_ids_and_text_equal_the_library(library):
    coder = bpe.Bpe(PATH)
    for text in texts():
        assert (coder.ids(text), coder.text(coder.ids(text))) == both(library, text), repr(text)[:100]


def test_bounded_cache_changes_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "PIECES_KEPT", 3)
    coder = bpe.Bpe(PATH)
    for text in texts()[:500]:
        assert coder.ids(text) == both(library, text)[0]
    assert len(coder) + len(coder.older) < 200


def test_stale_entries_and_equal_ranks():
    """Symbols 0 and 1; merges: (1, 1) to 2 first, then (0, 1) to 3, then (2, 2) to 4."""
    coder = bpe.Bpe.__new__(bpe.Bpe)
    coder.rank, coder.merged = {1 << 32 | 1: 0, 0 << 32 | 1: 1, 2 << 32 | 2: 2}, [2, 3, 4]
    assert coder.merge([1, 1, 1]) == [2, 1]  # of equal ranks the leftmost; the other entry is stale
    assert coder.merge([0, 1, 1]) == [0, 2]
    assert coder.merge([0, 1, 0, 1]) == [3, 3]
    assert coder.merge([1, 1, 1, 1]) == [4]
    assert coder.merge([0]) == [0]


def test_tables(spark, library):
    rows = [(None if i % 7 == 0 else i, x, "kept") for i, x in enumerate(texts())] + [(4, "twice", None), (4, "twice", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, other string")
    out = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert out.columns == ["doc_id", "text", "other", "ids", "decoded"]
    got = sorted(((r.doc_id, r.text, r.other, bytes(r.ids), r.decoded) for r in out.collect()), key=str)
    assert got == sorted(((*r, *both(library, r[1])) for r in rows), key=str)
    assert bpe.encode(docs.limit(0), PATH).count() == 0
    with pytest.raises(ValueError, match="ids"):
        bpe.encode(out, PATH)


def test_unknown_ids_are_left_out():
    coder = bpe.Bpe.get(PATH)
    assert coder.text(np.array([0, 1 << 30, 1], "<u4").tobytes()) == "! \""
    assert coder.text(None) == ""


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="only"):
        bpe.Bpe(queries.tokenizer_path("byte_bpe_50k.json"))


def test_query(spark, sf_dir, library):
    got = {r.doc_id: tuple(r)[1:] for r in queries.op11_bpe_round_trip(spark, sf_dir).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    for doc in docs:
        ids, text = both(library, doc.text)
        assert got[doc.doc_id] == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    assert len(got) == len(docs)
