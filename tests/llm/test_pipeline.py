"""Each stage of the pipeline against a plain version of its own input, stage after stage."""

import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import mixing
from tidemark.llm.queries import PII_KEY, tokenizer_path
from tidemark.llm.shared import written


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}


def representatives(docs):
    """Smallest ids of the components of links at a similarity of 0.8."""
    sets = [(i, shingles(t)) for i, t in sorted(docs.items())]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, s) in enumerate(sets):
        for j, t in sets[:k]:
            if s and t and 0.8 * max(len(s), len(t)) <= min(len(s), len(t)) and 100 * len(s & t) >= 80 * len(s | t):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i for i in parent if root(i) == i}


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """The tables between the stages, the input first."""
    odd = [(900_001, None, "en", "src0", 0), (900_002, "", None, None, 0), (900_003, "12 34 !", "en", None, 7), (900_004, "the and of reading", None, None, 18)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [written(docs.unionByName(spark.createDataFrame(odd, docs.schema)), "in")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], sf_dir), "stage"))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near copies", "personal data", "source mix", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
    assert all(df.columns == stages[0].columns for df in stages[:-1])


def test_language(stages):
    before, after = texts(stages[0]), texts(stages[1])
    assert after == {i: t for i, t in before.items() if t and any(c.isalpha() for c in t)}


def test_near_copies(stages):
    before, after = texts(stages[1]), texts(stages[2])
    assert after == {i: before[i] for i in representatives(before)}
    assert len(after) < len(before)


def luhn(value):
    digits = [int(c) for c in reversed(value) if c.isdigit()]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0


def test_personal_data(stages):
    before, after = texts(stages[2]), texts(stages[3])
    found = re.compile(r"[\w.+-]+@[\w.-]+\.\w+|(?<!\d)\d{16}(?!\d)|(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d)|\(\d{3}\) \d{3}-\d{4}")
    assert set(after) == set(before)
    assert sum(len(found.findall(t)) for t in before.values()) > 5
    for i, t in before.items():
        values = found.findall(t)
        numbers = [v for v in values if re.fullmatch(r"\d{16}", v)]
        assert not [v for v in values if v not in numbers and v in after[i]]
        assert all((v in after[i]) != luhn(v) for v in numbers)
        if not values and not re.search(r"\d", t):
            assert after[i] == t
        assert len(found.findall(after[i])) == len(values)


def test_source_mix(stages):
    rows = [(r.doc_id, r.text, r.source) for r in stages[3].collect()]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    rel = con.sql(mixing.report_sql())
    taken = {r[rel.columns.index("doc_id")]: r[rel.columns.index("taken")] for r in rel.fetchall()}
    after = texts(stages[4])
    assert {i: len(re.findall(mixing.WORD, t)) for i, t in after.items()} == {i: n for i, n in taken.items() if n}
    before = texts(stages[3])
    assert all(set(t.split()) <= set(before[i].split()) for i, t in after.items())
    assert {r.doc_id: r.n_chars for r in stages[4].collect()} == {i: len(t) for i, t in after.items()}


def test_packing(stages):
    whole = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want = {i: [*whole.encode(t, add_special_tokens=False).ids, 2] for i, t in texts(stages[4]).items()}
    got: dict = {}
    filled: dict = {}
    for r in stages[5].collect():
        got.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(got) == set(want)
    for i, ids in want.items():
        at = 0
        for k, (piece, start, length, crc) in enumerate(sorted(got[i])):
            assert (piece, start) == (k, at)
            assert crc == zlib.crc32(np.array(ids[at : at + length], "<u4").tobytes())
            at += length
        assert at == len(ids)
    for places in filled.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(filled) <= 1.03 * sum(map(len, want.values())) / 1024 + 2


def test_pseudonyms_are_linked_across_documents(spark):
    docs = spark.createDataFrame([(1, "from 10.1.2.3 end", "en", "a", 1), (2, "x 10.1.2.3", "en", "a", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    a, b = (r.text.split()[1] for r in corpus_pipeline.without_personal_data(spark, docs, "").orderBy("doc_id").collect())
    assert a == b != "10.1.2.3"
    assert PII_KEY
    assert docs.filter(F.col("doc_id") > 5).count() == 0
