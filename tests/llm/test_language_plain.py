"""Features, marginals and documents' languages of the query against a plain version, word by word, with the model it learns."""

import math
import re
import zlib
from functools import cache

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import language_crf, queries
from tidemark.llm.textbytes import BASE, VALUES

ALL = (1 << 64) - 1


def mixed(h):
    h = (h ^ h >> 30) * 0xBF58476D1CE4E5B9 & ALL
    h = (h ^ h >> 27) * 0x94D049BB133111EB & ALL
    return h ^ h >> 31


def hashed(kind, data, bits):
    total = sum(int(VALUES[b]) * pow(int(BASE), i, 1 << 64) for i, b in enumerate(data)) + kind * 0x9E3779B97F4A7C15
    return mixed(total & ALL) >> 64 - bits


def core_of(word):
    letter = lambda b: 97 <= b < 123 or b >= 128
    while word and not letter(word[0]):
        word = word[1:]
    while word and not letter(word[-1]):
        word = word[:-1]
    return word


def features(core, bits):
    found = [0]
    if core:
        found.append(hashed(1, core, bits))
        for n in range(1, min(4, len(core)) + 1):
            found += [hashed(1 + n, core[:n], bits), hashed(5 + n, core[len(core) - n :], bits)]
        found += [hashed(10, core[i : i + 3], bits) for i in range(len(core) - 2)]
    return found


def posteriors(scores, turn):
    """Forward-backward of one chain in logarithms."""
    n, k = len(scores), len(turn)
    total = lambda xs: (m := max(xs)) + math.log(sum(math.exp(x - m) for x in xs))
    ahead = [list(scores[0])]
    for t in range(1, n):
        ahead.append([scores[t][j] + total([ahead[-1][i] + turn[i][j] for i in range(k)]) for j in range(k)])
    back = [[0.0] * k]
    for t in range(n - 2, -1, -1):
        back.insert(0, [total([turn[i][j] + scores[t + 1][j] + back[0][j] for j in range(k)]) for i in range(k)])
    whole = total(ahead[-1])
    return [[math.exp(a + b - whole) for a, b in zip(x, y, strict=True)] for x, y in zip(ahead, back, strict=True)]


def plain_language(text, model, crf):
    k, turn = len(model.langs), model.turn.tolist()

    @cache
    def score(core):
        return model.emit[features(core, crf.bits)].astype(float).sum(0).tolist()

    data = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    sums, spoken = [0.0] * k, 0
    for line in data.split(b"\n"):
        cores = [core_of(w) for w in re.findall(rb"[^\x20\x09-\x0D]+", line)]
        if cores:
            for core, own in zip(cores, posteriors([score(c) for c in cores], turn), strict=True):
                if core:
                    spoken += 1
                    sums = [a + b for a, b in zip(sums, own, strict=True)]
    if not spoken or not any(c.isalpha() for c in text):
        return "und", 0.0
    best = max(range(k), key=lambda i: (sums[i], -i))
    return model.langs[best], sums[best] / spoken


def test_query_equals_a_plain_version(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model, crf = language_crf.train(docs.filter(~held)), language_crf.Crf()
    got = {r.doc_id: r for r in queries.op9_language_crf(spark, sf_dir).collect()}
    rows = [r for r in docs.collect() if len(r.text or "") < 20_000]
    assert len(rows) > 150
    for r in rows:
        lang, score = plain_language(r.text, model, crf)
        own = got[r.doc_id]
        assert own.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert own.lang_pred == lang and abs(own.score - score) < 1e-3, (r.doc_id, own, lang, score)


def test_odd_texts_equal_a_plain_version(spark):
    texts = ["the cat is here", "der Hund ist da", "le chien est là", "El Niño, ¿qué?"] * 3
    model = language_crf.fit(texts, ["en", "de", "fr", "es"] * 3, crf := language_crf.Crf(bits=10))
    odd = [None, "", "...", "12 x 34", "the\n\nder\r\nle", "日本 the", " a ", "!Hund! - (ist)", "é", "x" * 500, "the der " * 200, "\x00 b", "ß\tßß"]
    got = language_crf.predict(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string"), model, crf).collect()
    for r in got:
        lang, score = plain_language(odd[r.doc_id], model, crf)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-3, odd[r.doc_id]
    assert np.isfinite([r.score for r in got]).all()
