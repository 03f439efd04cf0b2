"""Token files, archives, packing and media: exact round trips and brute force."""

import base64
import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import packing, telephony, token_files, warc
from tidemark.llm.shared import fresh_dir, written
from tidemark.llm.tokens import Encoder

TEXTS = ["", "plain words here", "a  b\n\nc \t d'll  ", "\x1c x \x85y 　z é é ́a", "  ", "don't STOP '  's ẞİ ΑΣ Σ", "<|endoftext|> 12 345 a1b2", "한국어 日本語　テスト", "Ünd, die. Straße,\nNeue Zeile. x\t", "\n", "a\n", " a", "no.,. end,\n\n\nmore", "word " * 3000]


@pytest.mark.parametrize(("file", "spaces"), [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_encoder_equals_the_library(file, spaces):
    whole = Tokenizer.from_file(public_tokenizers.path(file))
    own = Encoder(public_tokenizers.path(file), spaces)
    rng = random.Random(0)
    mixed = ["".join(rng.choice(["ab", " ", "\n", ".", ",", "é", "ẞ", "'s", "7", "\t", "　", "日", "\x1f", "́", "\xa0", "\xa0", "\r", "\x85", "<|endoftext|>", "<|startoftext|>"]) for _ in range(rng.randrange(30))) for _ in range(4000)]
    for text in TEXTS + mixed:
        assert np.frombuffer(own.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_token_files_round_trip(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    form = token_files.TokenFormat(path, False, 1, 49_408, shard_ids=20)
    docs = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(5, None), (None, "x"), (7, "twice"), (7, "twice")]
    random.Random(1).shuffle(docs)
    df = spark.createDataFrame([(i, t, "p", 0) for i, t in docs], "doc_id long, text string, path string, start int").repartition(3)
    shards = written(token_files.write_shards(df, fresh_dir(spark, "tokens"), form), "shards")
    assert shards.count() > 1
    rows = token_files.read_documents(spark, token_files.with_bases(shards), form, with_ids=True).orderBy("start").collect()
    whole = Tokenizer.from_file(path)
    want = {(-1 if i is None else i): [*whole.encode(t or "", add_special_tokens=False).ids, 1] for i, t in docs}
    assert [r.doc_id for r in rows] == sorted(-1 if i is None else i for i, _ in docs)
    at = 0
    for r in rows:
        assert (r.ids, r.start, r.n_tokens) == (want[r.doc_id], at, len(want[r.doc_id]))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    empty = spark.createDataFrame([], "doc_id long, text string")
    none = written(token_files.write_shards(empty, fresh_dir(spark, "tokens"), form), "shards")
    assert token_files.read_documents(spark, token_files.with_bases(none), form).count() == 0


@pytest.mark.parametrize("split", [97, 1000, 1 << 20])
def test_archives_round_trip(spark, split):
    rng = random.Random(2)
    noise = "".join(chr(rng.choice([0x1F, 0x8B, 8, 0x1C, 65])) for _ in range(3000))
    bodies = ["<p>one</p>", "", None, noise, "<p>one</p>", "é" * 10_000, "<p>one</p>", "WARC/1.1\r\n\r\n\x1f\x8b\x08" * 50]
    pages = [(i, f"http://h/{i}", b) for i, b in enumerate(bodies)] + [(None, None, "<p>one</p>")]
    df = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, refers_to string, bytes int").repartition(2)
    archives = written(warc.write_archives(warc.with_revisits(df, "page_id", "html"), fresh_dir(spark, "warc"), archive_bytes=4000), "archives")
    got = {r.record_id: r for r in warc.read_archives(spark, archives, split_bytes=split).collect()}
    assert len(got) == len(pages)
    first = {}
    for i, _, body in pages:
        raw = (body or "").encode()
        r = got["null" if i is None else str(i)]
        assert r.payload_digest == base64.b32encode(hashlib.sha1(raw).digest()).decode()
        assert r.payload_bytes == len(raw)
        if i is None or first.setdefault(raw, i) == i:
            assert (r.record_type, r.refers_to, bytes(r.payload)) == ("response", None, raw)
        else:
            assert (r.record_type, r.refers_to, r.payload) == ("revisit", str(first[raw]), None)


def test_one_id_with_different_payloads(spark):
    df = spark.createDataFrame([(1, "seen before"), (2, "seen before"), (2, "something else"), (2, "seen before"), (None, "x")], "page_id long, html string")
    got = warc.with_revisits(df, "page_id", "html").collect()
    assert sorted(((r.page_id, r.html, r.refers_to) for r in got), key=str) == sorted([(1, "seen before", None), (2, "seen before", 1), (2, "seen before", 1), (2, "something else", None), (None, "x", None)], key=str)


def test_short_payloads_and_empty_table(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "ab"), (3, "longer"), (4, "longer")], "page_id long, html string")
    assert {r.page_id: r.refers_to for r in warc.with_revisits(df, "page_id", "html", least_bytes=3).collect()} == {1: None, 2: None, 3: None, 4: 3}
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    archives = written(warc.write_archives(warc.with_revisits(empty, "page_id", "html"), fresh_dir(spark, "warc")), "archives")
    assert warc.read_archives(spark, archives).count() == 0


def best_fit_decreasing(lengths, capacity):
    free = []
    for n in sorted(lengths, reverse=True):
        fit = [f for f in free if f >= n]
        if fit:
            free.remove(min(fit))
            free.append(min(fit) - n)
        else:
            free.append(capacity - n)
    return len(free)


@pytest.mark.parametrize(("n", "high"), [(0, 1), (1, 64), (50, 64), (400, 64), (700, 20), (300, 3)])
def test_plan_is_whole_and_tight(n, high):
    lengths = np.random.default_rng(n).integers(1, high + 1, n).tolist()
    runs = packing.plan(dict(Counter(lengths)), 64, groups=32)
    held = Counter()
    for times, inside in runs:
        assert sum(inside) <= 64
        for x in inside:
            held[x] += times
    assert +held == Counter(lengths)
    assert sum(t for t, _ in runs) <= best_fit_decreasing(lengths, 64)


@pytest.mark.parametrize(("low", "high"), [(256, 600), (150, 260), (1, 1024), (300, 400)])
def test_grouping_against_best_fit(low, high):
    lengths = np.random.default_rng(low).integers(low, high + 1, 5000).tolist()
    runs = packing.grouped(dict(Counter(lengths)), 1024, 64, 1 / 8)
    held = Counter()
    for times, inside in runs:
        assert sum(inside) <= 1024
        for x in inside:
            held[x] += times
    assert held == Counter(lengths)
    assert len({n for _, inside in runs for n in inside}) > 64
    if high < 1024:
        assert sum(t for t, _ in runs) < best_fit_decreasing(lengths, 1024)


def test_plan_of_even_lengths():
    lengths = np.random.default_rng(0).integers(1, 1025, 5000).tolist()
    assert sum(t for t, _ in packing.plan(dict(Counter(lengths)), 1024)) <= 1.001 * best_fit_decreasing(lengths, 1024) + 1


def test_configurations_hold_no_more_than_asked():
    sizes, demand = np.array([600, 424, 350, 330]), np.array([100, 100, 90, 60])
    found = packing.configurations(sizes, demand, 1024)
    assert all(c @ sizes <= 1024 for c, _ in found)
    assert (sum(c * n for c, n in found) <= demand).all()
    assert 156 <= sum(n for _, n in found) <= 160  # 100 pairs, 30 triples and 30 pairs hold all

def test_packing(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = [*TEXTS, None, *(f"word{i} " * (i % 90) for i in range(300)), "hot", *["hot"] * 200]
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in enumerate(texts)], "doc_id long, text string, length int, offset string").repartition(3)
    pieces = packing.pieces_of(df, path, 2, 64)
    rows = packing.pack(pieces, 64).collect()
    whole = Tokenizer.from_file(path)
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for i, t in enumerate(texts):
        ids, own = [*whole.encode(t or "", add_special_tokens=False).ids, 2], sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert sum(r.length for r in own) == len(ids)
        assert all(r.length == 64 for r in own[1:])
        assert len(own) == -(-len(ids) // 64)
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    for own in by_sequence.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert len(by_sequence) <= 1.02 * best_fit_decreasing([r.length for r in rows], 64) + 1
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.pieces_of(empty, path, 2, 64), 64).count() == 0


def mu_law(code):
    code = ~code & 0xFF
    size = (((code & 15) * 2 + 33) << (code >> 4 & 7)) - 33
    return (-size if code & 128 else size) * 4


def test_tables_by_the_standard():
    assert telephony.MU.tolist() == [mu_law(c) for c in range(256)]
    assert [int(telephony.A[c]) for c in (0xD5, 0x55, 0xAA, 0x2A)] == [8, -8, 32256, -32256]
    assert len(telephony.STEPS) == 89
    ratio = telephony.STEPS[40:] / telephony.STEPS[39:-1]
    assert (abs(ratio - 1.1) < 0.003).all()


def adpcm(data, block):
    out = []
    for at in range(0, len(data), block):
        part = data[at : at + block].ljust(block, b"\0")
        value, index = int.from_bytes(part[:2], "little", signed=True), min(part[2], 88)
        own = [value]
        for byte in part[4:]:
            for code in (byte & 15, byte >> 4):
                step = int(telephony.STEPS[index])
                change = (step >> 3) + (step if code & 4 else 0) + (step >> 1 if code & 2 else 0) + (step >> 2 if code & 1 else 0)
                value = max(-32768, min(32767, value + (-change if code & 8 else change)))
                index = max(0, min(88, index + int(telephony.TURNS[code & 7])))
                own.append(value)
        out += own[: len(own) - 2 * (block - len(data[at : at + block]))]
    return out


@pytest.mark.parametrize("n", [0, 36, 5 * 36, 5 * 36 + 17])
def test_adpcm_blocks(n):
    data = np.random.default_rng(n).integers(0, 256, n, dtype=np.uint8).tobytes()
    assert telephony.decode_adpcm(data, 36).tolist() == adpcm(data, 36)
    rate, x = telephony.samples(telephony.wave(data, telephony.IMA_ADPCM, 8000, 36))
    assert (rate, len(x)) == (8000, len(adpcm(data, 36)))


def test_media(spark):
    texts = ["", None, "abc", "abc", "é" * 96, "x" * 193, "long " * 100_000]
    df = spark.createDataFrame([(i, t, b"m") for i, t in enumerate(texts)], "doc_id long, text string, media binary")
    media = written(telephony.to_media(df), "media")
    got = {r.doc_id: r for r in telephony.describe(media).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw.ljust(max(1, -(-len(raw) // 192)) * 192, b" ")
        r = got[i]
        assert (r.n_bytes, r.payload_bytes) == (len(raw), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest()
        assert r.tail_crc32 == zlib.crc32(payload[-16:])
        assert (r.media_bytes, r.media_sha256) == (len(telephony.wave(payload)), hashlib.sha256(telephony.wave(payload)).hexdigest())
        x = [mu_law(b) for b in payload]
        wide = [v for a, b in zip(x, x[1:] + x[-1:]) for v in (a, (a + b) >> 1)]  # linear, the last sample held
        level = np.sqrt(sum(v * v for v in wide) / len(wide))
        shown = r.feature.split(":")
        assert abs(float(shown[0]) - level) <= 0.002 + 1e-6 * level
        assert shown[1:] == [str(max(map(abs, wide))), str(sum((a < 0) != (b < 0) for a, b in zip(wide, wide[1:]))), f"{zlib.crc32(np.array(wide, '<i2').tobytes()):08x}"]
    assert got[2].feature == got[3].feature != got[4].feature
    pcm = {r.doc_id: bytes(r.media) for r in telephony.to_pcm(media).collect()}
    rate, x = telephony.samples(pcm[5])
    assert (rate, len(x)) == (16_000, 2 * 384)
    assert x[0] == telephony.MU[ord("x")]
    assert telephony.describe(telephony.to_media(df.limit(0))).count() == 0
    assert telephony.describe(media.select("doc_id", "n_bytes", F.lit(None).cast("binary").alias("media"))).first().media_sha256 is None


def test_resampling_follows_a_line():
    x = np.array([0, 100, 200, 300], np.int16)
    assert telephony.resample(x, 8000, 16000).tolist() == [0, 50, 100, 150, 200, 250, 300, 300]
    assert telephony.resample(x, 8000, 4000).tolist() == [0, 200]
    assert len(telephony.resample(x[:0], 8000, 16000)) == 0


def test_sound_is_stored_and_read_back(spark):
    texts = [(1, "one two three"), (1, "one two three"), (2, None), (None, "ünï " * 3000), (3, "x" * 192), (4, "")]
    media = written(telephony.to_media(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)), "media", "zstd")
    sound = written(telephony.to_sound(media), "sound", "zstd")
    for r in sound.collect():
        rate, x = telephony.samples(bytes(r.pcm))
        assert rate == 4000 and len(x) == r.payload_bytes // 2
    plain = {}
    for i, t in texts:
        payload = (t or "").encode()
        payload = payload.ljust(max(1, -(-len(payload) // 192)) * 192, b" ")
        x = np.array([mu_law(c) for c in payload[::2]], np.int16)  # half the rate: every second sample
        level = math.sqrt(sum(int(v) ** 2 for v in x) / len(x))
        changes = sum((a < 0) != (b < 0) for a, b in zip(x, x[1:], strict=False))
        plain[i] = (hashlib.sha256(payload).hexdigest(), f"{level:.3f}:{max(abs(int(v)) for v in x)}:{changes}:{zlib.crc32(x.astype('<i2').tobytes()):08x}")
    found = telephony.with_features(sound).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.payload_sha256, r.feature.split(":")[1:]) == (plain[r.doc_id][0], plain[r.doc_id][1].split(":")[1:])
        assert abs(float(r.feature.split(":")[0]) - float(plain[r.doc_id][1].split(":")[0])) < 0.01
    same = {c: [x[c] for x in telephony.describe(media).orderBy("doc_id").collect()] for c in ("payload_sha256", "media_sha256", "tail_crc32", "media_bytes")}
    assert same == {c: [x[c] for x in sound.orderBy("doc_id").collect()] for c in same}
    null = media.limit(1).withColumn("media", F.lit(None).cast("binary"))
    assert telephony.with_features(telephony.to_sound(null)).first().feature is None
    assert telephony.with_features(telephony.to_sound(media.limit(0))).count() == 0


def test_every_stored_sample_tells_in_the_feature(spark, tmp_path):
    """The query's sound has all samples: texts that differ in one byte, at an odd place too, have different features, and those are of PCM at 16 kHz."""
    from tidemark.llm import queries

    texts = [(1, "one two three"), (2, "oXe two three"), (3, "onX two three"), (4, None), (5, "ünï " * 3000)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r.feature for r in queries.op6_telephony_media(spark, str(tmp_path)).collect()}
    want = {r.doc_id: r.feature for r in telephony.describe(telephony.to_media(spark.createDataFrame(texts, "doc_id long, text string"))).collect()}
    assert found == want and len(set(found.values())) == 5


@pytest.mark.parametrize("n", [0, 1, 2, 7, 1000])
def test_lifted_sound_comes_back_whole(n):
    """Any samples, extremes too; the differences of a sound interpolated to twice its rate are zero."""
    x = np.random.default_rng(n).choice(np.array([-32768, -1, 0, 1, 5000, 32767], np.int16), n)
    rate, back = telephony.samples(telephony.wave(telephony.lifted(x), telephony.LIFTED, 16_000))
    assert rate == 16_000 and back.tolist() == x.tolist()
    twice = telephony.resample(x, 8000, 16_000)
    assert telephony.lifted(twice) == x.astype("<i2").tobytes() + bytes(2 * n)


def test_the_query_stores_the_resampled_sound(spark, tmp_path, monkeypatch):
    """What op6 stores and reads back is PCM at 16 kHz, every sample of it, and the feature is of that."""
    from tidemark.llm import queries

    texts, stored = [(1, "one two three"), (2, None), (3, "ünï " * 3000)], {}
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(queries, "written", lambda df, label, *more: stored.setdefault(label, written(df, label, *more)))
    feature = {r.doc_id: r.feature for r in queries.op6_telephony_media(spark, str(tmp_path)).collect()}
    media = {r.doc_id: bytes(r.media) for r in stored["media"].collect()}
    for r in stored["sound"].collect():
        rate, x = telephony.samples(bytes(r.pcm))
        assert (rate, len(x)) == (16_000, 2 * r.payload_bytes)
        assert x.tolist() == telephony.resample(telephony.samples(media[r.doc_id])[1], 8000, 16_000).tolist()
        assert feature[r.doc_id] == telephony.feature(x)
