"""Telephony audio columns: G.711 mu-law and A-law by lookup tables, IMA ADPCM by blocks, resampled PCM.

The media column holds whole RIFF/WAVE files. Mu-law and A-law files keep their payload's bytes as they are, one 8-bit
sample each, so any bytes can be stored without loss.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

A_LAW, MU_LAW, IMA_ADPCM, PCM = 6, 7, 0x11, 1  # WAVE format tags
LIFTED = 0x4C46  # not a registered one: 16-bit PCM packed without loss, see ``lifted``
RATE = 8000


def mu_law_table() -> np.ndarray:
    """16-bit samples of the 256 mu-law codes (G.711): inverted bits of sign, 3-bit segment and 4-bit step; bias 132."""
    code = ~np.arange(256) & 0xFF
    size = ((((code & 0x0F) << 3) + 132) << ((code & 0x70) >> 4)) - 132
    return np.where(code & 0x80, -size, size).astype(np.int16)


def a_law_table() -> np.ndarray:
    """16-bit samples of the 256 A-law codes (G.711): alternate bits inverted, segments 0 and 1 linear."""
    code = np.arange(256) ^ 0x55
    step, segment = ((code & 0x0F) << 4) + 8, (code & 0x70) >> 4
    size = np.where(segment == 0, step, (step + 256) << np.maximum(segment - 1, 0))
    return np.where(code & 0x80, size, -size).astype(np.int16)


def ima_steps() -> np.ndarray:
    """The 89 step sizes of IMA ADPCM, by the rule that made them: each about 1.1 times the last, from 7 to 32767."""
    # The standard's table rounds unevenly, so it is stated.
    return np.array([
        7, 8, 9, 10, 11, 12, 13, 14, 16, 17, 19, 21, 23, 25, 28, 31, 34, 37, 41, 45, 50, 55, 60, 66, 73, 80, 88, 97, 107, 118, 130, 143, 157, 173, 190, 209, 230, 253, 279, 307, 337, 371, 408, 449, 494,
        544, 598, 658, 724, 796, 876, 963, 1060, 1166, 1282, 1411, 1552, 1707, 1878, 2066, 2272, 2499, 2749, 3024, 3327, 3660, 4026, 4428, 4871, 5358, 5894, 6484, 7132, 7845, 8630, 9493, 10442, 11487,
        12635, 13899, 15289, 16818, 18500, 20350, 22385, 24623, 27086, 29794, 32767,
    ])


STEPS, TURNS = ima_steps(), np.array([-1, -1, -1, -1, 2, 4, 6, 8])  # fixed values of IMA ADPCM
MU, A = mu_law_table(), a_law_table()


def decode_adpcm(data: bytes, block: int) -> np.ndarray:
    """IMA ADPCM, mono: a 4-byte head (sample, step index) and 4-bit codes, low half first. Steps through a block once, for all blocks together; a last short block is padded and cut."""
    if block < 5 or not data:
        return np.zeros(0, np.int16)
    n = -(-len(data) // block)
    raw = np.frombuffer(data.ljust(n * block, b"\0"), np.uint8).reshape(n, block)
    value = raw[:, :2].copy().view("<i2")[:, 0].astype(np.int64)
    index = np.minimum(raw[:, 2].astype(np.int64), 88)
    codes = np.stack([raw[:, 4:] & 15, raw[:, 4:] >> 4], axis=2).reshape(n, -1)
    out = np.empty((n, codes.shape[1] + 1), np.int16)
    out[:, 0] = value
    for i in range(codes.shape[1]):
        code, step = codes[:, i].astype(np.int64), STEPS[index]
        change = (step >> 3) + (step >> 2) * (code & 1) + (step >> 1) * (code >> 1 & 1) + step * (code >> 2 & 1)
        value = np.clip(value + np.where(code & 8, -change, change), -32768, 32767)
        index = np.clip(index + TURNS[code & 7], 0, 88)
        out[:, i + 1] = value
    return out.reshape(-1)[: out.size - (n * block - len(data)) * 2]


def neighbours(even: np.ndarray) -> np.ndarray:
    """The mean, rounded down, of each sample and the next one; of the last, itself."""
    return (even.astype(np.int32) + np.append(even[1:], even[-1:])) >> 1


def lifted(x: np.ndarray) -> bytes:
    """All 16-bit samples, by a lifting step: those at even places, then the others less the mean of their neighbours, modulo 2**16. Any sound comes back as it was; of one interpolated to twice its rate the differences are zero, which a codec packs well."""
    even, odd = x[::2], x[1::2]
    return even.astype("<i2").tobytes() + (odd - neighbours(even)[: len(odd)]).astype("<i2").tobytes()


def unlifted(payload: bytes) -> np.ndarray:
    held = np.frombuffer(payload, "<i2")
    even, rest = held[: -(-len(held) // 2)], held[-(-len(held) // 2) :]
    out = np.empty(len(held), np.int16)
    out[::2], out[1::2] = even, (rest + neighbours(even)[: len(rest)]).astype(np.int16)
    return out


def wave(payload: bytes, tag: int = MU_LAW, rate: int = RATE, block: int = 1) -> bytes:
    """A RIFF/WAVE file, mono."""
    bits = {MU_LAW: 8, A_LAW: 8, IMA_ADPCM: 4, PCM: 16, LIFTED: 16}[tag]
    each = {PCM: 2, LIFTED: 2, IMA_ADPCM: block}.get(tag, 1)
    extra = struct.pack("<HH", 2, (block - 4) * 2 + 1) if tag == IMA_ADPCM else b"\0\0"
    form = struct.pack("<HHIIHH", tag, 1, rate, rate * bits // 8, each, bits) + (b"" if tag == PCM else extra)
    body = b"WAVE" + b"fmt " + struct.pack("<I", len(form)) + form + b"data" + struct.pack("<I", len(payload)) + payload + b"\0" * (len(payload) % 2)
    return b"RIFF" + struct.pack("<I", len(body)) + body


def opened(media: bytes) -> tuple[int, int, int, bytes]:
    """Format tag, rate, block size and payload of a RIFF/WAVE file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    at, form = 12, None
    while at + 8 <= len(media):
        name, size = media[at : at + 4], struct.unpack_from("<I", media, at + 4)[0]
        if name == b"fmt ":
            form = struct.unpack_from("<HHIIHH", media, at + 8)
        elif name == b"data" and form:
            return form[0], form[2], form[4], media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("no data chunk")


def samples(media: bytes) -> tuple[int, np.ndarray]:
    """Rate and 16-bit samples of a mu-law, A-law, IMA ADPCM, PCM or lifted PCM file."""
    tag, rate, block, payload = opened(media)
    if tag == IMA_ADPCM:
        return rate, decode_adpcm(payload, block)
    if tag == PCM:
        return rate, np.frombuffer(payload, "<i2")
    if tag == LIFTED:
        return rate, unlifted(payload)
    return rate, {MU_LAW: MU, A_LAW: A}[tag][np.frombuffer(payload, np.uint8)]


def resample(x: np.ndarray, rate: int, to: int) -> np.ndarray:
    """Linear interpolation to another rate, ``len * to // rate`` samples."""
    n = len(x) * to // rate
    if to == 2 * rate and len(x):  # the usual case, without positions
        out = np.empty(n, np.int16)
        out[::2] = x
        out[1:-1:2] = (x[:-1].astype(np.int32) + x[1:]) >> 1
        out[-1] = x[-1]
        return out
    return np.rint(np.interp(np.arange(n) * (rate / to), np.arange(len(x)), x)).astype(np.int16) if n else np.zeros(0, np.int16)


def feature(pcm: np.ndarray) -> str:
    """Level, peak, sign changes and checksum of resampled PCM."""
    if not len(pcm):
        return "0:0:0:0"
    wide = pcm.astype(np.float32)
    level = float(np.sqrt(np.dot(wide.astype(np.float64), wide) / len(pcm)))
    return f"{level:.3f}:{int(np.abs(pcm.astype(np.int32)).max())}:{int(np.count_nonzero((pcm[1:] < 0) != (pcm[:-1] < 0)))}:{zlib.crc32(pcm.tobytes()):08x}"


def to_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: int = 192, tag: int = MU_LAW) -> DataFrame:
    """doc_id, n_bytes (of the text in UTF-8; null: empty) and media: its bytes, padded with spaces to a positive multiple of ``unit``, as a WAVE file.

    Repeated rows and null ids stay; an empty table gives an empty result; other columns are ignored.
    """

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                raw = [(x.as_py() or "").encode() for x in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(x) for x in raw], pa.int64()), pa.array([wave(x.ljust(max(1, -(-len(x) // unit)) * unit, b" "), tag) for x in raw], pa.binary())], names=["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(store, "doc_id long, n_bytes long, media binary")


def describe(media: DataFrame, rate: int = 2 * RATE) -> DataFrame:
    """Digests and features of a media table (doc_id, n_bytes, media): all from the stored bytes. A null media gives nulls."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"

    def one(media: bytes | None, n: int) -> tuple:
        if media is None:
            return (None,) * 6
        payload = opened(media)[3]
        old, x = samples(media)
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), feature(resample(x, old, rate))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes = batch.column("n_bytes").to_pylist()
            rows = [one(m.as_py(), n) for m, n in zip(batch.column("media"), n_bytes, strict=True)]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 6
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_bytes"), *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True))], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(read, schema)


def to_pcm(media: DataFrame, rate: int = 2 * RATE) -> DataFrame:
    """The media column decoded and resampled, as 16-bit PCM WAVE files; the other columns and all rows stay. A null media stays null."""
    at = media.columns.index("media")

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                decoded = (None if m is None else samples(m) for m in part.column("media").to_pylist())
                files = [x and wave(resample(x[1], x[0], rate).astype("<i2").tobytes(), PCM, rate) for x in decoded]
                yield part.set_column(at, "media", pa.array(files, pa.binary()))

    return media.mapInArrow(convert, media.schema)


SOUND = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, pcm binary"


def to_sound(media: DataFrame, rate: int = RATE // 2, tag: int = PCM) -> DataFrame:
    """Digests of a media table (doc_id, n_bytes, media), from the stored bytes, beside its sound: 16-bit PCM at ``rate`` as a WAVE file, plain or lifted by ``tag``.

    A null media gives nulls; repeated rows and null ids stay; an empty table gives an empty result; other columns are ignored.
    """
    names = [x.split()[0] for x in SOUND.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    packed = {PCM: lambda x: x.astype("<i2").tobytes(), LIFTED: lifted}[tag]

    def one(media: bytes | None) -> tuple:
        if media is None:
            return (None,) * 6
        payload = opened(media)[3]
        old, x = samples(media)
        pcm = wave(packed(resample(x, old, rate)), tag, rate)
        return len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(media), hashlib.sha256(media).hexdigest(), pcm

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                columns = zip(*(one(m.as_py()) for m in part.column("media")), strict=True)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names)

    return media.select("doc_id", "n_bytes", "media").mapInArrow(convert, SOUND)


def with_features(sound: DataFrame, rate: int | None = None) -> DataFrame:
    """The sound table with the feature of its stored PCM, resampled to ``rate`` if given, in the place of that. A null PCM gives null."""

    def of(pcm: bytes) -> str:
        old, x = samples(pcm)
        return feature(resample(x, old, rate or old))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [None if x is None else of(x) for x in batch.column("pcm").to_pylist()]
            yield batch.set_column(batch.schema.get_field_index("pcm"), "feature", pa.array(found, pa.string()))

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sound.schema if f.name != "pcm")
    return sound.select(*(c for c in sound.columns if c != "pcm"), "pcm").mapInArrow(read, f"{kept}, feature string")
