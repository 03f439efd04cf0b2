"""WARC archives: a writer with one gzip member per record, and a splittable reader.

The reader's tasks take byte ranges. A task looks for the gzip magic in its range, accepts a candidate only if decoding
it yields a WARC header, and owns every record that starts inside; it reads past its end only to finish its last record.
A false candidate inside compressed data thus costs one failed decode and no record.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.shared import open_fs, publish

MAGIC = b"\x1f\x8b\x08"
ARCHIVES = "path string, bytes long"
RECORDS = "record_id string, record_type string, uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
BLOCK = 1 << 18
MOST_TASKS = 1 << 16  # beyond it a task reads several splits, one after the other


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def with_revisits(pages: DataFrame, id_col: str, payload_col: str, least_bytes: int = 0) -> DataFrame:
    """Adds refers_to: for a payload of at least ``least_bytes`` that a row with a smaller id has too, the smallest such id; else null.

    A null payload counts as empty. Rows with a null id are never referred to nor revisits. Payloads equal in SHA-256 and
    length count as equal. Rows with one id and different payloads are told apart; repeated rows all stay, the first among them
    responses. Neither join gathers a payload, and the rows of one hot digest meet a single row, so adaptive execution
    splits them. Columns "_id", "_sha" and "_len" are not allowed; a column refers_to is replaced.
    """
    sha, length = F.sha2(F.coalesce(payload_col, F.lit("")).cast("binary"), 256), F.octet_length(F.coalesce(payload_col, F.lit("")))
    keys = pages.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), sha.alias("_sha"), length.alias("_len"))
    firsts = keys.filter(F.col("_len") >= least_bytes).groupBy("_sha", "_len").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    again = keys.join(firsts, ["_sha", "_len"]).filter("_id > _first").select("_id", "_sha", "_len", F.col("_first").alias("refers_to")).distinct()
    same = (F.col(id_col) == F.col("_id")) & (sha == F.col("_sha")) & (length == F.col("_len"))
    return pages.drop("refers_to").join(again, same, "left").drop("_id", "_sha", "_len")


def record(rid: str, payload: bytes, uri: str | None, refers_to: str | None) -> bytes:
    """One record as a gzip member. A revisit has the headers and no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n" + f"Content-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <urn:page:{rid}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    head += [f"WARC-Target-URI: {' '.join(uri.split())}"] if uri else []
    head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if refers_to is not None else []
    head += [f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    pack = zlib.compressobj(3, zlib.DEFLATED, 31)
    return pack.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + pack.flush()


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", payload_col: str = "html", uri_col: str = "url", archive_bytes: int = 64 << 20) -> DataFrame:
    """Writes a record per row (see ``with_revisits`` for refers_to) and returns one row per archive. An empty table gives none. Other columns are ignored.

    An archive's name has its partition, part and task attempt, so that an attempt never replaces the records of another.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, attempt, cut, held, size = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            path = f"{folder}/part-{part:06d}-{cut:04d}-{attempt}.warc.gz"
            publish(path, b"".join(held))
            return pa.RecordBatch.from_pydict({"path": [path], "bytes": [size]})

        for batch in batches:
            for rid, payload, uri, refers_to in zip(*(batch.column(c) for c in ("id", "payload", "uri", "refers_to")), strict=True):
                rid, refers_to = rid.as_py(), refers_to.as_py()
                held.append(record("null" if rid is None else str(rid), (payload.as_py() or "").encode(), uri.as_py(), None if refers_to is None else str(refers_to)))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield flush()
                    cut, held, size = cut + 1, [], 0
        if held:
            yield flush()

    return pages.select(F.col(id_col).alias("id"), F.col(payload_col).alias("payload"), F.col(uri_col).alias("uri"), "refers_to").mapInArrow(write, ARCHIVES)


class Range:
    """Bytes of a file from ``start`` on, read in blocks as they are needed."""

    def __init__(self, uri: str, start: int):
        system, path = open_fs(uri)
        self.file, self.at, self.data = system.open_input_file(path), start, b""
        self.size = self.file.size()

    def more(self) -> bool:
        have = self.at + len(self.data)
        if have >= self.size:
            return False
        self.file.seek(have)
        self.data += self.file.read(min(BLOCK, self.size - have))
        return True

    def skip(self, to: int) -> None:
        self.data = self.data[to - self.at :]
        self.at = to


def member(view: Range) -> tuple[bytes, int] | None:
    """The decoded member at the start of the view and its compressed length, or None if it is no WARC record."""
    unpack, out, used, seen = zlib.decompressobj(31), [], 0, 0
    while not unpack.eof:
        if used >= len(view.data) and not view.more():
            return None
        try:
            out.append(unpack.decompress(view.data[used:]))
        except zlib.error:
            return None
        used = len(view.data)
        seen += len(out[-1])
        if seen >= 5 and not (out := [b"".join(out)])[0].startswith(b"WARC/"):
            return None
    whole = b"".join(out)
    return (whole, used - len(unpack.unused_data)) if whole.startswith(b"WARC/") else None


def records_in(uri: str, start: int, end: int) -> Iterator[bytes]:
    """The records that start in ``start:end``."""
    view = Range(uri, start)
    with view.file:
        while view.at < end:
            if len(view.data) < len(MAGIC) and not view.more() and len(view.data) < len(MAGIC):
                return
            found = view.data.find(MAGIC)
            if found < 0:
                view.skip(view.at + max(1, len(view.data) - len(MAGIC) + 1))
                continue
            view.skip(view.at + found)
            if view.at >= end:
                return
            if got := member(view):
                yield got[0]
                view.skip(view.at + got[1])
            else:
                view.skip(view.at + 1)


def parsed(data: bytes) -> dict:
    head, _, body = data.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("utf-8", "replace").split("\r\n")[1:])}
    block = body[: int(fields.get("content-length", 0))]
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit = fields.get("warc-type") == "revisit"
    length = next((int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), len(payload))
    bare = lambda k: fields[k].removeprefix("<urn:page:").removesuffix(">") if k in fields else None
    return {"record_id": bare("warc-record-id"), "record_type": fields.get("warc-type"), "uri": fields.get("warc-target-uri"), "refers_to": bare("warc-refers-to"), "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") if revisit else digest(payload), "payload_bytes": length if revisit else len(payload), "payload": None if revisit else payload}


def read_archives(spark: SparkSession, archives: DataFrame, split_bytes: int = 8 << 20, payloads: bool = True) -> DataFrame:
    """One row per record of the archives. A response's digest and length are taken from the payload read, a revisit's from its headers. Repeated ids stay."""
    splits = archives.select("path", "bytes", F.explode(F.sequence(F.lit(0), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split_bytes))).alias("start"))
    splits = splits.repartition(max(1, min(splits.count(), MOST_TASKS))).select("path", "start", (F.col("start") + split_bytes).alias("end"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record_id", "record_type", "uri", "refers_to", "payload_digest", "payload_bytes"] + ["payload"] * payloads
        kinds = [pa.string()] * 5 + [pa.int64()] + [pa.binary()] * payloads
        for batch in batches:
            for row in batch.to_pylist():
                held: list[dict] = []
                size = 0
                for data in records_in(row["path"], row["start"], row["end"]):
                    held.append(parsed(data))
                    size += len(data)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in held], t) for n, t in zip(names, kinds, strict=True)], names=names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array([x[n] for x in held], t) for n, t in zip(names, kinds, strict=True)], names=names)

    return splits.mapInArrow(read, RECORDS if payloads else RECORDS.removesuffix(", payload binary"))
