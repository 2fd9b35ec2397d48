"""Operator 4: WARC archives, written a gzip member a record, and a splittable reader.

Writing: each task writes one archive to the shared folder under a name of its own attempt; the table
of archives that comes back names only those of attempts that succeeded, so what a lost executor or a
second attempt leaves behind is never read.

Reading: archives are dealt out as byte ranges. A task looks for gzip magic from the start of its range,
takes a candidate only if what follows inflates to WARC headers, and owns the records that start inside
its range, reading beyond its end to finish the last one. Where a record has to begin, behind another or at the start
of an archive, and none can be read, whether broken or cut short, that is an error, or on request a row of type
``damaged`` with its place; what can be read behind it is.

Of records with equal payloads of at least ``least`` bytes, the one with the smallest id is a response
and holds the payload; others are revisits of it, with the payload's digest and length in their headers.

Defined cases: a null payload is empty; rows that share the smallest id are all responses; a null id is
kept as no id and never the one referred to, and a group without any other has responses only; a null
url is the empty string; empty tables give no archive.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_folder, written

SPLIT = 8 << 20  # bytes of archive a reading task gets
MAGIC = b"\x1f\x8b\x08"
HEAD = 1 << 16  # bytes that show whether a record begins
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ = "page_id bigint, url string, record_type string, refers_to bigint, payload_bytes bigint, payload_digest string, payload binary, archive string, at bigint"


def store(uri: str):
    """The file system of a folder's URI and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(kind: str, page: int | None, url: str, payload: bytes, digest: str, size: int, refers: int | None) -> bytes:
    """One record as a gzip member. A revisit's block has the HTTP headers alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload if kind == "response" else b"")
    name = f"<urn:page:{page}>" if page is not None else f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, digest)}>"
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {name}", "WARC-Date: 2000-01-01T00:00:00Z", f"WARC-Target-URI: {clean(url)}", f"WARC-Payload-Digest: sha1:{digest}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{refers}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    squeeze = zlib.compressobj(1, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n") + squeeze.flush()


def clean(url: str) -> str:
    """A header value holds no line ends; they and the percent sign are escaped."""
    return url.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def unclean(value: str) -> str:
    return value.replace("%0D", "\r").replace("%0A", "\n").replace("%25", "%")


def write(df: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(archive, size): the archives written, a row each."""
    spark = df.sparkSession
    rows = df.select(F.col(id_col).cast("bigint").alias("page"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.encode(F.col(payload_col).cast("string"), "UTF-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    # One row for each payload that occurs again; counted before the shuffle. Whether it is broadcast,
    # Spark decides by its size.
    again = rows.where(F.octet_length("payload") >= least).groupBy("sha").agg(F.min("page").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").select("sha", "first")
    rows = rows.join(again, "sha", "left").withColumn("refers", F.when(F.col("page").isNull() | (F.col("page") != F.col("first")), F.col("first")))
    rows = rows.select("page", "url", F.when(F.col("refers").isNull(), F.col("payload")).alias("payload"), F.octet_length("payload").cast("bigint").alias("size"), "sha", "refers")
    folder = fresh_folder(spark, "warc")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, place, size = None, "", 0
        for b in parts:
            for x in b.to_pylist():
                digest = base64.b32encode(bytes.fromhex(x["sha"])).decode()
                data = record("response" if x["refers"] is None else "revisit", x["page"], x["url"] or "", x["payload"] or b"", digest, x["size"], x["refers"])
                if out is None:
                    files, path = store(folder)
                    files.create_dir(path, recursive=True)
                    place = f"part-{uuid.uuid4().hex}.warc.gz"
                    out = files.open_output_stream(f"{path}/{place}", compression=None)
                out.write(data)
                size += len(data)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{place}"]), pa.array([size], pa.int64())], ["archive", "size"])

    # written: the archives of one run, whoever reads the table how often
    return written(rows.mapInArrow(run, "archive string, size bigint"), "archives")


class Window:
    """Bytes of a file from a place on, read ahead in blocks."""

    BLOCK = 1 << 18

    def __init__(self, file, at: int):
        self.file, self.base, self.data = file, at, bytearray()
        file.seek(at)

    def more(self) -> bool:
        block = self.file.read(self.BLOCK)
        self.data += block
        return bool(block)

    def drop(self, at: int) -> None:
        del self.data[: at - self.base]
        self.base = at

    def head(self, at: int) -> bytes:
        return bytes(self.data[at - self.base : at - self.base + HEAD])

    def begins_record(self, at: int) -> bool:
        """Whether a record begins at a place, as far as its headers tell."""
        told = is_record(self.head(at))
        while told is None and self.more():
            told = is_record(self.head(at))
        return bool(told)


def header_of(data: bytes) -> dict[str, str] | None:
    """The WARC headers at the start of inflated data, if it begins with them and has them whole."""
    if not data.startswith(b"WARC/1.") or (end := data.find(b"\r\n\r\n")) < 0:
        return None
    try:
        lines = data[:end].decode().split("\r\n")[1:]
        found = dict(x.split(": ", 1) for x in lines)
    except (UnicodeDecodeError, ValueError):
        return None
    return found | {"": str(end + 4)} if {"WARC-Type", "WARC-Record-ID", "Content-Length"} <= found.keys() and found["Content-Length"].isdigit() else None


def is_record(data: bytes) -> bool | None:
    """Whether a gzip member that begins here inflates to WARC headers; None if it takes more bytes to tell."""
    inflate = zlib.decompressobj(31)
    try:
        head = inflate.decompress(data[:HEAD], HEAD)
    except zlib.error:
        return False
    if header_of(head):
        return True
    starts = head[:7] == b"WARC/1."[: len(head)]
    return None if starts and not inflate.eof and len(head) < HEAD and len(data) < HEAD else False


def records(file, start: int, end: int) -> Iterator[tuple[int, dict[str, str] | None, bytes]]:
    """(offset, headers, block) of the records that start in [start, end); null headers where one should and can't be read.
    Whether a record begins behind the last one, even beyond the end, is told by the task that read that one."""
    w, at, sure = Window(file, start), start, start == 0
    while at < end:
        if not sure:  # look for a member, byte by byte of magic
            found = w.data.find(MAGIC, at - w.base)
            if found < 0:
                at = max(at, w.base + len(w.data) - len(MAGIC) + 1)
                w.drop(min(at, w.base + len(w.data)))
                if not w.more():
                    return
                continue
            at = w.base + found
            if at >= end:
                return
            if not w.begins_record(at):
                at += 1
                continue
            sure = True
        w.drop(at)
        inflate, out, used = zlib.decompressobj(31), [], 0
        try:
            while not inflate.eof:
                if used >= len(w.data) and not w.more():
                    break
                block = bytes(w.data[used:])
                out.append(inflate.decompress(block))
                used += len(block) - len(inflate.unused_data)
        except zlib.error:
            out = []
        data = b"".join(out)
        head = header_of(data) if inflate.eof else None
        if head is None:
            if not w.data:
                return
            yield at, None, b""
            at, sure = at + 1, False
            continue
        body = int(head[""])
        yield at, head, data[body : body + int(head["Content-Length"])]
        at += used
    if sure:
        w.drop(at)
        if (w.data or w.more()) and not w.begins_record(at):
            yield at, None, b""


def page_of(value: str | None) -> int | None:
    return int(value[10:-1]) if value and value.startswith("<urn:page:") else None


def read(archives: DataFrame, split: int = SPLIT, payloads: bool = True, report: bool = False) -> DataFrame:
    """A row for each record of the archives, in columns ``READ``; without payloads they are checked, but
    don't come along. The payload of a revisit is null; its
    digest and length are the full payload's all the same. report: what can't be read is a row of type damaged, not an error."""
    ranges = archives.select("archive", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(split).cast("bigint"))).alias("start"))
    ranges = ranges.select("archive", "start", F.least("size", F.col("start") + split).alias("end"))
    ranges = ranges.repartition(max(1, archives.sparkSession.sparkContext.defaultParallelism * 4), "archive", "start")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("archive", pa.string()), ("at", pa.int64())])
        for b in parts:
            for x in b.to_pylist():
                files, path = store(x["archive"])
                rows, held = [], 0
                with files.open_input_file(path) as f:
                    for at, head, block in records(f, x["start"], x["end"]):
                        if head is None:
                            if not report:
                                raise ValueError(f"{x['archive']} at {at}: no record can be read")
                            rows.append((None, None, "damaged", None, None, None, None, x["archive"], at))
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        size = next((int(v) for k, v in (y.split(": ", 1) for y in http.decode("latin-1").split("\r\n")[1:]) if k == "Content-Length"), len(payload))
                        digest = head.get("WARC-Payload-Digest", "").removeprefix("sha1:")
                        if head["WARC-Type"] == "response" and (size, digest) != (len(payload), digest32(payload)):
                            raise ValueError(f"{x['archive']} at {at}: the payload doesn't have its digest or length")
                        rows.append((page_of(head["WARC-Record-ID"]), unclean(head.get("WARC-Target-URI", "")), head["WARC-Type"], page_of(head.get("WARC-Refers-To")), size, digest, payload if payloads and head["WARC-Type"] == "response" else None, x["archive"], at))
                        held += len(payload)
                        if held > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    return ranges.mapInArrow(run, READ)
