"""WARC archives: per-record gzip members, revisit records, and a splittable reader.

Layout: each task writes its own ``part-<partition>-<attempt>-<n>.warc.gz``;
a manifest table names the files of the attempts that succeeded.  A reader task
owns a byte range: it looks for the gzip magic, takes a candidate as a record
only if the member inflates to a WARC header, and decodes every record that
*starts* in its range (the last one may end beyond it)."""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, shared_folder, slices, text_bytes, written

MAGIC = b"\x1f\x8b\x08"
RECORD_ID = "<urn:page:%s>"
CHUNK = 1 << 20


def plan_records(pages: DataFrame, id_col: str, url_col: str, payload_col: str, least: int) -> DataFrame:
    """Rows to write: ``id, url, payload, digest, refers_to``.  Of equal payloads of
    at least ``least`` bytes the largest id is the response; the others refer to it."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                        text_bytes(F.col(payload_col)).alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    first = (rows.where(F.col("size") >= least).groupBy("digest", "size")
             .agg(F.max("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    refers = F.when(F.col("id").eqNullSafe(F.col("first")), F.lit(None)).otherwise(F.col("first"))
    payload = F.when(refers.isNull(), F.col("payload"))      # a revisit carries no payload
    return rows.join(first, ["digest", "size"], "left").select("id", "url", payload.alias("payload"), "digest", "size",
                                                               refers.alias("refers_to"))


def _member(page_id, url, payload, digest, size, refers_to, date, level) -> bytes:
    kind = "response" if refers_to is None else "revisit"
    uri = (url or "").replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http + (payload or b"")
    head = [f"WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {RECORD_ID % page_id}", f"WARC-Date: {date}",
            f"WARC-Target-URI: {uri}", f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: {RECORD_ID % refers_to}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append("Content-Type: application/http; msgtype=response")
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def write_warc(records: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z", level: int = 4,
               roll_bytes: int = 1 << 30) -> DataFrame:
    """Write the planned records; returns the manifest ``path, bytes, records``
    (a written table: only files of successful attempts are in it)."""
    schema = pa.schema([("path", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])

    def write(batches):
        fs, base = pafs.FileSystem.from_uri(folder)
        fs.create_dir(base, recursive=True)
        stem, n, out, size, count = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}", 0, None, 0, 0

        def closed():
            out.close()
            return batch_of(schema, [[f"{folder}/{stem}-{n}.warc.gz"], [size], [count]])

        for batch in slices(batches):
            for row in batch.to_pylist():
                if out is None:
                    out, size, count = fs.open_output_stream(f"{base}/{stem}-{n}.warc.gz", compression=None), 0, 0
                member = _member(row["id"], row["url"], row["payload"], row["digest"], row["size"], row["refers_to"], date, level)
                out.write(member)
                size, count = size + len(member), count + 1
                if size >= roll_bytes:
                    yield closed()
                    out, n = None, n + 1
        if out is not None:
            yield closed()

    return written(records.mapInArrow(write, "path string, bytes long, records long"), "warc-manifest")


class _Window:
    """Forward view of a file from ``start``: bytes are fetched as needed and
    dropped behind the reading point."""

    def __init__(self, handle, start):
        self.handle, self.base, self.data, self.ended = handle, start, b"", False
        handle.seek(start)

    def more(self) -> bool:
        got = b"" if self.ended else self.handle.read(CHUNK)
        self.ended = not got
        self.data += got
        return bool(got)

    def drop(self, to):
        self.data, self.base = self.data[to - self.base:], to

    def find(self, at, end):
        """First place of the magic at or after ``at`` and before ``end``, or None."""
        while at < end:
            i = self.data.find(MAGIC, at - self.base)
            if i >= 0:
                return self.base + i if self.base + i < end else None
            at = max(at, self.base + len(self.data) - len(MAGIC) + 1)
            if at >= end:
                return None
            self.drop(max(self.base, min(at, self.base + len(self.data))))
            if not self.more():
                return None
        return None

    def member(self, at):
        """(bytes, end) of the gzip member at ``at`` if it holds a WARC record, else None."""
        z, parts, done, used, checked = zlib.decompressobj(31), [], 0, at, False
        while not z.eof:
            lo = used - self.base
            piece = self.data[lo:lo + 65536]
            if not piece:
                if not self.more():
                    return None
                continue
            try:
                part = z.decompress(piece)
            except zlib.error:
                return None
            used += len(piece) - len(z.unused_data)
            parts.append(part)
            done += len(part)
            if not checked and (done >= 7 or z.eof):
                if not b"".join(parts).startswith(b"WARC/1."):
                    return None
                checked = True
        return b"".join(parts), used


def parse_record(raw: bytes) -> dict:
    """Fields of one inflated record; the block is checked against its length and digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return {"record_id": fields["WARC-Record-ID"], "record_type": kind, "refers_to": fields.get("WARC-Refers-To"),
            "url": fields["WARC-Target-URI"].replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%"),
            "payload_bytes": size, "payload_digest": digest, "payload": payload if kind == "response" else None}


def scan_range(path: str, start: int, end: int):
    """Records of ``path`` that start in [start, end)."""
    fs, name = pafs.FileSystem.from_uri(path)
    with fs.open_input_file(name) as handle:
        view, at = _Window(handle, start), start
        while (at := view.find(at, end)) is not None:
            view.drop(at)
            hit = view.member(at)
            if hit is None:
                at += 1                    # magic bytes inside compressed data
                continue
            raw, at = hit
            yield parse_record(raw)
            view.drop(min(at, view.base + len(view.data)))


RECORD = pa.schema([("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.string()), ("url", pa.string()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def read_warc(manifest: DataFrame, split_bytes: int = 32 << 20, payload: bool = True) -> DataFrame:
    """Records of the archives in ``manifest`` (``path, bytes``), one task per byte
    range: ``record_id, record_type, refers_to, url, payload_bytes, payload_digest,
    payload`` (null for revisits, or everywhere with ``payload=False``; every
    response is still checked against its digest)."""
    ranges = manifest.where("bytes > 0").select("path", "bytes", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = ranges.select("path", "start", F.least(F.col("start") + split_bytes, F.col("bytes")).alias("end"))

    def scan(batches):
        for batch in batches:
            for r in batch.to_pylist():
                found = []
                for record in scan_range(r["path"], r["start"], r["end"]):
                    if not payload:
                        record["payload"] = None
                    found.append(record)
                    if len(found) >= 64:
                        yield pa.RecordBatch.from_pylist(found, RECORD)
                        found = []
                if found:
                    yield pa.RecordBatch.from_pylist(found, RECORD)

    spread = ranges.repartition(ranges.sparkSession.sparkContext.defaultParallelism * 2)
    return spread.mapInArrow(scan, "record_id string, record_type string, refers_to string, url string, "
                                   "payload_bytes long, payload_digest string, payload binary")


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                  least: int = 1000) -> DataFrame:
    """Write the pages as archives, read them back, one row per page record.

    Null payload: empty.  Null url: empty.  A null id gets the record id
    ``<urn:page:None>`` and comes back as null (as does the text id "None");
    ids come back in the type they had.  Repeated rows of the id that
    is the response are all responses.  An empty table gives no rows."""
    planned = plan_records(pages, id_col, url_col, payload_col, least)
    manifest = write_warc(planned, shared_folder(pages.sparkSession, "warc"))
    kind = pages.schema[id_col].dataType.simpleString()
    known = lambda c: F.regexp_extract(c, "(?s)page:(.*)>$", 1)       # noqa: E731
    same = lambda c: F.when(F.col(c).rlike("page:") & (known(c) != "None"), known(c).try_cast(kind))       # noqa: E731
    return read_warc(manifest, payload=False).select(
        same("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type", same("refers_to").alias("refers_to"))
