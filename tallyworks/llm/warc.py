"""WARC archives: written by Spark tasks, read back by a sequential reader.

One gzip member per record.  The reader takes an archive in pieces, decompresses one member
at a time, frames the block by its Content-Length and checks block and payload digests; it
never holds more than one record and one piece.  Archives lie in the folder the session
shares; a manifest lists those that finished tasks wrote, so that a task run again leaves
nothing behind that is read.

Defined results: null html is an empty payload; null url leaves out the target; control
characters in a url are percent-encoded; null page_id is kept as null; of rows repeated
under the largest page_id of equal payloads all are responses; an empty table gives no
archives and no rows.  Only page_id, url and html are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.sources.shared import new_folder, settle

PIECE = 1 << 20
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"
MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64())])
RECORDS = pa.schema([
    ("page_id", pa.int64()), ("uri", pa.string()), ("record_type", pa.string()),
    ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
    ("payload", pa.binary())])


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path)
                                  if ":" in path else f"file://{path}")


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def encode_record(page_id: int | None, url: str | None, payload: bytes,
                  original: int | None, date: str, level: int = 6) -> bytes:
    """A response, or a revisit where ``original`` names the page that holds the payload."""
    block = HTTP.format(len(payload)).encode()
    digest = _sha1(payload)
    name = "" if page_id is None else page_id
    head = ["WARC/1.1", f"WARC-Type: {'response' if original is None else 'revisit'}",
            f"WARC-Record-ID: <{RECORD_ID}{name}>", f"WARC-Date: {date}",
            "Content-Type: application/http; msgtype=response"]
    if url is not None:
        safe = re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)
        head.append(f"WARC-Target-URI: {safe}")
    if original is None:
        block += payload
    else:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{RECORD_ID}{original}>"]
    head += [f"WARC-Payload-Digest: {digest}", f"WARC-Block-Digest: {_sha1(block)}",
             f"Content-Length: {len(block)}"]
    record = "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(record) + packer.flush()


def members(stream) -> Iterator[bytes]:
    """The gzip members of a stream, each whole, one after the other."""
    piece, unpacker, record = stream.read(PIECE), zlib.decompressobj(31), bytearray()
    while piece:
        record += unpacker.decompress(piece)
        if unpacker.eof:
            yield bytes(record)
            piece, unpacker, record = unpacker.unused_data, zlib.decompressobj(31), bytearray()
            if not piece:
                piece = stream.read(PIECE)
        else:
            piece = stream.read(PIECE)
            if not piece:
                raise ValueError("archive ends inside a record")


def parse_record(record: bytes) -> dict:
    """Headers by lower-case name, HTTP block and payload of one record, digests checked."""
    head, found, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not found or not version.startswith("WARC/1."):
        raise ValueError("not a WARC record")
    headers = {name.strip().lower(): value.strip()
               for name, _, value in (line.partition(":") for line in lines)}
    length = int(headers["content-length"])
    block = rest[:length]
    if len(block) != length or rest[length:] != b"\r\n\r\n":
        raise ValueError("block does not fit its Content-Length")
    if headers.get("warc-block-digest", _sha1(block)) != _sha1(block):
        raise ValueError("block digest differs")
    http, _, payload = block.partition(b"\r\n\r\n")
    if headers["warc-type"] == "response" and headers.get(
            "warc-payload-digest", _sha1(payload)) != _sha1(payload):
        raise ValueError("payload digest differs")
    size = re.search(rb"(?im)^content-length:\s*(\d+)", http)
    return headers | {"payload": payload, "payload-bytes": int(size[1]) if size else len(payload)}


def _page(reference: str | None) -> int | None:
    number = (reference or "").strip("<>").removeprefix(RECORD_ID)
    return int(number) if number else None


def _writer(folder: str, date: str, most_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = file_system(folder)
        out, path, size, records = None, "", 0, 0
        for batch in batches:
            columns = [batch[n] for n in ("page_id", "url", "payload", "original")]
            for page_id, url, payload, original in zip(*columns):
                if out is None:
                    path, size, records = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{root}/{path}")
                size += out.write(encode_record(page_id.as_py(), url.as_py(), payload.as_py(),
                                                original.as_py(), date))
                records += 1
                if size >= most_bytes:
                    out.close()
                    out = None
                    yield pa.RecordBatch.from_pylist(
                        [{"path": f"{folder}/{path}", "records": records}], MANIFEST)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist(
                [{"path": f"{folder}/{path}", "records": records}], MANIFEST)
    return write


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for batch in batches:
        for path in batch["path"].to_pylist():
            store, place = file_system(path)
            with store.open_input_stream(place) as stream:
                for record in map(parse_record, members(stream)):
                    digest = record["warc-payload-digest"].removeprefix("sha1:")
                    rows.append({
                        "page_id": _page(record["warc-record-id"]),
                        "uri": record.get("warc-target-uri"),
                        "record_type": record["warc-type"],
                        "refers_to": _page(record.get("warc-refers-to")),
                        "payload_bytes": record["payload-bytes"],
                        "payload_digest": base64.b32decode(digest).hex(),
                        "payload": record["payload"]})
                    size += len(record["payload"])
                    if size > 8 * PIECE or len(rows) == 1000:
                        yield pa.RecordBatch.from_pylist(rows, RECORDS)
                        rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, RECORDS)


def write_warc(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z",
               least_bytes: int = 1000, most_bytes: int = 1 << 30) -> DataFrame:
    """Write a record per page below ``folder``; the manifest of archives (path, records).

    Of records with equal payloads of ``least_bytes`` or more, the largest page_id holds the
    payload and the others revisit it.  An archive closes at ``most_bytes``.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"),
                        F.sha1(payload).alias("_digest"),
                        F.octet_length(payload).alias("_bytes"))
    large = rows.filter(F.col("_bytes") >= least_bytes)
    originals = settle(
        large.groupBy("_digest").agg(F.max("page_id").alias("_last"),
                                     F.count(F.lit(1)).alias("_copies"))
        .filter("_copies > 1").select(F.col("_digest").alias("_same"), "_last"), "warc-originals")
    known = (F.col("_digest") == F.col("_same")) & (F.col("_bytes") >= least_bytes)
    revisited = F.when(~F.col("page_id").eqNullSafe(F.col("_last")), F.col("_last"))
    return settle(
        rows.join(originals, known, "left")
        .select("page_id", "url", "payload", revisited.alias("original"))
        .mapInArrow(_writer(folder, date, most_bytes), "path string, records long"),
        "warc-manifest")


def read_warc(manifest: DataFrame) -> DataFrame:
    """Every record of the archives the manifest lists, an archive a task."""
    archives = max(1, manifest.count())
    return manifest.repartition(archives).mapInArrow(
        _read, "page_id long, uri string, record_type string, refers_to long, "
        "payload_bytes long, payload_digest string, payload binary")


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """The pages through archives in the shared folder and back."""
    return read_warc(write_warc(pages, new_folder(spark, "warc")))
