"""Archives: round trips, and readers that refuse what is broken."""

from __future__ import annotations

import gzip
import hashlib
import io
import re

import pytest
from tallyworks.llm.warc import (archive_pages, encode_record, members, parse_record, read_warc,
                                 write_warc)

SCHEMA = "page_id long, url string, html string"


def test_every_member_is_a_gzip_file_of_its_own():
    records = [encode_record(i, f"http://e/{i}", b"x" * i * 1000, None, "1970-01-01T00:00:00Z")
               for i in range(5)]
    assert [gzip.decompress(r) for r in records] == list(members(io.BytesIO(b"".join(records))))
    plain = gzip.decompress(records[2])
    assert plain.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and plain.endswith(b"\r\n\r\n")
    assert parse_record(plain)["payload"] == b"x" * 2000


def test_broken_archives_are_refused():
    record = encode_record(1, "u", b"payload", None, "1970-01-01T00:00:00Z")
    plain = gzip.decompress(record)
    with pytest.raises(ValueError):
        list(members(io.BytesIO(record[:-9])))
    for broken in (plain.replace(b"payload", b"pAyload"), plain[:-1], plain[1:],
                   re.sub(rb"Content-Length: \d+(?=\r\n\r\nHTTP)", b"Content-Length: 8", plain)):
        with pytest.raises(ValueError):
            parse_record(broken)


def test_round_trip(spark, tmp_path):
    long, other = "é" * 500, "z" * 999
    rows = [(1, "http://a/ b\r\nX: y", long), (2, None, long), (9, "u", long), (3, "u", other),
            (4, "u", other), (5, "u", None), (6, "u", ""), (None, "u", long), (9, "u", long),
            (7, "u", "x" * 3_000_000), (8, "u", "tail\r\n\r\n WARC/1.1")]
    pages = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS payload", "2 AS original", "3 AS path").repartition(3)
    manifest = write_warc(pages, str(tmp_path), most_bytes=2000)
    assert sum(r.records for r in manifest.collect()) == len(rows)
    found = read_warc(manifest).collect()
    want = sorted((str(i), len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest(),
                   "revisit" if h == long and i != 9 else "response",
                   9 if h == long and i != 9 else None) for i, _, h in rows)
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in found) == want
    texts = {r.page_id: r.payload.decode() for r in found if r.record_type == "response"}
    assert texts == {9: long, 3: other, 4: other, 5: "", 6: "", 7: "x" * 3_000_000,
                     8: "tail\r\n\r\n WARC/1.1"}
    uris = {r.page_id: r.uri for r in found}
    assert uris[1] == "http://a/%20b%0D%0AX:%20y" and uris[2] is None


def test_no_pages(spark):
    assert archive_pages(spark, spark.createDataFrame([], SCHEMA)).count() == 0
