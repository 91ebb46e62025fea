"""Archives of other writers, and packed files cut over tasks."""

import base64
import gzip
import hashlib

import pytest

from tessella.llm.warc import read_warc, record_bytes, write_warc


def _record(kind, block, *more):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:{kind}>", *more, f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


HTTP = "Content-Type: application/http;\r\n  msgtype=response"
INFO = _record("warcinfo", b"software: x\r\n\r\nmore", "Content-Type: application/warc-fields")
CHUNKED = _record("response", b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n4\r\nwarc\r\n3;x=y\r\n!!!\r\n0\r\n\r\n", HTTP)
LOWER = _record(
    "resource", b"bytes \x00\r\n\r\nWARC/1.0\r\n", "Content-Type: image/png",
    "WARC-Payload-Digest: sha1:" + base64.b32encode(hashlib.sha1(b"bytes \x00\r\n\r\nWARC/1.0\r\n").digest()).decode().lower(),
)
OTHER = _record("request", b"GET / HTTP/1.1\r\n\r\n", "Content-Type: application/http", "WARC-Payload-Digest: sha256:" + hashlib.sha256(b"").hexdigest())
HEADLESS = _record("metadata", b"")
REVISIT = _record("revisit", b"HTTP/1.1 200 OK\r\n\r\n", HTTP)
RECORDS = [INFO, CHUNKED, LOWER, OTHER, HEADLESS, REVISIT]
PAYLOADS = {
    "warcinfo": b"software: x\r\n\r\nmore", "response": b"warc!!!", "resource": b"bytes \x00\r\n\r\nWARC/1.0\r\n", "request": b"",
    "metadata": b"", "revisit": None,
}


@pytest.mark.parametrize("verify", [False, True])
@pytest.mark.parametrize("name", ["plain.warc", "one_each.warc.gz", "all_in_one.warc.gz"])
def test_archives_of_other_writers(spark, tmp_path, name, verify):
    data = b"".join(gzip.compress(r) for r in RECORDS) if name.startswith("one") else b"".join(RECORDS)
    (tmp_path / name).write_bytes(gzip.compress(data) if name.startswith("all") else data)
    rows = read_warc(spark, str(tmp_path), verify=verify).collect()
    assert len(rows) == len(RECORDS)
    assert {r.record_type: None if r.payload is None else bytes(r.payload) for r in rows} == PAYLOADS
    assert {r.record_type: r.payload_bytes for r in rows} == {k: None if v is None else len(v) for k, v in PAYLOADS.items()}
    some = read_warc(spark, str(tmp_path / name), "record_type string, payload binary").where("record_type = 'resource'").collect()
    assert [bytes(r.payload) for r in some] == [PAYLOADS["resource"]]


def test_wrong_digests_and_forms_stop_the_read(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(_record("resource", b"abc", "WARC-Payload-Digest: sha1:" + "A" * 32))
    assert read_warc(spark, str(tmp_path)).count() == 1
    with pytest.raises(Exception, match="not what its headers say"):
        read_warc(spark, str(tmp_path), verify=True).collect()
    (tmp_path / "cut.warc.gz").write_bytes(gzip.compress(INFO)[:-30])
    with pytest.raises(Exception, match="ends inside"):
        read_warc(spark, str(tmp_path)).collect()
    (tmp_path / "b.warc.zst").write_bytes(b"")
    with pytest.raises(Exception, match="not read"):
        read_warc(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("foreign", [False, True])
def test_packed_files_are_cut_at_members(spark, tmp_path, foreign):
    ids = [f"<urn:{i}>" for i in range(300)]
    payload = lambda i: (f"{i} " * (i * 7 % 90)).encode() + bytes([0x1F, 0x8B, 8, 0])
    if foreign:
        parts = [gzip.compress(record_bytes(n, "response", None, "2024-01-01T00:00:00Z", None, payload(i)), 0) for i, n in enumerate(ids)]
        (tmp_path / "x.warc.gz").write_bytes(b"".join(parts))
    else:
        rows = [(n, "response", None, "2024-01-01T00:00:00Z", None, payload(i)) for i, n in enumerate(ids)]
        schema = "record_id string, record_type string, target_uri string, date string, refers_to string, payload binary"
        write_warc(spark.createDataFrame(rows, schema).coalesce(1), str(tmp_path))
    read = read_warc(spark, str(tmp_path), verify=True, partition_bytes=1_000)
    assert read.rdd.getNumPartitions() > 20
    assert {(r.record_id, bytes(r.payload)) for r in read.collect()} == {(n, payload(i)) for i, n in enumerate(ids)}
    assert read.count() == len(ids)
