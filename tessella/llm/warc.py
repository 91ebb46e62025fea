"""WARC archives as a Spark data source in Python, read and written.

Partitions are planned by size: packed files are cut at byte offsets, and a task reads the gzip members
that start in its stretch.  Record type and header predicates are pushed down: a record's headers
are parsed first, and the payload of a record that is not wanted, or whose columns are not asked
for, is not decoded.  The writer makes one member per record and notes its length in its header, so the
reader goes on without inflating what it skips; other archives are read to the end of each record.
Paths may be in any store that ``pyarrow.fs`` knows.
"""

import base64
import hashlib
import struct
import uuid
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, EqualTo, In, InputPartition, WriterCommitMessage,
)

SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, refers_to string, "
    "payload_digest string, payload_bytes long, payload binary"
)
HEADERS = {
    "record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri",
    "date": "warc-date", "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest",
}
#: Bytes of packed files that make a partition at most, and at least, and after which the writer
#: starts another file.
PARTITION_BYTES = 128 << 20
LEAST_BYTES = 1 << 20
ROLL_BYTES = 256 << 20
#: Rows, and bytes of payload, of an Arrow batch.
BATCH_ROWS, BATCH_BYTES = 1_000, 16 << 20
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:/", "file:///", 1))


def _member(record: bytes) -> bytes:
    """A gzip member that names its own length (extra field ``sl``: packed and plain length)."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(record) + packer.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total & 0xFFFFFFFF, len(record) & 0xFFFFFFFF)
    head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra
    return head + body + struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)


def record_bytes(record_id, record_type, target_uri, date, refers_to, payload: bytes) -> bytes:
    """One record.  A revisit holds the HTTP head of the payload it stands for, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if record_type == "revisit" else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {record_type}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}", "Content-Type: application/http; msgtype=response",
    ]
    if target_uri is not None:
        lines.append("WARC-Target-URI: " + " ".join(target_uri.split()))
    if record_type == "revisit":
        lines += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {_PROFILE}"]
    lines += [f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


class _Input:
    """Reads records of a stretch of a file one after another, the payload only on demand."""

    CHUNK = 1 << 16

    def __init__(self, file, size: int, start: int, end: int, packed: bool):
        self.file, self.size, self.start, self.end, self.packed = file, size, start, end, packed

    def _open(self, at: int) -> None:
        """Go on with the gzip member, or the plain file, at ``at``."""
        self.next, self.plain, self.left = at, bytearray(), 0
        self.inflate = zlib.decompressobj(31) if self.packed else None

    def _read(self) -> bytes:
        self.file.seek(self.next)
        data = self.file.read(self.CHUNK)
        self.next += len(data)
        return data

    def _more(self) -> bool:
        """Add to ``plain``; False at the end of the member or the plain file."""
        if self.inflate is None:
            data = self._read()
            self.plain += data
            return bool(data)
        if self.inflate.eof:
            return False
        data = self.inflate.unconsumed_tail or self._read()
        if not data:
            raise ValueError("the archive ends inside a record")
        self.plain += self.inflate.decompress(data, self.CHUNK)
        return True

    def _take(self, n: int) -> bytes:
        """The next ``n`` bytes of the record's block."""
        while len(self.plain) < n:
            if not self._more():
                raise ValueError("the archive ends inside a record")
        out = bytes(self.plain[:n])
        del self.plain[:n]
        self.left -= n
        return out

    def _skip_block(self) -> None:
        while self.left:
            if not self.plain and not self._more():
                raise ValueError("the archive ends inside a record")
            n = min(self.left, len(self.plain))
            del self.plain[:n]
            self.left -= n

    def _first_member(self) -> int:
        """Start of the first member in the stretch that holds the start of a record."""
        if not self.start:
            return 0
        at = self.start
        while at < self.end:
            self.file.seek(at)
            data = self.file.read(min(self.CHUNK, self.end - at) + len(_MAGIC) - 1)
            spot = data.find(_MAGIC)
            while spot >= 0:
                if self._starts_record(at + spot):
                    return at + spot
                spot = data.find(_MAGIC, spot + 1)
            at += max(1, len(data) - len(_MAGIC) + 1)
        return self.end

    def _starts_record(self, at: int) -> bool:
        self.file.seek(at)
        try:
            return zlib.decompressobj(31).decompress(self.file.read(4096), 5) == b"WARC/"
        except zlib.error:
            return False

    def records(self):
        """``headers, length of the block`` of each record that starts in the stretch."""
        at = self._first_member()
        while at < self.end:
            known = self._noted_length(at) if self.packed else None
            self._open(at)
            alone = True
            while self._at_record():
                headers, length, plain = self._headers()
                self.left = length
                yield headers, length
                if alone and known and known[1] == plain + length + 4:
                    break  # the member holds this record alone
                self._skip_block()
                alone = False
            else:
                if not self.packed:
                    return
                known = (self.next - len(self.inflate.unused_data) - at, 0)
            at += known[0]

    def _noted_length(self, at: int) -> tuple[int, int] | None:
        self.file.seek(at)
        head = self.file.read(24)
        if head[:2] != _MAGIC[:2]:
            raise ValueError("not a gzip member")
        return struct.unpack("<II", head[16:24]) if len(head) == 24 and head[3] == 4 and head[12:16] == b"sl\x08\0" else None

    def _at_record(self) -> bool:
        """Pass over line ends; whether anything follows."""
        while True:
            ends = len(self.plain) - len(self.plain.lstrip(b"\r\n"))
            del self.plain[:ends]
            if self.plain:
                return True
            if not self._more():
                return False

    def _headers(self) -> tuple[dict, int, int]:
        while b"\r\n\r\n" not in self.plain:
            if not self._more():
                raise ValueError("not a WARC record")
        end = self.plain.index(b"\r\n\r\n") + 4
        first, headers = _header_lines(bytes(self.plain[:end]).decode("utf-8", "replace"))
        if not first.startswith("WARC/") or not headers.get("content-length", "").isdecimal():
            raise ValueError("not a WARC record")
        del self.plain[:end]
        return headers, int(headers["content-length"]), end

    def http_head(self) -> dict:
        """Headers of the HTTP message in the block; what is left of the block is its body.  A block
        without the empty line that ends them has none, and all of it is body."""
        while (end := self.plain.find(b"\r\n\r\n", 0, self.left)) < 0 and len(self.plain) < self.left:
            if not self._more():
                raise ValueError("the archive ends inside a record")
        return _header_lines(self._take(end + 4).decode("latin-1"))[1] if end >= 0 else {}

    def rest(self) -> bytes:
        """What is left of the block."""
        return self._take(self.left)


#: How a gzip member begins.
_MAGIC = b"\x1f\x8b\x08"


def _header_lines(text: str) -> tuple[str, dict[str, str]]:
    """First line and headers by lower-case name; a line that starts with a blank goes on with the
    one before it, and the last of repeated headers counts."""
    lines: list[str] = []
    for line in text.split("\r\n"):
        if line[:1] in (" ", "\t") and lines:
            lines[-1] += " " + line.strip()
        elif line:
            lines.append(line)
    return (lines or [""])[0], {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}


def _unchunked(body: bytes) -> bytes | None:
    """The body of a chunked HTTP message; None if it is not one."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].partition(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            return None
        if size == 0:
            return b"".join(out)
        if size < 0 or len(body) < end + 2 + size:
            return None
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2


def _bare_digest(value: str | None) -> str | None:
    """SHA-1 bare, in upper-case base32; other digests as they are, with their label."""
    label, colon, code = (value or "").partition(":")
    if not colon or label.lower() != "sha1":
        return value or None
    if len(code) == 40:  # in hexadecimal digits
        try:
            return base64.b32encode(bytes.fromhex(code)).decode()
        except ValueError:
            return code.upper()
    return code.upper()


@dataclass
class _Stretches(InputPartition):
    """``path, size, start, end`` of each stretch of a task."""

    parts: list

    def __init__(self, parts):
        self.parts = parts


class WarcReader(DataSourceReader):
    def __init__(self, options, columns):
        self.folder = options["path"]
        self.columns = columns
        self.verify = options.get("verify", "false").lower() == "true"
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tasks = int(options.get("tasks", 1))
        self.wanted: list[tuple[str, set]] = []

    def pushFilters(self, filters):
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name in HEADERS and name != "payload_digest" and isinstance(f, (EqualTo, In)):
                self.wanted.append((HEADERS[name], set(f.value) if isinstance(f, In) else {f.value}))
            else:
                yield f

    def partitions(self):
        store, root = _store(self.folder)
        files = sorted((f.path, f.size) for f in self._archives(store, root))
        # small archives are cut finer, so that all of the cluster reads them
        share = max(LEAST_BYTES, sum(size for _, size in files) // self.tasks)
        most = min(self.partition_bytes, share)
        out, held = [[]], 0
        for path, size in files:
            # plain files are not cut: their payloads may hold what looks like a record
            step = most if path.endswith(".gz") else max(1, size)
            for start in range(0, size, step):
                end = min(size, start + step)
                if out[-1] and held + end - start > most:
                    out.append([])
                    held = 0
                out[-1].append((path, size, start, end))
                held += end - start
        return [_Stretches(p) for p in out]

    def _archives(self, store, root):
        top = store.get_file_info(root)
        found = [top] if top.is_file else store.get_file_info(fs.FileSelector(root, recursive=True))
        for f in found:
            if f.is_file and f.base_name[0] not in "_.":
                if f.base_name.endswith((".warc", ".warc.gz")):
                    yield f
                elif ".warc." in f.base_name:
                    raise ValueError(f"{f.path} is an archive in a form that is not read")

    def read(self, partition):
        store, _ = _store(self.folder)
        rows, held = [], 0
        for path, size, start, end in partition.parts:
            with store.open_input_file(path) as file:
                archive = _Input(file, size, start, end, path.endswith(".gz"))
                for headers, _ in archive.records():
                    if all(headers.get(h) in values for h, values in self.wanted):
                        rows.append(self._row(archive, headers))
                        held += len(rows[-1].get("payload") or b"")
                        if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                            yield self._batch(rows)
                            rows, held = [], 0
        if rows:
            yield self._batch(rows)

    def _row(self, archive, headers):
        row = {name: headers.get(h) for name, h in HEADERS.items()}
        row["payload_digest"] = _bare_digest(row["payload_digest"])
        if not ({"payload", "payload_bytes"} & set(self.columns) or self.verify):
            return row
        kind = headers.get("content-type", "").lower()
        http = kind.startswith("application/http") or not kind and row["record_type"] in ("response", "request", "revisit")
        said = archive.http_head() if http else {}
        if row["record_type"] == "revisit":
            length = said.get("content-length", "")
            row["payload_bytes"] = int(length) if length.isdecimal() else None
            return row
        body = archive.rest()
        plain = _unchunked(body) if said.get("transfer-encoding", "").lower().endswith("chunked") else None
        payload = body if plain is None else plain
        if self.verify and row["payload_digest"] and not any(_agrees(row["payload_digest"], p) for p in {payload, body}):
            raise ValueError(f"the payload of {row['record_id']} is not what its headers say")
        row["payload_bytes"] = len(payload)
        if "payload" in self.columns:
            row["payload"] = payload
        return row

    def _batch(self, rows):
        kinds = {"payload": pa.binary(), "payload_bytes": pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], kinds.get(c, pa.string())) for c in self.columns], self.columns)


def _agrees(said: str, payload: bytes) -> bool:
    """Whether ``payload`` has that digest; True for kinds of digest that are not known here."""
    label, colon, code = said.partition(":")
    if not colon:
        return said == digest(payload)
    if label.lower() not in ("md5", "sha256", "sha512"):
        return True
    raw = hashlib.new(label.lower(), payload).digest()
    return code.lower().rstrip("=") in (raw.hex(), base64.b32encode(raw).decode().lower().rstrip("="))


@dataclass
class _Written(WriterCommitMessage):
    names: list


class WarcWriter(DataSourceWriter):
    """Files appear under their final names when all tasks are done; a failed attempt's never do."""

    def __init__(self, options):
        self.folder = options["path"]

    def write(self, iterator):
        store, root = _store(self.folder)
        store.create_dir(root, recursive=True)
        names, out, size = [], None, 0
        for row in iterator:
            if out is None or size >= ROLL_BYTES:
                if out is not None:
                    out.close()
                names.append(f"{uuid.uuid4().hex}.warc.gz")
                out, size = store.open_output_stream(f"{root}/_{names[-1]}", compression=None), 0
            payload = bytes(row["payload"]) if row["payload"] is not None else b""
            packed = _member(record_bytes(row["record_id"], row["record_type"], row["target_uri"], row["date"], row["refers_to"], payload))
            out.write(packed)
            size += len(packed)
        if out is not None:
            out.close()
        return _Written(names)

    def commit(self, messages):
        store, root = _store(self.folder)
        store.create_dir(root, recursive=True)
        for message in messages:
            for name in message.names if message else ():
                store.move(f"{root}/_{name}", f"{root}/part-{name}")

    def abort(self, messages):
        store, root = _store(self.folder)
        for message in messages:
            for name in message.names if message else ():
                store.delete_file(f"{root}/_{name}")


class WarcSource(DataSource):
    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options, [f.name for f in schema.fields])

    def writer(self, schema, overwrite):
        return WarcWriter(self.options)


def read_warc(spark: SparkSession, folder: str, schema: str = SCHEMA, verify: bool = False, partition_bytes: int = PARTITION_BYTES) -> DataFrame:
    """Records of the ``.warc`` and ``.warc.gz`` files under ``folder``, or of that one file;
    ``schema`` names the columns wanted.

    The payload of a record that holds an HTTP message (by its content type; where it has none, a
    response, request or revisit) is the message's body, without chunk marks; of any other record
    it is the whole block.  A revisit has no payload, and ``payload_bytes`` is what its HTTP head
    declares, null if nothing.  SHA-1 digests are given bare in upper-case base32, others as they
    stand.  With ``verify`` each stored payload is checked against its digest; records without one,
    or with one of an unknown kind, pass.  Records that repeat an id are all given.  Files whose
    names begin with ``_`` or ``.`` are not read (parts of an unfinished write); an archive packed otherwise
    stops the read.  An empty folder gives no rows; a damaged archive fails the read with the reason.
    One task reads at most about ``partition_bytes`` of packed files, or one plain file.  The session's
    pushdown of filters to Python sources stays switched on, as the scan is planned later.
    """
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    options = {"verify": str(verify), "partitionbytes": str(partition_bytes), "tasks": str(spark.sparkContext.defaultParallelism)}
    return spark.read.format("warc").schema(schema).options(**options).load(folder)


def write_warc(records: DataFrame, folder: str) -> None:
    """Write ``records (record_id, record_type, target_uri, date, refers_to, payload)``; a null
    payload is an empty one."""
    records.sparkSession.dataSource.register(WarcSource)
    columns = ["record_id", "record_type", "target_uri", "date", "refers_to", "payload"]
    records.select(*columns).write.format("warc").mode("append").save(folder)


def page_records(pages: DataFrame, date: str = "2024-01-01T00:00:00Z", least_bytes: int = 0) -> DataFrame:
    """Records of ``pages (page_id, url, html)``: of pages with equal payloads of at least
    ``least_bytes``, that with the largest id is the response and the others revisit it.

    Null html is an empty payload.  Of rows that also share the id, the first by url is the
    response.  Null ids are smaller than any other and named ``none``.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("_digest"))
    groups = rows.where(F.octet_length("payload") >= least_bytes).groupBy("_digest").agg(F.count("*").alias("_n"), F.max("page_id").alias("_keep"))
    groups = groups.where("_n > 1")
    small = groups.limit(100_001).count() <= 100_000
    rows = rows.join(F.broadcast(groups) if small else groups, "_digest", "left")
    # only rows of a group that share the id it keeps can tie
    tied = rows.where("_n IS NOT NULL AND page_id <=> _keep").groupBy("_digest").agg(
        F.count("*").alias("_ties"), F.min("url").alias("_first")
    ).where("_ties > 1")
    nth = F.row_number().over(Window.partitionBy("_digest").orderBy(F.col("url").asc_nulls_last()))
    if tied.isEmpty():
        rows = rows.withColumn("_response", F.col("_n").isNull() | F.col("page_id").eqNullSafe(F.col("_keep")))
    else:
        holds = F.col("_n").isNotNull() & F.col("page_id").eqNullSafe(F.col("_keep"))
        one = rows.where(holds).withColumn("_nth", nth).withColumn("_response", F.col("_nth") == 1).drop("_nth")
        rest = rows.where(~holds).withColumn("_response", F.col("_n").isNull())
        rows = one.unionByName(rest)
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("none")), F.lit(">"))
    return rows.select(
        name("page_id").alias("record_id"), F.when(F.col("_response"), "response").otherwise("revisit").alias("record_type"),
        F.col("url").alias("target_uri"), F.lit(date).alias("date"), F.when(~F.col("_response"), name("_keep")).alias("refers_to"), "payload",
    )
