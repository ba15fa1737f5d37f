"""Operator 9, WARC archives as a PySpark Python data source (``spark.read.format("warc")`` and ``df.write.format("warc")``).

Writing: each task streams its rows into one archive under a name of its own and reports the file; the driver's commit
publishes a manifest of those files, so an attempt that was lost leaves nothing that is read. Each record is a gzip member
whose extra field ``sl`` holds its compressed and full length, so a reader can pass over it without inflating it. The
manifest also holds an offset about every ``split_bytes``.

Reading: the driver plans one partition per stretch between offsets of the manifest (or per file, for archives that have
none). Predicates on record type and header columns are pushed down: a partition inflates the beginning of a member,
parses the header, and skips members that fail, without inflating the rest. The payload is inflated and decoded only with
option ``payload`` = "all", or for the types named in it ("response"); "none" leaves it null. ``verify`` recomputes digests.

Files are reached through pyarrow's filesystems (local, hdfs, s3, gs URIs), as is the shared folder.

Defined cases: a null or empty payload is a record with an empty payload; a null url has no target header; control signs
in a url are percent-encoded; a null page id has a record id drawn from its digest; rows that repeat a page id are records
of their own; no rows give an archive folder without records; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringStartsWith,
    WriterCommitMessage,
)

from .common import _later, bounded_batches, shared_dir

SCHEMA = "warc_type string, record_id string, target_uri string, warc_date string, payload_digest string, refers_to string, page_id long, payload_bytes long, payload binary, file string, offset long"
#: Fixed values of the WARC 1.1 format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
COLUMN_OF = {"warc-type": "warc_type", "warc-record-id": "record_id", "warc-target-uri": "target_uri", "warc-date": "warc_date", "warc-payload-digest": "payload_digest", "warc-refers-to": "refers_to"}
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]
MANIFEST = "_manifest-"
BATCH_BYTES = 4 << 20


def digest32(payload: bytes) -> str:
    """SHA-1 in upper-case base32."""
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"urn:changeloom:page:{page_id}" if page_id is not None else f"urn:changeloom:payload:{digest}:{uuid.uuid4().hex}"


def _clean(uri: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """A whole WARC record; a revisit has the digest and length of the payload, but not the payload."""
    digest = digest32(payload)
    block = HTTP_HEAD + (payload if kind == "response" else b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id(page_id, digest)}>"), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", _clean(url)))
    head.append(("WARC-Payload-Digest", f"sha1:{digest}"))
    if kind == "revisit":
        head += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{record_id(refers_to, digest)}>")]
    head += [("X-Payload-Length", str(len(payload))), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    """A gzip member whose extra field says how long it is."""
    z = zlib.compressobj(level, zlib.DEFLATED, -15)
    body = z.compress(data) + z.flush()
    total = 10 + 2 + 12 + len(body) + 8
    extra = b"sl" + struct.pack("<HII", 8, total & 0xFFFFFFFF, len(data) & 0xFFFFFFFF)
    return b"\x1f\x8b\x08\x04\0\0\0\0\0\xff" + struct.pack("<H", len(extra)) + extra + body + struct.pack("<II", zlib.crc32(data), len(data) & 0xFFFFFFFF)


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> DataSourceReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: object, overwrite: bool) -> DataSourceArrowWriter:
        return WarcWriter(dict(self.options), overwrite)


class _Written(WriterCommitMessage):
    def __init__(self, file: str | None, starts: list[int], end: int, records: int):
        self.file, self.starts, self.end, self.records = file, starts, end, records


class WarcWriter(DataSourceArrowWriter):
    """Input columns: page_id, url, payload (binary), warc_type, refers_to (a page id)."""

    def __init__(self, options: dict[str, str], overwrite: bool):
        self.path, self.overwrite = options["path"], overwrite
        self.level = int(options.get("level", "4"))
        self.split = int(options.get("split_bytes", str(32 << 20)))
        self.date = options.get("date", "1970-01-01T00:00:00Z")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, top = _filesystem(self.path)
        file, starts, at, n, out = f"part-{uuid.uuid4().hex}.warc.gz", [0], 0, 0, None
        for b in iterator:
            get = lambda c: b.column(b.schema.get_field_index(c))  # noqa: B023, E731
            for page, url, payload, kind, refers in zip(get("page_id").to_pylist(), get("url").to_pylist(), get("payload"), get("warc_type").to_pylist(), get("refers_to").to_pylist()):
                if out is None:
                    fs.create_dir(top, recursive=True)
                    out = fs.open_output_stream(f"{top}/{file}", compression=None)
                data = member(record(kind, page, url, payload.as_py() or b"", refers, self.date), self.level)
                if at - starts[-1] >= self.split:
                    starts.append(at)
                out.write(data)
                at, n = at + len(data), n + 1
        if out is None:
            return _Written(None, [], 0, 0)
        out.close()
        return _Written(file, starts, at, n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, top = _filesystem(self.path)
        fs.create_dir(top, recursive=True)
        if self.overwrite:
            for f in fs.get_file_info(pafs.FileSelector(top)):
                if f.base_name.startswith(MANIFEST):
                    fs.delete_file(f.path)
        files = [{"file": m.file, "starts": m.starts, "end": m.end, "records": m.records} for m in messages if m and m.file]
        with fs.open_output_stream(f"{top}/{MANIFEST}{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(files).encode())

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, top = _filesystem(self.path)
        for m in messages:
            if m and m.file:
                try:
                    fs.delete_file(f"{top}/{m.file}")
                except OSError:
                    pass


class WarcPartition(InputPartition):
    def __init__(self, file: str, start: int, end: int | None):
        super().__init__((file, start, end))
        self.file, self.start, self.end = file, start, end


class WarcReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.payload = options["path"], options.get("payload", "all")
        self.verify = options.get("verify", "false").lower() == "true"
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes equality, IN, prefix and not-null predicates on the header columns."""
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            known = column in COLUMN_OF.values() or column in ("page_id", "payload_bytes")
            if known and isinstance(f, EqualTo):
                self.tests.append((column, "in", (f.value,)))
            elif known and isinstance(f, In):
                self.tests.append((column, "in", tuple(f.value)))
            elif known and isinstance(f, StringStartsWith):
                self.tests.append((column, "starts", f.value))
            elif known and isinstance(f, IsNotNull):
                self.tests.append((column, "any", None))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        fs, top = _filesystem(self.path)
        infos = fs.get_file_info(pafs.FileSelector(top))
        out: list[InputPartition] = []
        manifests = [f.path for f in infos if f.base_name.startswith(MANIFEST)]
        for m in sorted(manifests):
            with fs.open_input_stream(m) as f:
                for x in json.loads(f.read()):
                    for a, b in zip(x["starts"], [*x["starts"][1:], x["end"]]):
                        out.append(WarcPartition(x["file"], a, b))
        if not manifests:  # archives of other writers
            out = [WarcPartition(f.base_name, 0, None) for f in infos if re.search(r"\.warc(\.gz)?$", f.base_name)]
        return out or [WarcPartition("", 0, 0)]

    def passes(self, row: dict) -> bool:
        for column, kind, value in self.tests:
            x = row[column]
            if x is None or kind == "in" and x not in value or kind == "starts" and not x.startswith(value):
                return False
        return True

    def wants(self, kind: str | None) -> bool:
        return self.payload == "all" or kind is not None and kind in self.payload.split(",")

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        assert isinstance(partition, WarcPartition)
        if not partition.file:
            return
        fs, top = _filesystem(self.path)
        schema = pa.schema([(n, {"page_id": pa.int64(), "payload_bytes": pa.int64(), "offset": pa.int64(), "payload": pa.binary()}.get(n, pa.string())) for n in NAMES])
        rows, held = [], 0
        with fs.open_input_file(f"{top}/{partition.file}") as f:
            end = partition.end if partition.end is not None else f.size()
            source = _members(f, partition.start, end) if partition.file.endswith(".gz") else _plain(f, partition.start, end)
            for offset, head, block in source:
                row = _row(head) | {"file": partition.file, "offset": offset, "payload": None}
                if not self.passes(row):
                    continue
                if self.wants(row["warc_type"]) and row["warc_type"] != "revisit":
                    row["payload"] = _payload(head, block())
                    if row["payload_bytes"] is None:
                        row["payload_bytes"] = len(row["payload"])
                    if self.verify and (digest32(row["payload"]) != row["payload_digest"] or len(row["payload"]) != row["payload_bytes"]):
                        raise ValueError(f"{partition.file} at {offset}: the payload differs from its digest or length")
                rows.append(row)
                held += 500 + len(row["payload"] or b"")
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema)


def _parsed(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    out = {}
    for line in lines[1:]:
        k, colon, v = line.partition(":")
        if colon:
            out[k.strip().lower()] = v.strip()
    return out


def _row(head: dict[str, str]) -> dict:
    row = {c: head.get(k) for k, c in COLUMN_OF.items()}
    for c in ("record_id", "refers_to"):
        if row[c]:
            row[c] = row[c].strip("<>")
    if row["payload_digest"]:
        row["payload_digest"] = row["payload_digest"].removeprefix("sha1:")
    page = re.fullmatch(r"urn:changeloom:page:(-?\d+)", row["record_id"] or "")
    row["page_id"] = int(page[1]) if page else None
    row["payload_bytes"] = int(head["x-payload-length"]) if "x-payload-length" in head else None
    return row


def _payload(head: dict[str, str], block: bytes) -> bytes:
    if head.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


def _members(f: pa.NativeFile, at: int, end: int):
    """Offset, header and a function that gives the block, of each gzip member; what isn't asked for isn't inflated."""
    while at < end:
        f.seek(at)
        start = f.read(8192)
        z, data, fed = zlib.decompressobj(31), b"", 0
        while b"\r\n\r\n" not in data and not z.eof:
            piece = start[fed : fed + 8192] if fed < len(start) else f.read(65536)
            if not piece:
                raise ValueError(f"the member at {at} is cut off")
            data += z.decompress(piece)
            fed += len(piece)
        head = _parsed(data.partition(b"\r\n\r\n")[0])
        state = {"z": z, "data": data}

        def rest(state: dict = state) -> None:
            while not state["z"].eof:
                piece = f.read(1 << 20)
                if not piece:
                    raise ValueError("a member is cut off")
                state["data"] += state["z"].decompress(piece)

        def block(head: dict = head, state: dict = state, rest=rest) -> bytes:
            rest()
            body = state["data"].partition(b"\r\n\r\n")[2]
            return body[: int(head["content-length"])]

        yield at, head, block
        n = None
        if start[3] & 4 and start[12:14] == b"sl":
            n = struct.unpack("<I", start[16:20])[0]
        if n is None:  # another writer's member: its end shows only when it is inflated
            rest()
            n = f.tell() - at - len(state["z"].unused_data) if fed >= len(start) or f.tell() > at + len(start) else len(start) - len(state["z"].unused_data)
        at += n


def _plain(f: pa.NativeFile, at: int, end: int):
    while at < end:
        f.seek(at)
        data = b""
        while b"\r\n\r\n" not in data:
            piece = f.read(8192)
            if not piece:
                return
            data += piece
        raw = data.partition(b"\r\n\r\n")[0]
        head, begin = _parsed(raw), at + len(raw) + 4

        def block(begin: int = begin, head: dict = head) -> bytes:
            f.seek(begin)
            return f.read(int(head["content-length"]))

        yield at, head, block
        at = begin + int(head["content-length"]) + 4


def register(spark: SparkSession) -> None:
    spark.dataSource.register(WarcSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def with_revisits(pages: DataFrame, min_bytes: int = 0, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """``page_id, url, payload, warc_type, refers_to``: of equal payloads of at least ``min_bytes`` the smallest id is the response, the others revisit it."""
    p = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.encode(F.coalesce(F.col(payload_col).cast("string"), F.lit("")), "utf-8").alias("payload"))
    p = p.withColumn("key", F.when(F.octet_length("payload") >= min_bytes, F.sha2("payload", 256)))
    first = p.filter("key is not null").groupBy("key").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n")  # small where few pages repeat
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return p.join(first, "key", "left").select("page_id", "url", "payload", F.when(revisit, "revisit").otherwise("response").alias("warc_type"), F.when(revisit, F.col("first_id")).alias("refers_to"))


def archived(pages: DataFrame, path: str | None = None, min_bytes: int = 0, level: int = 4, payload: str = "none", verify: bool = False, **columns: str) -> DataFrame:
    """Writes the pages as archives under ``path`` (or the shared folder) and gives them as read back."""
    spark = pages.sparkSession
    bounded_batches(spark)
    register(spark)
    if path is None:
        path = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
        _later(spark, path)
    with_revisits(pages, min_bytes, **columns).write.format("warc").mode("append").option("level", level).save(path)
    return spark.read.format("warc").option("payload", payload).option("verify", str(verify).lower()).load(path)
