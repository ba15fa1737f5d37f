"""Wire formats: the logical replication messages and the binary copy format, decoded in Arrow batches (SRC4-9, FN3, FN16).

A message is decoded as a whole or rejected as a whole: ``error`` says why, and such rows go to a side output. Cells come
out as texts; the typed columns are a projection by the registry (``typed_rows``), so casts stay in the JVM.

Encoders for the same formats make fixtures; no database is needed.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.pgtypes import base_type, decoder, from_text, op_name, spark_type, widened
from ..operators.feed import LSN, OP, TIME, with_metadata
from .catalog import Column, Table, known_type
from .files import filesystem

COPY_SIGNATURE, COPY_END = b"PGCOPY\n\xff\r\n\0", b"\xff\xff"
#: A streamed frame's kind, and what its header holds after it: start and end position, and time.
FRAME_HEAD = 25
#: A copy file is read in pieces of so many bytes.
PIECE_BYTES = 4 << 20

# Decoding


class Bad(ValueError):
    """A message that can't be read."""


_FILLED, _NULL, _UNCHANGED, _SIZE = frozenset(b"tb"), ord("n"), ord("u"), struct.Struct(">i").unpack_from


class _Bytes:
    def __init__(self, data: bytes, at: int = 0):
        self.data, self.at = data, at

    def take(self, n: int) -> bytes:
        if n < 0 or self.at + n > len(self.data):
            raise Bad("cut off")
        out = self.data[self.at : self.at + n]
        self.at += n
        return out

    def number(self, form: str) -> int:
        return struct.unpack(form, self.take(struct.calcsize(form)))[0]

    def string(self) -> str:
        end = self.data.find(b"\0", self.at)
        if end < 0:
            raise Bad("a string has no end")
        out = self.data[self.at : end].decode("utf-8", "replace")
        self.at = end + 1
        return out

    def tuple(self) -> tuple[list[str | None], list[int]]:
        """Cells as texts, and the places of unchanged ones."""
        data, end = self.data, len(self.data)
        n, at = self.number(">H"), self.at
        cells: list[str | None] = [None] * n
        unchanged: list[int] = []
        for i in range(n):
            if at >= end:
                raise Bad("cut off")
            kind = data[at]
            at += 1
            if kind in _FILLED:
                size, at = _SIZE(data, at)[0], at + 4
                if size < 0 or at + size > end:
                    raise Bad("cut off")
                cells[i] = data[at : at + size].decode("utf-8", "replace")
                at += size
            elif kind == _UNCHANGED:
                unchanged.append(i)
            elif kind != _NULL:
                raise Bad(f"unknown cell kind {bytes((kind,))!r}")
        self.at = at
        return cells, unchanged


def parse_message(payload: bytes | None) -> dict:
    """One message: kind, relation id, new and old cells, the layout of a relation, the marks of a transaction."""
    if not payload:
        raise Bad("empty")
    b, kind = _Bytes(payload, 1), payload[:1].decode("latin-1")
    out: dict = {"kind": kind}
    if kind == "B":
        out["final_lsn"], out["time"], out["xid"] = b.number(">q"), b.number(">q"), b.number(">I")
    elif kind == "C":
        b.take(1)
        out["final_lsn"], out["end_lsn"], out["time"] = b.number(">q"), b.number(">q"), b.number(">q")
    elif kind == "R":
        out["relation_id"], out["schema"], out["table"], out["identity"] = b.number(">I"), b.string(), b.string(), b.take(1).decode("latin-1")
        out["columns"] = [{"key": bool(b.take(1)[0] & 1), "name": b.string(), "oid": b.number(">I"), "modifier": b.number(">i")} for _ in range(b.number(">H"))]
    elif kind in "IUD":
        out["relation_id"] = b.number(">I")
        part = b.take(1)
        if part in (b"K", b"O"):
            if kind == "I":
                raise Bad("an insert has no old row")
            out["old"], _ = b.tuple()
            out["old_kind"] = part.decode()
            part = b.take(1) if kind == "U" else b""
        if kind != "D":
            if part != b"N":
                raise Bad("no new row")
            out["cells"], out["unchanged"] = b.tuple()
        elif "old" not in out:
            raise Bad("no old row")
    elif kind == "T":
        n = b.number(">I")
        b.take(1)
        out["relations"] = [b.number(">I") for _ in range(n)]
    return out


def parse_frame(frame: bytes) -> tuple[str, int | None, bytes]:
    """SRC7: a streamed frame's kind, its start position, and what it carries; a keepalive carries nothing."""
    if frame[:1] == b"w":
        if len(frame) < FRAME_HEAD:
            raise Bad("a short frame")
        return "w", struct.unpack(">q", frame[1:9])[0], frame[FRAME_HEAD:]
    if frame[:1] == b"k":
        if len(frame) < 18:
            raise Bad("a short keepalive")
        return "k", struct.unpack(">q", frame[1:9])[0], b""
    raise Bad("unknown frame")


_COLUMN = pa.struct([("key", pa.bool_()), ("name", pa.string()), ("oid", pa.int64()), ("modifier", pa.int32())])
_DECODED = pa.schema([
    ("lsn", pa.int64()), ("kind", pa.string()), ("relation_id", pa.int64()), ("xid", pa.int64()), ("cells", pa.list_(pa.string())), ("unchanged", pa.list_(pa.int32())), ("old", pa.list_(pa.string())), ("old_kind", pa.string()),
    ("schema", pa.string()), ("table", pa.string()), ("identity", pa.string()), ("columns", pa.list_(_COLUMN)), ("relations", pa.list_(pa.int64())), ("error", pa.string()), ("payload", pa.binary()),
])
DECODED = (
    "lsn long, kind string, relation_id long, xid long, cells array<string>, unchanged array<int>, old array<string>, old_kind string, schema string, `table` string, identity string, "
    "columns array<struct<key:boolean,name:string,oid:long,modifier:int>>, relations array<long>, error string, payload binary"
)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        columns: dict[str, list] = {}
        for i, payload in enumerate(b.column("payload").to_pylist()):
            try:
                found = parse_message(payload)
            except (Bad, struct.error) as e:
                found = {"error": str(e) or "unreadable", "payload": payload}
            for name, value in found.items():
                column = columns.setdefault(name, [])
                if len(column) < i:  # rows without it
                    column.extend([None] * (i - len(column)))
                column.append(value)
        n = b.num_rows
        arrays = [pa.array((x := columns[f.name]) + [None] * (n - len(x)), f.type) if f.name in columns else pa.nulls(n, f.type) for f in _DECODED if f.name != "lsn"]
        yield pa.RecordBatch.from_arrays([b.column("lsn"), *arrays], schema=_DECODED)


def decode_messages(messages: DataFrame) -> DataFrame:
    """SRC7-9, FLT13: ``lsn, payload`` rows as parsed messages; ``error`` is set on those that can't be read."""
    return messages.select(F.col("lsn").cast("long"), F.col("payload").cast("binary")).mapInArrow(_decode, DECODED)


def demux_frames(frames: DataFrame, column: str = "frame") -> DataFrame:
    """SRC7 on rows, in the JVM: ``kind, lsn, payload``; short and unknown frames have kind null. A keepalive's payload is null."""
    f = F.col(column)
    kind = F.decode(F.substring(f, 1, 1), "iso-8859-1")
    good = ((kind == "w") & (F.octet_length(f) >= FRAME_HEAD)) | ((kind == "k") & (F.octet_length(f) >= 18))
    lsn = F.conv(F.hex(F.substring(f, 2, 8)), 16, 10).try_cast("long")
    body = F.when(kind == "w", F.expr(f"substring(`{column}`, {FRAME_HEAD + 1})"))
    return frames.select(F.when(good, kind).alias("kind"), F.when(good, lsn).alias("lsn"), F.when(good, body).alias("payload"))


def rejected(decoded: DataFrame) -> DataFrame:
    return decoded.filter("error is not null").select("lsn", "payload", "error")


def relation_rows(decoded: DataFrame) -> DataFrame:
    """SRC8: a row per relation message: relation_id, since_lsn, schema, table, identity, columns."""
    return decoded.filter("kind = 'R'").select("relation_id", F.col("lsn").alias("since_lsn"), "schema", "table", "identity", "columns")


def tables_of(relations: DataFrame, catalog: dict[str, Table] | None = None) -> list[tuple[int, Table]]:
    """Layouts in order of position, typed by the catalog where it knows a column (J3): metadata, a row per change of a layout.

    A source repeats its relation messages; one that says what the one before it said stays where it is.
    """
    what = F.struct("schema", "table", "identity", "columns")
    before = F.lag(what).over(Window.partitionBy("relation_id").orderBy("since_lsn"))
    changed = relations.withColumn("_before", before).filter(~what.eqNullSafe(F.col("_before")))
    out = []
    for r in changed.orderBy("since_lsn", "relation_id").collect():
        known = {c.name: c.data_type for c in (catalog or {}).get(f"{r['schema']}.{r['table']}", Table("", "", ())).columns}
        columns = tuple(Column(c["name"], known_type(c["oid"], known.get(c["name"])), key=c["key"]) for c in r["columns"])
        out.append((r["since_lsn"], Table(r["schema"], r["table"], columns, r["relation_id"], r["identity"])))
    return out


def typed_rows(decoded: DataFrame, layouts: list[tuple[int, Table]], pk_change: str = "split", unchanged: bool = True, received_us: int | None = None) -> DataFrame:
    """SRC9, PRJ1, PRJ4: change rows of one table with typed columns and metadata, in one pass over the messages.

    ``layouts``: the table's layouts with the positions from which they hold; each change is read by the one in force. The
    result has the columns of all of them; a column whose type differs between layouts gets a type that holds both.
    ``pk_change`` "split" turns an update that changes the key into a delete of the old key and the update; "new_only" does
    not. A short row leaves columns null, a long one is cut to the layout. ``received_us`` is the time of landing.
    """
    kinds: dict[str, T.DataType] = {}
    in_force, moved = F.lit(None).cast("int"), F.lit(False)
    for i, (since, table) in reversed(list(enumerate(layouts))):
        holds = F.col("relation_id") == table.relation_id
        holds = holds & (F.col("lsn") >= since) if i else holds
        holds = holds & (F.col("lsn") < layouts[i + 1][0]) if i + 1 < len(layouts) else holds
        in_force = F.when(holds, F.lit(i)).otherwise(in_force)
    for i, (_, table) in enumerate(layouts):
        for c in table.columns:
            own = spark_type(c.data_type)
            kinds[c.name] = widened(kinds.get(c.name, own), own)
        for k in (k for k, c in enumerate(table.columns) if c.key):
            moved = moved | ((F.col("_layout") == i) & ~F.get("old", F.lit(k)).eqNullSafe(F.get("cells", F.lit(k))))
    changes = decoded.filter(F.col("error").isNull() & F.col("kind").isin("I", "U", "D")).withColumn("_layout", in_force).filter("_layout is not null")
    time = (F.lit(received_us) if received_us is not None else F.unix_micros(F.current_timestamp())).cast("long")

    def by_layout(value) -> SparkColumn:
        """``value`` of the layout in force; one that gives none has null."""
        out = F.lit(None)
        for i, (_, table) in enumerate(layouts):
            if (x := value(table)) is not None:
                out = F.when(F.col("_layout") == i, x).otherwise(out)
        return out

    def change(cells: str, op: SparkColumn) -> SparkColumn:
        def cell(name: str) -> SparkColumn:
            def read(table: Table) -> SparkColumn | None:
                k = next((k for k, c in enumerate(table.columns) if c.name == name), None)
                return None if k is None else from_text(F.get(cells, F.lit(k)), table.columns[k].data_type).cast(kinds[name])

            return by_layout(read).cast(kinds[name]).alias(name)

        names = by_layout(lambda table: F.array(*[F.lit(c.name) for c in table.columns]))
        extra = [F.transform("unchanged", lambda k: F.get(names, k)).alias("_cdc_unchanged")] if unchanged else []
        return F.struct(*map(cell, kinds), *extra, op.alias(OP), time.alias(TIME), F.col("lsn").alias(LSN))

    changes = changes.withColumn("_cells", F.when(F.col("kind") == "D", F.col("old")).otherwise(F.col("cells")))
    legs = [change("_cells", op_name(F.col("kind")))]
    if pk_change == "split":
        legs.append(F.when((F.col("kind") == "U") & F.col("old").isNotNull() & moved, change("old", F.lit("DELETE"))))
    return changes.select(F.inline(F.array_compact(F.array(*legs))))


def truncated(decoded: DataFrame) -> DataFrame:
    """TRUNCATE marks, off by default: ``relation_id, lsn`` per table; a caller may drop older rows by them."""
    return decoded.filter("kind = 'T'").select(F.explode("relations").alias("relation_id"), "lsn")


def parse_copy(data: bytes | Iterable[bytes]) -> Iterator[list[bytes | None]]:
    """SRC4: the rows of a binary copy stream, whole or cut into pieces anywhere; one row and one piece are held."""
    pieces, held, at = iter((data,) if isinstance(data, bytes) else data), b"", 0

    def take(n: int) -> bytes:
        nonlocal held, at
        if n < 0:
            raise Bad("cut off")
        if at + n > len(held):
            parts, have = [held[at:]], len(held) - at
            while have < n:
                if (piece := next(pieces, None)) is None:
                    raise Bad("cut off")
                parts.append(piece)
                have += len(piece)
            held, at = b"".join(parts), 0
        at += n
        return held[at - n : at]

    if take(11) != COPY_SIGNATURE:
        raise Bad("no copy stream")
    take(4)
    take(int.from_bytes(take(4), signed=True))
    while (n := int.from_bytes(take(2), signed=True)) != -1:
        fields: list[bytes | None] = []
        here, end = at, len(held)
        for _ in range(n):
            if here + 4 > end:
                break
            size, here = _SIZE(held, here)[0], here + 4
            if size < 0:
                fields.append(None)
                continue
            if here + size > end:
                break
            fields.append(held[here : here + size])
            here += size
        else:
            at = here
            yield fields
            continue
        # a row that the end of a piece cuts
        yield [None if (size := int.from_bytes(take(4), signed=True)) < 0 else take(size) for _ in range(n)]


def _copy_cells(sources: DataFrame, table: Table, streamed: bool) -> DataFrame:
    """``cells`` of copy streams: the one column holds their paths (``streamed``) or their bytes."""
    types = [base_type(c.data_type) for c in table.columns]

    def pieces(source: str | bytes) -> Iterator[bytes]:
        if not streamed:
            yield source
            return
        fs, at = filesystem(source)
        with fs.open_input_stream(at) as f:
            while piece := f.read(PIECE_BYTES):
                yield piece

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = [decoder(t) for t in types]

        def text(i: int, x: bytes | None) -> str | None:
            try:
                return None if x is None else read[i](x)
            except (struct.error, ValueError, OverflowError):
                return None

        for b in batches:
            for source in b.column(0):
                rows: list[list[str | None]] = []
                for fields in parse_copy(pieces(source.as_py())):
                    rows.append([text(i, fields[i]) if i < len(fields) else None for i in range(len(types))])
                    if len(rows) == 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["cells"])
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.string()))], ["cells"])

    return sources.mapInArrow(run, "cells array<string>")


def _snapshot(cells: DataFrame, table: Table, watermark: int) -> DataFrame:
    return with_metadata(cells.select(*[from_text(F.get("cells", F.lit(i)), c.data_type).alias(c.name) for i, c in enumerate(table.columns)]), "SNAPSHOT", 0, watermark)


def copy_rows(streams: DataFrame, table: Table, watermark: int) -> DataFrame:
    """SRC3-5: binary copy streams in column ``content``, a whole stream per row, as snapshot rows."""
    return _snapshot(_copy_cells(streams.select("content"), table, False), table, watermark)


def read_copy(spark: SparkSession, path: str | list[str], table: Table, watermark: int) -> DataFrame:
    """SRC3-5: binary copy files as snapshot rows. A field that its type can't be read from is null; a file that is cut off raises.

    A copy stream has no marks to begin in the middle at, so a file is one task; it is streamed piece by piece, so its size
    is not bounded by memory. A path that pyarrow has no filesystem for is read by Spark as whole files, of 2 GB at most.
    """
    listed = spark.read.format("binaryFile").load(path)
    try:
        filesystem(path if isinstance(path, str) else path[0])
        streamed = True
    except (pa.ArrowInvalid, OSError):
        streamed = False
    return _snapshot(_copy_cells(listed.select("path" if streamed else "content"), table, streamed), table, watermark)


# Encoding

_COUNT, _LENGTH, _NO_FIELD = struct.Struct(">h").pack, struct.Struct(">i").pack, b"\xff" * 4


def _cells(cells: Sequence) -> bytes:
    """None is null, ``...`` unchanged, anything else a text."""
    out = struct.pack(">H", len(cells))
    for c in cells:
        data = str(c).encode()
        out += b"n" if c is None else b"u" if c is ... else b"t" + struct.pack(">i", len(data)) + data
    return out


def relation(relation_id: int, table: str, columns: Sequence[tuple], schema: str = "public", identity: str = "d") -> bytes:
    """``columns``: (name, type id, is key)."""
    out = b"R" + struct.pack(">I", relation_id) + schema.encode() + b"\0" + table.encode() + b"\0" + identity.encode() + struct.pack(">H", len(columns))
    return out + b"".join(bytes((bool(key),)) + name.encode() + b"\0" + struct.pack(">Ii", oid, -1) for name, oid, key in columns)


def begin(final_lsn: int, xid: int, time: int = 0) -> bytes:
    return b"B" + struct.pack(">qqI", final_lsn, time, xid)


def commit(final_lsn: int, end_lsn: int, time: int = 0) -> bytes:
    return b"C\0" + struct.pack(">qqq", final_lsn, end_lsn, time)


def insert(relation_id: int, cells: Sequence) -> bytes:
    return b"I" + struct.pack(">I", relation_id) + b"N" + _cells(cells)


def update(relation_id: int, cells: Sequence, old: Sequence | None = None, old_kind: bytes = b"K") -> bytes:
    return b"U" + struct.pack(">I", relation_id) + (old_kind + _cells(old) if old is not None else b"") + b"N" + _cells(cells)


def delete(relation_id: int, old: Sequence, old_kind: bytes = b"K") -> bytes:
    return b"D" + struct.pack(">I", relation_id) + old_kind + _cells(old)


def truncate(relation_ids: Sequence[int]) -> bytes:
    return b"T" + struct.pack(">IB", len(relation_ids), 0) + b"".join(struct.pack(">I", r) for r in relation_ids)


def frame(lsn: int, payload: bytes) -> bytes:
    return b"w" + struct.pack(">qqq", lsn, lsn, 0) + payload


def copy_head() -> bytes:
    return COPY_SIGNATURE + struct.pack(">ii", 0, 0)


def copy_records(rows: Iterable[Sequence[bytes | None]]) -> bytes:
    """Rows of a copy stream, between its head and COPY_END; a long stream is written a batch of them at a time."""
    parts = []
    for r in rows:
        parts.append(_COUNT(len(r)))
        for x in r:
            if x is None:
                parts.append(_NO_FIELD)
            else:
                parts += _LENGTH(len(x)), x
    return b"".join(parts)


def copy_stream(rows: Iterable[Sequence[bytes | None]]) -> bytes:
    return copy_head() + copy_records(rows) + COPY_END


def status_update(lsn: int, time: int = 0, reply: bool = False) -> bytes:
    """SNK12: the position feedback message; received, flushed and applied are the committed position."""
    return b"r" + struct.pack(">qqqqB", lsn, lsn, lsn, time, reply)
