"""Source types: one table from a source type's name to its Spark type, its text form and its binary form.

Texts become typed values by ``try_cast``, so a bad text is null and never stops a batch (FN1, FN2). Binary fields are
turned into the text that the text protocol would send, so both wire formats share one typed projection.
"""

from __future__ import annotations

import base64
import json
import re
import struct
import uuid
from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Microseconds from 1970-01-01 to 2000-01-01, where the source's clock begins.
PG_EPOCH_US = 946_684_800_000_000

#: The names under which the source lists its types, and the Spark types they land in. All others land as text.
SPARK_TYPES: dict[str, T.DataType] = {
    "integer": T.IntegerType(), "int4": T.IntegerType(), "serial": T.IntegerType(),
    "bigint": T.LongType(), "int8": T.LongType(), "bigserial": T.LongType(),
    "real": T.FloatType(), "float4": T.FloatType(),
    "double precision": T.DoubleType(), "float8": T.DoubleType(), "numeric": T.DoubleType(),
    "boolean": T.BooleanType(), "bool": T.BooleanType(),
}
#: Type identifiers on the wire.
TYPE_OIDS = {16: "boolean", 17: "bytea", 20: "bigint", 21: "smallint", 23: "integer", 25: "text", 114: "json", 700: "real", 701: "double precision", 1007: "integer[]", 1043: "character varying", 1082: "date", 1114: "timestamp without time zone", 1184: "timestamp with time zone", 1700: "numeric", 2950: "uuid", 3802: "jsonb"}
TIMESTAMPS = ("timestamp with time zone", "timestamptz", "timestamp")


def base_type(name: str) -> str:
    """A listed type's name in lower case, without spaces at its ends (FN14). ``numeric(10,2)`` stays apart from ``numeric``."""
    return re.sub(r"\s+", " ", name.strip().lower())


def spark_type(name: str, exact_numeric: bool = False) -> T.DataType:
    """The Spark type of a source type; ``exact_numeric`` lands numerics as decimals instead of doubles or text."""
    name = base_type(name)
    if exact_numeric and (m := re.fullmatch(r"numeric(?:\((\d+)(?:, ?(\d+))?\))?", name)):
        return T.DecimalType(min(int(m[1]), 38), int(m[2] or 0)) if m[1] else T.DecimalType(38, 18)
    return SPARK_TYPES.get(name, T.StringType())


#: Each type with those that it can be widened to.
_WIDER = ["integer", "long", "double", "string"]


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """int, long, double, string in this order; other types that differ become string."""
    if a == b:
        return a
    names = [x.typeName() for x in (a, b)]
    if "float" in names:
        names = ["double" if n == "float" else n for n in names]
    if all(n in _WIDER for n in names):
        return {"integer": T.IntegerType(), "long": T.LongType(), "double": T.DoubleType(), "string": T.StringType()}[max(names, key=_WIDER.index)]
    return T.StringType()


def from_text(cell: Column, name: str, exact_numeric: bool = False) -> Column:
    """A text cell as a typed value; what can't be read is null."""
    kind = spark_type(name, exact_numeric)
    if isinstance(kind, T.BooleanType):
        return F.when(cell.isNotNull(), cell.isin("t", "true", "1"))
    return cell if isinstance(kind, T.StringType) else cell.try_cast(kind)


def normalised_timestamp(text: Column) -> Column:
    """Both text forms of a time as a timestamp (FN4): digits are microseconds since 2000, anything else is a date and time."""
    micros = F.timestamp_micros(text.try_cast("long") + F.lit(PG_EPOCH_US))
    return F.when(text.rlike(r"^-?\d+$"), micros).otherwise(F.try_to_timestamp(text))


def int_array(text: Column) -> Column:
    """``{1,2,NULL}`` as array<int> (FN17)."""
    inner = F.regexp_replace(text, r"[{}\s]", "")
    return F.when(text.isNull(), None).when(inner == "", F.array().cast("array<int>")).otherwise(F.transform(F.split(inner, ","), lambda x: x.try_cast("int")))


def parse_lsn(text: Column) -> Column:
    """``16/B374D848`` as a long (FN5): the high half of 32 bits, a slash, the low half, both hexadecimal."""
    half = lambda i: F.conv(F.split(text, "/")[i], 16, 10).cast("long")
    return F.when(text.rlike(r"^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$"), F.shiftleft(half(0), 32) + half(1))


def format_lsn(lsn: Column) -> Column:
    return F.concat(F.hex(F.shiftrightunsigned(lsn, 32)), F.lit("/"), F.hex(lsn.bitwiseAND(F.lit(0xFFFFFFFF))))


def op_name(code: Column) -> Column:
    """Message kind to the name of the change (FN6)."""
    return F.when(code == "I", "INSERT").when(code == "U", "UPDATE").when(code == "D", "DELETE").when(code == "S", "SNAPSHOT").when(code == "T", "TRUNCATE").otherwise("UNKNOWN")


def version_file(version: int) -> str:
    """A commit's file name: the version in 20 digits (FN7)."""
    return f"{version:020d}.json"


# Binary forms -> text


def _numeric(b: bytes) -> str:
    n, weight, sign, scale = struct.unpack(">hhHH", b[:8])
    if sign == 0xC000:
        return "NaN"
    if sign in (0xD000, 0xF000):
        return "Infinity" if sign == 0xD000 else "-Infinity"
    digits = struct.unpack(f">{n}h", b[8 : 8 + 2 * n])
    whole = "".join(f"{digits[i] if i < n else 0:04d}" for i in range(weight + 1)).lstrip("0") or "0"
    tail = "".join(f"{digits[i] if 0 <= i < n else 0:04d}" for i in range(weight + 1, weight + 1 + -(-scale // 4)))[:scale] if scale else ""
    return ("-" if sign == 0x4000 else "") + whole + ("." + tail if scale else "")


def _array(b: bytes) -> str:
    dims, _, oid = struct.unpack(">iiI", b[:12])
    if dims == 0:
        return "{}"
    if dims != 1:
        raise ValueError("only arrays of one dimension are read")
    n, at, out = struct.unpack(">i", b[12:16])[0], 20, []
    item = decoder(TYPE_OIDS.get(oid, "text"))
    for _ in range(n):
        size = struct.unpack(">i", b[at : at + 4])[0]
        at += 4
        if size < 0:
            out.append("NULL")
        else:
            text = item(b[at : at + size])
            out.append(json.dumps(text, ensure_ascii=False) if re.search(r'[{},"\\\s]', text) or text in ("", "NULL") else text)
            at += size
    return "{" + ",".join(out) + "}"


def _sized(form: str) -> Callable[[bytes], str | None]:
    size = struct.calcsize(form)
    return lambda b: repr(struct.unpack(form, b)[0]) if len(b) == size else None


def _text(b: bytes) -> str:
    return b.decode("utf-8", "replace")


#: Source type -> binary field to text. A field of a wrong size is null.
BINARY: dict[str, Callable[[bytes], str | None]] = (
    dict.fromkeys(("integer", "int4", "serial"), _sized(">i"))
    | dict.fromkeys(("bigint", "int8", "bigserial"), _sized(">q"))
    | dict.fromkeys(("smallint", "int2"), _sized(">h"))
    | dict.fromkeys(("real", "float4"), _sized(">f"))
    | dict.fromkeys(("double precision", "float8"), _sized(">d"))
    | dict.fromkeys(("boolean", "bool"), lambda b: ("t" if b[0] else "f") if len(b) == 1 else None)
    | dict.fromkeys((*TIMESTAMPS, "timestamp without time zone"), _sized(">q"))
    | {
        "date": lambda b: (date(2000, 1, 1) + timedelta(days=struct.unpack(">i", b)[0])).isoformat() if len(b) == 4 else None,
        "uuid": lambda b: str(uuid.UUID(bytes=b)) if len(b) == 16 else None,
        "jsonb": lambda b: _text(b[1:]),
        "bytea": lambda b: "\\x" + b.hex(),
        "numeric": _numeric,
    }
    | dict.fromkeys(("text", "json", "name", "character varying", "character"), _text)
)


def decoder(name: str) -> Callable[[bytes], str | None]:
    """The binary decoder of a source type; an unknown type's bytes become base64."""
    name = base_type(name)
    if name.endswith("[]"):
        return _array
    return BINARY.get(re.sub(r"\(.*\)", "", name).strip(), lambda b: base64.b64encode(b).decode())
