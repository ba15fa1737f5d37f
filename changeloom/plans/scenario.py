"""The end-to-end scenario of the audit: a snapshot, then transactions, a rollback, two added columns, updates, deletes, a second table.

The messages are computed from ranges, so that any number of inserts can be landed; scores are multiples of a quarter, so
that their sums are exact.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import catalog, wire

WATERMARK = 1_000_000
INSERTS = 10_000
MAIN = [("id", 23, True), ("name", 25, False), ("score", 701, False), ("is_active", 16, False), ("created_at", 1184, False)]
KNOWN = catalog.Table("public", "integration_test", (catalog.Column("id", "integer", key=True), catalog.Column("name"), catalog.Column("score", "double precision"), catalog.Column("is_active", "boolean"), catalog.Column("created_at", "timestamp with time zone")), 1)
#: Positions at which the steps begin; a step's messages follow each other by one.
DELETE, INSERT, SMALL, PRIORITY, TAGS, UPDATE, SECOND = (WATERMARK + x for x in (1_000, 2_000, 500_000, 600_000, 700_000, 800_000, 900_000))


def score(i: int) -> float:
    return (i * 37 % 400) / 4


def _cells(i: int, value: float, *more: object) -> list:
    return [i, f"row {i}", repr(value), "t", "2026-04-12 15:30:00+00", *more]


def _steps(first: int, last: int) -> Iterator[tuple[int, bytes]]:
    """The messages of numbers first..last-1; what happens once comes with number 0."""
    if first == 0:
        priority = [*MAIN, ("priority", 23, False)]
        yield WATERMARK, wire.relation(1, "integration_test", MAIN)
        yield WATERMARK - 1, wire.insert(1, [77, "stale", "1", "t", None])  # in the snapshot already
        yield from ((DELETE + i, wire.delete(1, [i, None, None, None, None])) for i in range(1, 101))
        # A rolled back transaction sends nothing.
        yield from ((SMALL + k, wire.insert(1, _cells(90_000 + k, 50.0))) for k in range(5))
        yield PRIORITY, wire.relation(1, "integration_test", priority)
        yield from ((PRIORITY + 1 + k, wire.insert(1, _cells(95_000 + k, 75.0, 1))) for k in range(5))
        yield TAGS, wire.relation(1, "integration_test", [*priority, ("tags", 25, False)])
        yield from ((TAGS + 1 + k, wire.insert(1, _cells(96_000 + k, 90.0, 1, "none"))) for k in range(5))
        yield TAGS + 50, wire.delete(1, [96_000, *[None] * 6])
        yield from ((UPDATE + i, wire.update(1, _cells(i, score(i) + 100, 0, "none"))) for i in range(101, 200))
        yield SECOND, wire.relation(2, "secondary_test", [("id", 23, True), ("note", 25, False), ("val", 23, False)])
        yield from ((SECOND + i, wire.insert(2, [i, f"Note {i}", i * 10])) for i in range(1, 11))
        yield SECOND + 50, b"I\0\0"  # can't be read
    yield from ((INSERT + i, wire.insert(1, _cells(101 + i, score(101 + i)))) for i in range(first, last))


def messages(spark: SparkSession, inserts: int = INSERTS) -> DataFrame:
    """``lsn, payload`` of all steps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("id").to_pylist()
            if ids:
                lsn, payload = zip(*_steps(ids[0], ids[-1] + 1))
                yield pa.RecordBatch.from_arrays([pa.array(lsn, pa.int64()), pa.array(payload, pa.binary())], ["lsn", "payload"])

    return spark.range(inserts).mapInArrow(run, "lsn long, payload binary")


def snapshot(spark: SparkSession) -> DataFrame:
    """The hundred rows that were there before, as rows of a binary copy stream."""
    rows = [[struct.pack(">i", i), f"Historical_{i}".encode(), struct.pack(">d", i * 1.5), b"\1", None] for i in range(1, 101)]
    return spark.createDataFrame([(wire.copy_stream(rows),)], "content binary")


def expected(spark: SparkSession, inserts: int = INSERTS) -> DataFrame:
    """``key, value``: the source's own figures at the end, replayed from the steps."""
    ids = F.col("id")
    own = spark.range(101, 101 + inserts).select(ids, (ids * 37 % 400 / 4 + F.when(ids < 200, 100.0).otherwise(0.0)).alias("score"))
    few = spark.sql("select * from values (90000L, 90005L, 50.0D), (95000L, 95005L, 75.0D), (96001L, 96005L, 90.0D) t(a, b, score)")
    own = own.union(few.select(F.explode(F.sequence("a", F.col("b") - 1)).alias("id"), "score"))
    found = own.agg(F.count("*").alias("n"), F.sum("score").alias("s"))
    figure = lambda key, value: F.struct(F.lit(key).alias("key"), value.alias("value"))
    return found.select(F.inline(F.array(figure("COUNT", F.col("n").cast("string")), figure("SUM", F.format_string("%.4f", "s")), figure("SECONDARY_COUNT", F.lit("10")))))
