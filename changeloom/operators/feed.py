"""The change feed: metadata columns, the handover between snapshot and stream, and filters on it.

A change row has the source's columns and ``_cdc_op``, ``_cdc_timestamp`` (microseconds; 0 for snapshot rows, so any
later change is newer) and ``_cdc_lsn`` (a signed long).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OP, TIME, LSN = "_cdc_op", "_cdc_timestamp", "_cdc_lsn"
META = (OP, TIME, LSN)


def with_metadata(df: DataFrame, op: Column | str, timestamp: Column | int, lsn: Column | int) -> DataFrame:
    """PRJ1: adds the three metadata columns."""
    col = lambda x: x if isinstance(x, Column) else F.lit(x)
    return df.withColumns({OP: col(op).cast("string"), TIME: col(timestamp).cast("long"), LSN: col(lsn).cast("long")})


def snapshot_rows(df: DataFrame, watermark: int) -> DataFrame:
    """SRC3: a table's rows as snapshot changes at the watermark."""
    return with_metadata(df, "SNAPSHOT", 0, watermark)


def without_metadata(df: DataFrame, keep_lsn: bool = False) -> DataFrame:
    """PRJ2."""
    return df.drop(OP, TIME) if keep_lsn else df.drop(*META)


def handover_guard(feed: DataFrame, watermark: int) -> DataFrame:
    """FLT1: streamed rows below the watermark are in the snapshot already; rows at the watermark stay."""
    return feed.filter((F.col(OP) == "SNAPSHOT") | (F.col(LSN) >= F.lit(watermark)))


def united(*feeds: DataFrame) -> DataFrame:
    """SET1, SET2: one log of several feeds, by column name; columns that a feed lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def committed_only(feed: DataFrame, commits: DataFrame, xid: str = "xid") -> DataFrame:
    """Rows whose transaction has a commit marker; snapshot rows have no transaction and stay."""
    marks = commits.select(F.col(xid).alias("_committed")).distinct()
    changes = feed.filter(F.col(OP) != "SNAPSHOT").join(marks, F.col(xid) == F.col("_committed"), "left_semi")
    return feed.filter(F.col(OP) == "SNAPSHOT").unionByName(changes)


def op_counts(feed: DataFrame) -> DataFrame:
    """AGG9."""
    return feed.groupBy(OP).agg(F.count("*").alias("n"))


def max_lsn(feed: DataFrame) -> DataFrame:
    """AGG7."""
    return feed.agg(F.max(LSN).alias("max_lsn"))


def barrier(flushed: DataFrame, epoch: int, column: str = "epoch") -> DataFrame:
    """AGG8: whether every table has flushed the epoch; no tables have flushed nothing."""
    return flushed.agg(F.coalesce(F.min(column) >= F.lit(epoch), F.lit(False)).alias("complete"))
