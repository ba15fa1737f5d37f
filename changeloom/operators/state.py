"""State of a keyed feed: the newest change of each key, now or at a position (WIN1-5, FLT2, FLT4).

One hash shuffle by key; the row_number filter is planned as a group limit on both sides of it, so what is shuffled is
about one row per key and task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .feed import LSN, OP, TIME


def newest_first(by: str = "lsn") -> list[Column]:
    """``lsn``: position, then time. ``timestamp``: time alone, ties by position so that the result is defined."""
    lsn, time = F.col(LSN).desc_nulls_last(), F.col(TIME).desc_nulls_last()
    return [lsn, time] if by == "lsn" else [time, lsn]


def newest(feed: DataFrame, keys: str | Sequence[str] = "id", by: str = "lsn") -> DataFrame:
    """The newest change of each key, deletes included."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first(by)))
    return feed.withColumn("_rn", rank).filter("_rn = 1").drop("_rn")


def latest_state(feed: DataFrame, keys: str | Sequence[str] = "id", by: str = "lsn", drop_deletes: bool = True) -> DataFrame:
    """WIN4: rows that are live. Without ``drop_deletes``, WIN3: a deleted key keeps its delete row."""
    out = newest(feed, keys, by)
    return out.filter(F.col(OP) != "DELETE") if drop_deletes else out


def as_of(feed: DataFrame, lsn: int, keys: str | Sequence[str] = "id") -> DataFrame:
    """The live rows at a position."""
    return latest_state(feed.filter(F.col(LSN) <= F.lit(lsn)), keys)


def history(feed: DataFrame, keys: str | Sequence[str] = "id") -> DataFrame:
    """Each change with the positions between which it holds: ``_valid_from``, ``_valid_to`` (null: still)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    w = Window.partitionBy(*keys).orderBy(F.asc(LSN), F.asc(TIME))
    return feed.withColumns({"_valid_from": F.col(LSN), "_valid_to": F.lead(LSN).over(w)})


def stats(state: DataFrame, value: str, scale: int = 2) -> DataFrame:
    """AGG1: row count and exact sum of a column of money."""
    return state.agg(F.count("*").alias("n"), F.sum(F.col(value).cast(f"decimal(18,{scale})")).cast("double").alias("total"))


def top_k(state: DataFrame, value: str, k: int = 5, key: str = "id") -> DataFrame:
    """SRT1: a bounded report; nulls last, ties by key."""
    return state.orderBy(F.col(value).desc_nulls_last(), F.col(key).asc_nulls_last()).limit(k)
