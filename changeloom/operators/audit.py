"""Audit of reconstructed state against the source's own figures: one row per check, one pass over the feed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .feed import OP
from .state import latest_state


def read_expected(spark, path: str) -> DataFrame:
    """SRC15: lines ``KEY=value`` as ``key, value``."""
    parts = F.split("value", "=", 2)
    return spark.read.text(path).filter(F.col("value").contains("=")).select(F.trim(parts[0]).alias("key"), F.trim(parts[1]).alias("value"))


def write_results(results: DataFrame, path: str) -> None:
    """SNK10: rows ``key, value`` as lines ``KEY=value``; Spark's success mark in the folder says that all are there."""
    results.select(F.concat_ws("=", F.col("key").cast("string"), F.coalesce(F.col("value").cast("string"), F.lit("")))).coalesce(1).write.mode("overwrite").text(path)


def audit(feed: DataFrame, *, key: str = "id", value: str = "score", count: int, total: float, secondary: DataFrame | None = None, secondary_count: int = 0, leaked: tuple[int, int] = (80000, 80009), snapshots: int = 100, deletes: int | None = None, evolved: tuple[str, ...] = ("priority", "tags"), tolerance: float = 0.1) -> DataFrame:
    """``check, actual, expected, passed`` of the seven checks (AGG1-3, AGG12, FLT2-3)."""
    spark = feed.sparkSession
    live = latest_state(feed, key).agg(F.count("*").cast("double").alias("n"), F.coalesce(F.sum(value), F.lit(0.0)).cast("double").alias("s"))
    raw = feed.agg(
        F.count_if(F.col(key).between(*leaked)).cast("double").alias("leak"),
        F.count_if(F.col(OP) == "SNAPSHOT").cast("double").alias("snap"),
        F.count_if(F.col(OP) == "DELETE").cast("double").alias("dels"),
    )
    second = latest_state(secondary, key, drop_deletes=False).agg(F.count("*").cast("double").alias("sec")) if secondary is not None else spark.range(1).select(F.lit(0.0).alias("sec"))
    one = live.join(F.broadcast(raw)).join(F.broadcast(second))  # one row each
    have = float(sum(c in feed.columns for c in evolved))
    rows = [
        ("row_count", F.col("n"), float(count), F.col("n") == count),
        ("value_sum", F.col("s"), float(total), F.abs(F.col("s") - total) <= tolerance),
        ("secondary_count", F.col("sec"), float(secondary_count), F.col("sec") == secondary_count),
        ("rollback_leak", F.col("leak"), 0.0, F.col("leak") == 0),
        ("snapshot_rows", F.col("snap"), float(snapshots), F.col("snap") >= snapshots),
        ("schema_evolution", F.lit(have), float(len(evolved)), F.lit(have == len(evolved))),
    ]
    if deletes is not None:
        rows.append(("delete_rows", F.col("dels"), float(deletes), F.col("dels") == deletes))
    checks = F.array(*[F.struct(F.lit(n).alias("check"), a.alias("actual"), F.lit(e).alias("expected"), p.alias("passed")) for n, a, e, p in rows])
    return one.select(F.inline(checks))


def report(checks: DataFrame) -> bool:
    """SNK11: prints the checks, a row each, and says whether all have passed."""
    checks.orderBy("check").show(100, truncate=False)
    return checks.filter(~F.coalesce(F.col("passed"), F.lit(False))).isEmpty()
