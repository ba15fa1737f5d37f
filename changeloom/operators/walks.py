"""Walks down a hierarchy of any depth and size, by doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.files import scratch


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def descendants(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """``id, root, depth``: the roots (column ``id``) at depth 0, and a row per walk from a root along ``edges`` (id, up).

    Each round doubles the length: what lies less than n steps below a root is known, as are the walks of n steps
    between any two ids, and both together give what lies less than 2 n steps below. So a chain takes as many rounds
    as the logarithm of its length, and no count of rows or levels ends the search. Each round is written to the
    shared folder. A loop below a root has no end and raises ``ValueError``.
    """
    spark = edges.sparkSession
    folder, n = scratch(spark, "walks"), 1
    steps = _written(edges.select("id", "up").filter("id is not null and up is not null"), f"{folder}/steps-{n}")
    ids = steps.select("id").union(steps.select("up")).distinct().count()
    found = [_written(roots.select("id", F.col("id").alias("root"), F.lit(0).cast("long").alias("depth")), f"{folder}/found-0")]
    while not steps.isEmpty():
        known = found[0]
        for more in found[1:]:
            known = known.union(more)
        below = known.select(F.col("id").alias("up"), "root", "depth")
        new = _written(steps.join(below, "up").select("id", "root", (F.col("depth") + n).alias("depth")), f"{folder}/found-{n}")
        # A walk that comes back to its root, or that has more steps than there are ids, has met an id twice.
        if not new.filter((F.col("id") == F.col("root")) | (F.col("depth") >= ids)).isEmpty():
            raise ValueError("the hierarchy has a loop below a root")
        found.append(new)
        if n >= ids:  # loops that no root leads to
            break
        upper = steps.select(F.col("id").alias("up"), F.col("up").alias("top"))
        n *= 2
        steps = _written(steps.join(upper, "up").select("id", F.col("top").alias("up")), f"{folder}/steps-{n}")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out
