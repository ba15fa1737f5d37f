"""Connected components by alternating large-star and small-star steps, with joins and partial minima only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, unstage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link what each node sees to the smallest node of its neighbourhood: the larger neighbours, or the smaller ones and itself."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        out = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:  # v < u on every row
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _digest(edges: DataFrame) -> tuple:
    """Number and combined hash of the distinct edges: equal when a round has changed nothing."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges``: two long columns a and b. Returns ``id, component`` (the smallest id reachable) for every id on an edge.

    Null ends and loops are ignored; no edges give no rows. No neighbour list is ever gathered: each step is a
    minimum with partial aggregation and a join that adaptive execution can split. Each round is written to the shared folder.
    """
    now = stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u is not null and v is not null and u <> v").distinct(), "cc"
    )
    seen = _digest(now)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        new = stage(_star(_star(now, True), False), "cc")
        unstage(now)
        now, before, seen = new, seen, _digest(new)
        if seen == before:
            break
    else:
        raise RuntimeError("the components did not settle")
    leaves = now.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return stage(leaves.union(roots), "cc")
