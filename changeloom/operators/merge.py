"""Merging a batch of changes into keyed state (SNK8, J2, DML1-4).

Modes. ``snapshot_aware`` (default): the newest change of each key wins if it is not older than the state's row; snapshots
insert. ``strict_ops``: a matched UPDATE replaces, a matched DELETE deletes, a matched INSERT or SNAPSHOT changes nothing; an
unmatched INSERT or UPDATE inserts, anything else unmatched does nothing.

The target is keyed state with ``_cdc_lsn``; null keys never match.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .feed import LSN, OP, TIME
from .state import newest

DELETED = "_deleted"
UNCHANGED = "_cdc_unchanged"


def batch_of(changes: DataFrame, keys: str | Sequence[str] = "id", mode: str = "snapshot_aware") -> DataFrame:
    """One change per key; ``strict_ops`` orders by time first."""
    return newest(changes, keys, "timestamp" if mode == "strict_ops" else "lsn")


def plan_merge(target: DataFrame, changes: DataFrame, key: str = "id", mode: str = "snapshot_aware", tombstones: bool = False) -> DataFrame:
    """The state after ``changes``, as one full outer join by key.

    With ``tombstones`` a deleted key keeps a row with ``_deleted`` true and its position, so that an older change that
    comes in a later batch can't bring it back; the target then has that column too. A column named in a change's
    ``_cdc_unchanged`` keeps the target's value.
    """
    if mode not in ("snapshot_aware", "strict_ops"):
        raise ValueError(f"unknown mode {mode!r}")
    source = batch_of(changes, key, mode)
    columns = [c for c in target.columns if c not in (key, LSN, DELETED)]
    unchanged = UNCHANGED in source.columns
    t = target.select(F.col(key).alias("_t_key"), F.struct(*[F.col(f"`{c}`") for c in target.columns]).alias("_t"))
    s = source.select(F.col(key).alias("_s_key"), F.struct(*[F.col(f"`{c}`") for c in source.columns]).alias("_s"))
    both = t.join(s, F.col("_t_key") == F.col("_s_key"), "full_outer")
    old, new = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    op, lsn = F.col(f"_s.{OP}"), F.col(f"_s.{LSN}")

    if mode == "strict_ops":
        take = (old & (op == "UPDATE")) | (~old & op.isin("INSERT", "UPDATE"))
        drop = op == "DELETE"
        live = ~new | (old & ~drop) | (~old & op.isin("INSERT", "UPDATE"))
    else:
        fresh = ~old | (lsn >= F.col(f"_t.{LSN}"))
        # A snapshot row at the position of a change is older than it.
        fresh = fresh & ~(old & (op == "SNAPSHOT") & (lsn == F.col(f"_t.{LSN}")))
        take = new & fresh & (op != "DELETE")
        drop = new & fresh & (op == "DELETE")
        live = F.lit(True) if tombstones else ~F.coalesce(drop, F.lit(False)) & (old | (op != "DELETE"))
    take, drop = F.coalesce(take, F.lit(False)), F.coalesce(drop, F.lit(False))

    def value(c: str) -> Column:
        after = F.col(f"_s.`{c}`") if c in source.columns else F.lit(None)
        if unchanged:
            after = F.when(old & F.coalesce(F.array_contains(F.col(f"_s.{UNCHANGED}"), c), F.lit(False)), F.col(f"_t.`{c}`")).otherwise(after)
        return F.when(take, after).otherwise(F.col(f"_t.`{c}`")).alias(c)

    out = [F.coalesce("_t_key", "_s_key").alias(key), *[value(c) for c in columns]]
    out.append(F.when(take | (drop if tombstones else F.lit(False)), lsn).otherwise(F.col(f"_t.{LSN}")).alias(LSN))
    if tombstones:
        out.append(F.when(take, False).when(drop, True).otherwise(F.col(f"_t.{DELETED}")).alias(DELETED))
    by_name = {c: e for c, e in zip([key, *columns, LSN, DELETED], out)}
    order = [c for c in target.columns] + ([DELETED] if tombstones and DELETED not in target.columns else [])
    return both.filter(F.coalesce(live, F.lit(True))).select(*[by_name[c] for c in order])


def visible(state: DataFrame) -> DataFrame:
    """State without its tombstones."""
    return state.filter(~F.coalesce(F.col(DELETED), F.lit(False))).drop(DELETED) if DELETED in state.columns else state


def empty_state(feed: DataFrame, tombstones: bool = False) -> DataFrame:
    """SNK7: an empty table with the feed's columns without op and time, as the merge expects it."""
    out = feed.drop(OP, TIME, UNCHANGED).limit(0)
    return out.withColumn(DELETED, F.lit(False)) if tombstones else out


def upsert(target: DataFrame, rows: DataFrame, key: str, update: Sequence[str], touch: dict[str, Column] | None = None) -> DataFrame:
    """DML1-4: on conflict by key only the columns in ``update`` are overwritten; new keys are inserted.

    ``touch`` gives expressions for columns that are set on every written row. A key occurs once in ``rows``.
    """
    touch = touch or {}
    t = target.select(F.col(key).alias("_t_key"), F.struct(*[F.col(f"`{c}`") for c in target.columns]).alias("_t"))
    s = rows.select(F.col(key).alias("_s_key"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_s"))
    both = t.join(s, F.col("_t_key") == F.col("_s_key"), "full_outer")
    old, new = F.col("_t").isNotNull(), F.col("_s").isNotNull()
    out = []
    for c in target.columns:
        after = touch[c] if c in touch else F.col(f"_s.`{c}`") if c in rows.columns else F.lit(None)
        write = new if c in update or c in touch else new & ~old
        out.append((F.coalesce("_t_key", "_s_key") if c == key else F.when(write, after).otherwise(F.col(f"_t.`{c}`"))).alias(c))
    return both.select(*out)
