"""Queries and changes of the listing service (SRT3-6, FLT7-10, J5-8, AGG6, DML5-6).

Null orders follow the service's database: descending puts nulls first, ascending last. A key breaks ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .walks import descendants

#: How each listing is ordered; ``rank`` is the default.
STRATEGIES = ("rank", "votes", "latest", "show")


def listing_filter(stories: DataFrame, strategy: str, title: str = "title") -> DataFrame:
    """FLT7: the show listing has titles that begin with ``Show HN:`` in any case."""
    return stories.filter(F.col(title).ilike("Show HN:%")) if strategy == "show" else stories


def listing(stories: DataFrame, strategy: str = "rank", limit: int = 20, offset: int = 0, *, key: str = "id", title: str = "title", rank: str = "hn_rank", score: str = "score", posted: str = "posted_at") -> DataFrame:
    """SRT3-5: one page of a listing."""
    order = {"votes": F.col(score).desc_nulls_first(), "latest": F.col(posted).desc_nulls_first(), "show": F.col(posted).desc_nulls_first()}.get(strategy, F.col(rank).asc_nulls_last())
    return listing_filter(stories, strategy, title).orderBy(order, F.col(key).asc()).offset(offset).limit(limit)


def listing_total(stories: DataFrame, strategy: str = "rank", title: str = "title") -> DataFrame:
    """AGG6: how many rows the listing has in all."""
    return listing_filter(stories, strategy, title).agg(F.count("*").alias("total"))


def by_key(rows: DataFrame, column: str, value: object) -> DataFrame:
    """FLT8: pushed down to the scan."""
    return rows.filter(F.col(column) == F.lit(value))


def comments_of(comments: DataFrame, story: object) -> DataFrame:
    """SRT6."""
    return by_key(comments, "story_id", story).orderBy(F.col("posted_at").asc_nulls_last(), F.col("id"))


def ranked(ids: DataFrame, column: str = "ids") -> DataFrame:
    """WIN6: ranks 1, 2, ... of a list of ids."""
    return ids.select(F.posexplode(column).alias("_at", "id")).select("id", (F.col("_at") + 1).alias("hn_rank"))


def first_ids(ids: Column, n: int) -> Column:
    """SRT7."""
    return F.slice(ids, 1, n)


def update_ranks(stories: DataFrame, ranks: DataFrame, key: str = "id", rank: str = "hn_rank") -> DataFrame:
    """J6: stories named in ``ranks`` (key, rank) get that rank; unknown ids change nothing."""
    new = ranks.select(F.col(key).alias("_key"), F.struct(F.col(rank).alias("r")).alias("_new"))
    joined = stories.join(new, F.col(key) == F.col("_key"), "left")
    return joined.select(*[(F.when(F.col("_new").isNotNull(), F.col("_new.r")).otherwise(F.col(rank)).alias(rank) if c == rank else F.col(c)) for c in stories.columns])


def clear_ranks_not_in(stories: DataFrame, ids: DataFrame, key: str = "id", rank: str = "hn_rank") -> DataFrame:
    """J8, FLT9: ranked stories that ``ids`` doesn't name lose their rank; no ids change nothing."""
    named = ids.select(F.col(key).alias("_key")).filter("_key is not null").distinct().withColumn("_named", F.lit(True))
    some = named.agg(F.count("*").alias("_n"))
    joined = stories.join(named, F.col(key) == F.col("_key"), "left").join(F.broadcast(some))  # one row
    return joined.select(*[(F.when(F.col("_named").isNotNull() | (F.col("_n") == 0), F.col(rank)).alias(rank) if c == rank else F.col(c)) for c in stories.columns])


def set_flag(stories: DataFrame, key_value: object, value: bool | None, key: str = "id", flag: str = "iframe_blocked") -> DataFrame:
    """DML5."""
    return stories.withColumn(flag, F.when(F.col(key) == F.lit(key_value), F.lit(value)).otherwise(F.col(flag)))


def update_where(rows: DataFrame, where: Column, values: dict[str, Column]) -> DataFrame:
    """DML8, FLT11: rows for which ``where`` holds get the values; a null condition changes nothing."""
    hit = F.coalesce(where, F.lit(False))
    return rows.select(*[F.when(hit, values[c].cast(kind)).otherwise(F.col(f"`{c}`")).alias(c) if c in values else F.col(f"`{c}`") for c, kind in rows.dtypes])


def delete_where(rows: DataFrame, where: Column) -> DataFrame:
    """DML8, FLT11: what is left; a null condition deletes nothing."""
    return rows.filter(~F.coalesce(where, F.lit(False)))


def prune_by_age(stories: DataFrame, days: int, now: Column, created: str = "created_at") -> DataFrame:
    """DML6, FLT10: what is left when rows older than ``days`` go; rows without a time stay."""
    return stories.filter(~F.coalesce(F.col(created) < now - F.make_dt_interval(F.lit(days)), F.lit(False)))


def exists_in(rows: DataFrame, others: DataFrame, key: str, present: bool = True) -> DataFrame:
    """J7."""
    return rows.join(others.select(F.col(key).alias("_k")).distinct(), F.col(key) == F.col("_k"), "left_semi" if present else "left_anti")


def thread_tree(items: DataFrame, roots: DataFrame, key: str = "id", parent: str = "parent_id") -> DataFrame:
    """J5: ``id, root, depth`` of all that hangs below the roots, however deep; an item that is its own parent hangs below nothing."""
    edges = items.filter(F.col(parent) != F.col(key)).select(F.col(key).alias("id"), F.col(parent).alias("up"))
    return descendants(edges, roots.select(F.col(key).alias("id"))).select("id", "root", F.col("depth").cast("int").alias("depth"))


def live_items(items: DataFrame, kind: str) -> DataFrame:
    """FLT12: items of a kind; comments that are deleted or dead go."""
    out = items.filter(F.col("type") == kind)
    return out if kind != "comment" else out.filter(~F.coalesce(F.col("deleted"), F.lit(False)) & ~F.coalesce(F.col("dead"), F.lit(False)))
