"""Registered queries of the listing service on the driver's tables, each with its SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import merge as merges
from ..operators import serving
from .synth import table


def _stories(spark, sf_dir) -> DataFrame:
    """Orders as stories: half are ranked, some lack a score, each ninth is shown off."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        k.alias("id"),
        F.when(k % 9 == 0, F.concat(F.lit("show hn: "), F.col("o_orderpriority"))).otherwise(F.col("o_orderpriority")).alias("title"),
        F.when(k % 13 != 0, F.col("o_totalprice")).alias("score"),
        F.when(k % 11 != 0, F.col("o_orderdate").cast("timestamp")).alias("posted_at"),
        F.when(k % 2 == 0, (k * 7919 % 10007).cast("int")).alias("hn_rank"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )


_STORIES_SQL = """stories as (select o_orderkey as id, case when o_orderkey % 9 = 0 then 'show hn: ' || o_orderpriority else o_orderpriority end as title, case when o_orderkey % 13 <> 0 then o_totalprice end as score,
 case when o_orderkey % 11 <> 0 then o_orderdate end as posted_at, case when o_orderkey % 2 = 0 then cast(o_orderkey * 7919 % 10007 as integer) end as hn_rank, o_orderdate as created_at from orders)"""
_SHORT = ("id", "title", "score", "hn_rank")


def _page(strategy: str, limit: int, offset: int):
    def query(spark, sf_dir):
        return serving.listing(_stories(spark, sf_dir), strategy, limit, offset).select(*_SHORT)

    return query


def _page_sql(order: str, limit: int, offset: int, where: str = "true") -> str:
    return f"with {_STORIES_SQL} select id, title, score, hn_rank from (select * from stories where {where} order by {order}, id limit {limit} offset {offset})"


def listing_total(spark, sf_dir):
    s = _stories(spark, sf_dir)
    return serving.listing_total(s, "show").withColumnRenamed("total", "shown").join(F.broadcast(serving.listing_total(s)))  # one row each


def point_lookup(spark, sf_dir):
    return serving.by_key(table(spark, sf_dir, "orders"), "o_orderkey", 42).select("o_orderkey", "o_totalprice", F.coalesce("o_orderstatus", F.lit("")).alias("status"))


def comments_of_story(spark, sf_dir):
    c = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("story_id"), F.col("l_linenumber").alias("id"), F.col("l_shipdate").cast("timestamp").alias("posted_at"))
    return serving.comments_of(c, 33).select("story_id", "id")


def ranked_ids(spark, sf_dir):
    ids = table(spark, sf_dir, "nation").agg(F.sort_array(F.collect_list("n_nationkey"), asc=False).alias("all"))  # 25 nations
    return serving.ranked(ids.select(serving.first_ids(F.col("all"), 20).alias("ids")))


def _ranks(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").filter("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("id"), (F.col("o_orderkey") / 5 + 1).cast("int").alias("hn_rank")).union(spark.sql("select cast(-1 as bigint), 1"))


def update_ranks(spark, sf_dir):
    return serving.update_ranks(_stories(spark, sf_dir), _ranks(spark, sf_dir)).select("id", "hn_rank")


def clear_ranks_not_in(spark, sf_dir):
    return serving.clear_ranks_not_in(_stories(spark, sf_dir), _ranks(spark, sf_dir)).select("id", "hn_rank")


def set_flag(spark, sf_dir):
    s = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit(None).cast("boolean").alias("iframe_blocked"))
    return serving.set_flag(s, 42, True)


def prune_by_age(spark, sf_dir):
    return serving.prune_by_age(_stories(spark, sf_dir), 365, F.lit(datetime(1997, 1, 1))).select("id")


def exists_semi(spark, sf_dir):
    return serving.exists_in(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


def exists_anti(spark, sf_dir):
    return serving.exists_in(table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", present=False)


def thread_tree(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("id"), F.floor(F.col("o_orderkey") / 4).cast("long").alias("parent_id"))
    return serving.thread_tree(o, o.filter("id between 1 and 3"))


def item_filter(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.when(F.col("event_type") == "view", "story").otherwise("comment").alias("type"), F.when(F.col("event_id") % 3 == 0, True).alias("deleted"), (F.col("event_id") % 5 == 0).alias("dead"))
    return serving.live_items(e, "story").select("id", "type").unionByName(serving.live_items(e, "comment").select("id", "type"))


def upsert_subset(spark, sf_dir):
    """DML1-3: on conflict two columns change, the others stay."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("by"), F.col("o_totalprice").alias("score"), F.col("o_orderpriority").alias("title"))
    rows = o.filter("id % 3 = 0").select("id", F.lit("new").alias("by"), (F.col("score") + 1).alias("score"), F.lit("t").alias("title"))
    return merges.upsert(o.filter("id % 2 = 0"), rows, "id", ["score", "title"])


def settings_upsert(spark, sf_dir):
    old = table(spark, sf_dir, "region").select(F.col("r_name").alias("key"), F.lit("old").alias("value"))
    new = table(spark, sf_dir, "nation").select(F.col("n_name").alias("key"), F.lit("new").alias("value")).union(old.filter("key < 'B'").withColumn("value", F.lit("new")))
    return merges.upsert(old, new, "key", ["value"])


def added_column(spark, sf_dir):
    """DML7: an added column with a default."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return c if "priority" in c.columns else c.withColumn("priority", F.lit(0))


def unix_times(spark, sf_dir):
    from ..functions.text import from_unix

    return table(spark, sf_dir, "events").select("event_id", F.unix_seconds(from_unix(F.col("event_id"))).alias("s"))


QUERIES = {
    "listing_rank": (_page("rank", 20, 0), _page_sql("hn_rank asc nulls last", 20, 0)),
    "listing_votes": (_page("votes", 20, 0), _page_sql("score desc nulls first", 20, 0)),
    "listing_latest": (_page("latest", 20, 0), _page_sql("posted_at desc nulls first", 20, 0)),
    "listing_ilike": (_page("show", 20, 0), _page_sql("posted_at desc nulls first", 20, 0, "title ilike 'Show HN:%'")),
    "listing_page": (_page("rank", 30, 60), _page_sql("hn_rank asc nulls last", 30, 60)),
    "listing_total": (listing_total, f"with {_STORIES_SQL} select count(*) filter (title ilike 'Show HN:%') as shown, count(*) as total from stories"),
    "point_lookup": (point_lookup, "select o_orderkey, o_totalprice, coalesce(o_orderstatus, '') as status from orders where o_orderkey = 42"),
    "comments_of_story": (comments_of_story, "select l_orderkey as story_id, l_linenumber as id from lineitem where l_orderkey = 33"),
    "ranked_ids": (ranked_ids, "select n_nationkey as id, cast(row_number() over (order by n_nationkey desc) as integer) as hn_rank from nation qualify hn_rank <= 20"),
    "update_ranks": (update_ranks, f"with {_STORIES_SQL} select id, case when id % 5 = 0 then cast(id // 5 + 1 as integer) else hn_rank end as hn_rank from stories"),
    "clear_ranks_not_in": (clear_ranks_not_in, f"with {_STORIES_SQL} select id, case when id % 5 = 0 then hn_rank end as hn_rank from stories"),
    "set_flag": (set_flag, "select o_orderkey as id, case when o_orderkey = 42 then true end as iframe_blocked from orders"),
    "prune_by_age": (prune_by_age, f"with {_STORIES_SQL} select id from stories where not (created_at < timestamp '1997-01-01' - interval 365 day)"),
    "exists_semi": (exists_semi, "select c_custkey from customer where exists (select 1 from orders where o_custkey = c_custkey)"),
    "exists_anti": (exists_anti, "select c_custkey from customer where not exists (select 1 from orders where o_custkey = c_custkey)"),
    "thread_tree": (
        thread_tree,
        """with recursive o as (select cast(o_orderkey as bigint) as id, cast(floor(o_orderkey / 4) as bigint) as parent_id from orders),
        tree as (select id, id as root, 0 as depth from o where id between 1 and 3 union all select o.id, t.root, t.depth + 1 from tree t join o on o.parent_id = t.id and o.id <> t.id) select id, root, depth from tree""",
    ),
    "item_filter": (item_filter, "select event_id as id, case when event_type = 'view' then 'story' else 'comment' end as type from events where event_type = 'view' or (event_id % 3 <> 0 and event_id % 5 <> 0)"),
    "upsert_subset": (
        upsert_subset,
        """select o_orderkey as id, case when o_orderkey % 2 = 0 then o_orderstatus else 'new' end as "by", case when o_orderkey % 3 = 0 then o_totalprice + 1 else o_totalprice end as score, case when o_orderkey % 3 = 0 then 't' else o_orderpriority end as title from orders where o_orderkey % 2 = 0 or o_orderkey % 3 = 0""",
    ),
    "settings_upsert": (settings_upsert, "select r_name as key, case when r_name < 'B' then 'new' else 'old' end as value from region union all select n_name, 'new' from nation"),
    "added_column": (added_column, "select c_custkey as id, 0 as priority from customer"),
    "unix_times": (unix_times, "select event_id, event_id as s from events"),
}
