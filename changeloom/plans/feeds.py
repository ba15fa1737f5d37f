"""Registered queries over change feeds and state, each with its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit as audits
from ..operators import feed as feeds
from ..operators import merge as merges
from ..operators import state as states
from ..sources.files import scratch
from ..sources.txlog import ChangeTable
from ..streaming.runs import run_silver, silver_view
from .synth import EVENTS_FEED_SQL, ORDERS_FEED_SQL, WATERMARK, events_feed, orders_feed, table


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_feed(table(spark, sf_dir, "orders"))


def _guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.handover_guard(_feed(spark, sf_dir), WATERMARK)


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_feed(table(spark, sf_dir, "events"))


SPLIT_SQL = "(select cast(floor((min(event_id) + max(event_id) + 1) / 2) as bigint) from events)"


def _halves(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The events feed as two batches; the cut is a scalar subquery, so the filters reach the scan."""
    feed = _events(spark, sf_dir)
    cut = feed.agg(F.floor((F.min("_cdc_lsn") + F.max("_cdc_lsn") + 1) / 2).cast("long").alias("cut")).scalar()
    return feed.filter(F.col("_cdc_lsn") < cut), feed.filter(F.col("_cdc_lsn") >= cut)


def feed_op_counts(spark, sf_dir):
    return feeds.op_counts(_guarded(spark, sf_dir))


def feed_max_lsn(spark, sf_dir):
    return feeds.max_lsn(_guarded(spark, sf_dir))


def handover_guard(spark, sf_dir):
    return _guarded(spark, sf_dir)


def snapshot_stream_union(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    snap = feeds.snapshot_rows(orders.filter("id % 2 = 0"), WATERMARK)
    live = feeds.with_metadata(orders.filter("id % 2 = 1"), "INSERT", F.col("id") + 7, F.col("id") + 2_000_000)
    return feeds.without_metadata(feeds.united(snap, live), keep_lsn=True)


def latest_state(spark, sf_dir):
    return states.latest_state(_guarded(spark, sf_dir))


def latest_state_with_deletes(spark, sf_dir):
    return states.latest_state(_guarded(spark, sf_dir), drop_deletes=False)


def latest_state_by_ts(spark, sf_dir):
    return states.latest_state(_guarded(spark, sf_dir), by="timestamp", drop_deletes=False)


def latest_stats(spark, sf_dir):
    return states.stats(latest_state(spark, sf_dir), "amount")


def top_k_latest(spark, sf_dir):
    return states.top_k(latest_state(spark, sf_dir), "amount", 5)


def top_k_by_ts(spark, sf_dir):
    return states.top_k(latest_state_by_ts(spark, sf_dir), "amount", 5)


def state_as_of_lsn(spark, sf_dir):
    return states.as_of(_guarded(spark, sf_dir), 3_500_000)


def change_history(spark, sf_dir):
    return states.history(_guarded(spark, sf_dir))


def rollback_leak(spark, sf_dir):
    f = _guarded(spark, sf_dir)
    return f.agg(F.count_if(F.col("id").between(80, 89)).alias("leaked"), F.count_if(F.col("_cdc_op") == "DELETE").alias("deletes"), F.count_if(F.col("_cdc_op") == "SNAPSHOT").alias("snapshots"))


def audit_checks(spark, sf_dir):
    out = audits.audit(_guarded(spark, sf_dir), value="amount", count=0, total=0.0, leaked=(-10, -1), snapshots=1, evolved=("status", "tags"), deletes=0)
    return out.select("check", F.round("actual", 0).alias("actual"), "expected", "passed")


def committed_changes(spark, sf_dir):
    feed = _guarded(spark, sf_dir).withColumn("xid", F.floor(F.col("id") / 4).cast("long"))
    marks = feed.select("xid").filter("xid % 5 <> 0")
    return feeds.committed_only(feed, marks)


def epoch_barrier(spark, sf_dir):
    flushed = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("table_name")).agg(F.max(F.floor(F.col("o_orderkey") / 1000)).cast("long").alias("epoch"))
    return feeds.barrier(flushed, 1)


def silver_merge(spark, sf_dir):
    first, second = _halves(spark, sf_dir)
    state = merges.plan_merge(merges.empty_state(first), first)
    return merges.plan_merge(state, second)


def silver_merge_strict(spark, sf_dir):
    first, second = _halves(spark, sf_dir)
    state = merges.plan_merge(merges.empty_state(first), first, mode="strict_ops")
    return merges.plan_merge(state, second, mode="strict_ops")


def silver_stream(spark, sf_dir):
    top = scratch(spark, "silver")
    bronze = ChangeTable(spark, f"{top}/bronze")
    for half in _halves(spark, sf_dir):
        bronze.append(half)
    run_silver(spark, bronze.path, f"{top}/silver", f"{top}/checkpoint").awaitTermination()
    return silver_view(spark, f"{top}/silver")


def bronze_roundtrip(spark, sf_dir):
    t = ChangeTable(spark, scratch(spark, "bronze"))
    t.append(_guarded(spark, sf_dir))
    return t.read()


def bronze_time_travel(spark, sf_dir):
    t = ChangeTable(spark, scratch(spark, "bronze"))
    f = _guarded(spark, sf_dir)
    t.append(f.filter("_cdc_lsn < 3000000"))
    t.append(f.filter("_cdc_lsn >= 3000000"))
    return t.read(version=0)


def bronze_lsn_range(spark, sf_dir):
    t = ChangeTable(spark, scratch(spark, "bronze"))
    f = _guarded(spark, sf_dir)
    t.append(f.filter("_cdc_lsn < 3000000"))
    t.append(f.filter("_cdc_lsn >= 3000000"))
    return t.read(lsn_from=3_000_000, lsn_to=4_100_000)


def bronze_compacted(spark, sf_dir):
    t = ChangeTable(spark, scratch(spark, "bronze"))
    f = _guarded(spark, sf_dir)
    t.append(f.filter("_cdc_lsn < 3000000"))
    t.append(f.filter("_cdc_lsn >= 3000000"))
    t.compact()
    return t.read()


def schema_evolution_union(spark, sf_dir):
    t = ChangeTable(spark, scratch(spark, "bronze"))
    f = _guarded(spark, sf_dir)
    t.append(f.filter("_cdc_lsn < 3000000").withColumn("priority", F.col("id").cast("int")))
    t.append(f.filter("_cdc_lsn >= 3000000").withColumn("priority", F.col("id").cast("long")).withColumn("tags", F.lit("none")))
    return t.read()


def merge_rewrite(spark, sf_dir):
    """The merge on a commit-log table: only touched files are rewritten."""
    from ..streaming.runs import merge_into

    t = ChangeTable(spark, scratch(spark, "silver"))
    first, second = _halves(spark, sf_dir)
    t.create(merges.empty_state(first, True).schema)
    merge_into(t, first)
    merge_into(t, second)
    return merges.visible(t.read())


_LATEST = "select id, status, amount, _cdc_op, _cdc_timestamp, _cdc_lsn from (select *, row_number() over (partition by id order by {order}) as rn from {src}) where rn = 1"
_BY_LSN, _BY_TS = "_cdc_lsn desc, _cdc_timestamp desc", "_cdc_timestamp desc, _cdc_lsn desc"
_FEED = "with " + ORDERS_FEED_SQL
_LIVE = _LATEST.format(order=_BY_LSN, src="guarded") + " and _cdc_op <> 'DELETE'"

_MERGED = (
    "with " + EVENTS_FEED_SQL + """
select id, event_type, value, _cdc_lsn from (select *, row_number() over (partition by id order by _cdc_lsn desc, _cdc_timestamp desc) as rn from efeed) where rn = 1 and _cdc_op <> 'DELETE'"""
)


def _strict_step(target: str, batch: str) -> str:
    return f"""select coalesce(t.id, s.id) as id,
  case when t.id is null or s._cdc_op = 'UPDATE' then s.event_type else t.event_type end as event_type,
  case when t.id is null or s._cdc_op = 'UPDATE' then s.value else t.value end as value,
  case when t.id is null or s._cdc_op = 'UPDATE' then s._cdc_lsn else t._cdc_lsn end as _cdc_lsn
from {target} t full outer join {batch} s on t.id = s.id
where s.id is null or (t.id is not null and s._cdc_op <> 'DELETE') or (t.id is null and s._cdc_op in ('INSERT', 'UPDATE'))"""


_NEWEST_HALF = "select * from (select *, row_number() over (partition by id order by _cdc_timestamp desc, _cdc_lsn desc) as rn from efeed where _cdc_lsn {side} " + SPLIT_SQL + ") where rn = 1"
_STRICT = (
    "with " + EVENTS_FEED_SQL + f""",
b1 as ({_NEWEST_HALF.format(side='<')}),
b2 as ({_NEWEST_HALF.format(side='>=')}),
t0 as (select id, event_type, value, _cdc_lsn from efeed where false),
t1 as ({_strict_step('t0', 'b1')}),
t2 as ({_strict_step('t1', 'b2')})
select * from t2"""
)

_AUDIT = (
    _FEED + f""",
live as ({_LIVE}),
f as (select cast(count(*) as double) as n, coalesce(sum(amount), 0) as s from live),
r as (select cast(count(*) filter (id between -10 and -1) as double) as leak, cast(count(*) filter (_cdc_op = 'SNAPSHOT') as double) as snap, cast(count(*) filter (_cdc_op = 'DELETE') as double) as dels from guarded)
select 'row_count' as "check", n as actual, 0.0::double as expected, n = 0 as passed from f
union all select 'value_sum', round(s, 0), 0.0, abs(s) <= 0.1 from f
union all select 'secondary_count', 0.0, 0.0, true
union all select 'rollback_leak', leak, 0.0, leak = 0 from r
union all select 'snapshot_rows', snap, 1.0, snap >= 1 from r
union all select 'schema_evolution', 1.0, 2.0, false
union all select 'delete_rows', dels, 0.0, dels = 0 from r"""
)

#: name -> (query, SQL)
QUERIES = {
    "feed_op_counts": (feed_op_counts, _FEED + " select _cdc_op, count(*) as n from guarded group by _cdc_op"),
    "feed_max_lsn": (feed_max_lsn, _FEED + " select max(_cdc_lsn) as max_lsn from guarded"),
    "handover_guard": (handover_guard, _FEED + " select * from guarded"),
    "snapshot_stream_union": (snapshot_stream_union, "select o_orderkey as id, o_orderstatus as status, cast(case when o_orderkey % 2 = 0 then 1000000 else o_orderkey + 2000000 end as bigint) as _cdc_lsn from orders"),
    "latest_state": (latest_state, _FEED + " " + _LIVE),
    "latest_state_with_deletes": (latest_state_with_deletes, _FEED + " " + _LATEST.format(order=_BY_LSN, src="guarded")),
    "latest_state_by_ts": (latest_state_by_ts, _FEED + " " + _LATEST.format(order=_BY_TS, src="guarded")),
    "latest_stats": (latest_stats, _FEED + f", live as ({_LIVE}) select count(*) as n, cast(sum(cast(amount as decimal(18,2))) as double) as total from live"),
    "top_k_latest": (top_k_latest, _FEED + f", live as ({_LIVE}) select * from live order by amount desc nulls last, id limit 5"),
    "top_k_by_ts": (top_k_by_ts, _FEED + f", l as ({_LATEST.format(order=_BY_TS, src='guarded')}) select * from l order by amount desc nulls last, id limit 5"),
    "state_as_of_lsn": (state_as_of_lsn, _FEED + ", upto as (select * from guarded where _cdc_lsn <= 3500000) " + _LATEST.format(order=_BY_LSN, src="upto") + " and _cdc_op <> 'DELETE'"),
    "change_history": (change_history, _FEED + " select *, _cdc_lsn as _valid_from, lead(_cdc_lsn) over (partition by id order by _cdc_lsn, _cdc_timestamp) as _valid_to from guarded"),
    "rollback_leak": (rollback_leak, _FEED + " select count(*) filter (id between 80 and 89) as leaked, count(*) filter (_cdc_op = 'DELETE') as deletes, count(*) filter (_cdc_op = 'SNAPSHOT') as snapshots from guarded"),
    "audit_checks": (audit_checks, _AUDIT),
    "committed_changes": (committed_changes, _FEED + ", x as (select *, cast(floor(id / 4) as bigint) as xid from guarded) select * from x where _cdc_op = 'SNAPSHOT' or xid % 5 <> 0"),
    "epoch_barrier": (epoch_barrier, "select min(e) >= 1 as complete from (select max(cast(floor(o_orderkey / 1000) as bigint)) as e from orders group by o_orderpriority)"),
    "silver_merge": (silver_merge, _MERGED),
    "silver_merge_strict": (silver_merge_strict, _STRICT),
    "silver_stream": (silver_stream, _MERGED),
    "merge_rewrite": (merge_rewrite, _MERGED),
    "bronze_roundtrip": (bronze_roundtrip, _FEED + " select * from guarded"),
    "bronze_time_travel": (bronze_time_travel, _FEED + " select * from guarded where _cdc_lsn < 3000000"),
    "bronze_lsn_range": (bronze_lsn_range, _FEED + " select * from guarded where _cdc_lsn between 3000000 and 4100000"),
    "bronze_compacted": (bronze_compacted, _FEED + " select * from guarded"),
    "schema_evolution_union": (schema_evolution_union, _FEED + " select *, cast(id as bigint) as priority, case when _cdc_lsn >= 3000000 then 'none' end as tags from guarded"),
}
