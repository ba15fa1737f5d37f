"""Registered queries over landed streams: messages to change tables, their layouts and types, positions, and the audited scenario."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..operators import audit as audits
from ..operators import serving
from ..sources import catalog, wire
from ..sources.files import scratch, spread
from ..sources.txlog import ChangeTable, read_union_by_name
from ..streaming.runs import confirmed, land_snapshot, run_bronze, spool
from . import scenario
from .feeds import _FEED, _LIVE, latest_state
from .synth import table

_NARROW = [("id", 20, True), ("status", 25, False), ("amount", 701, False)]
_WIDE = [*_NARROW, ("priority", 23, False)]
#: Changes below it are in a snapshot already.
_FROM = 2_000_010


def _messages(spark, sf_dir) -> DataFrame:
    """``lsn, payload``: an insert for each order, updates of a third, deletes of a seventh; a column is added before the updates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lsn, payload = [], []
            for k, s, a in zip(*(b.column(c).to_pylist() for c in ("k", "s", "a"))):
                lsn.append(2_000_000 + k), payload.append(wire.insert(7, [k, s, repr(a)]))
                if k % 3 == 0:
                    lsn.append(3_000_000_000 + k), payload.append(wire.update(7, [k, "U", repr(a + 100), k % 5]))
                if k % 7 == 0:
                    lsn.append(4_000_000_000 + k), payload.append(wire.delete(7, [k, None, None, None]))
            yield pa.RecordBatch.from_arrays([pa.array(lsn, pa.int64()), pa.array(payload, pa.binary())], ["lsn", "payload"])

    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("a"))
    marks = spark.createDataFrame([(1, wire.relation(7, "orders", _NARROW)), (2_999_999_999, wire.relation(7, "orders", _WIDE)), (4_999_999_999, b"U\0")], "lsn long, payload binary")
    return spread(orders).mapInArrow(run, "lsn long, payload binary").union(marks)


def _landed(spark, sf_dir) -> str:
    """The messages in two deliveries, each landed by a run of its own; the second run goes on where the first ended."""
    top = scratch(spark, "landed")
    feed = _messages(spark, sf_dir)
    for part in ("lsn < 2500000000", "lsn >= 2500000000"):
        spool(feed.filter(part), f"{top}/feed")
        run_bronze(spark, f"{top}/feed", f"{top}/out", f"{top}/checkpoint", watermark=_FROM, received_us=7).awaitTermination()
    return f"{top}/out"


def bronze_stream(spark, sf_dir):
    return ChangeTable(spark, f"{_landed(spark, sf_dir)}/orders").read().drop("_cdc_unchanged")


def bronze_positions(spark, sf_dir):
    """What a run that has landed all may confirm, and what it could not read."""
    out = _landed(spark, sf_dir)
    bad = ChangeTable(spark, f"{out}/_corrupt").read().agg(F.count("*").alias("rejected"))
    return confirmed(spark, out).select("lsn", F.hex("message").alias("message")).join(F.broadcast(bad))  # one row each


def _relation_messages(spark, sf_dir) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lsn, payload = [], []
            for k, n in zip(b.column("k").to_pylist(), b.column("n").to_pylist()):
                lsn.append(10 * k)
                payload.append(wire.relation(k, f"table_{k}", [("id", 20, True), (n, 25, False), ("balance", 701, False), ("other", 99_999, False)], "public" if k % 2 else "private", "f" if k % 5 == 0 else "d"))
            yield pa.RecordBatch.from_arrays([pa.array(lsn, pa.int64()), pa.array(payload, pa.binary())], ["lsn", "payload"])

    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("n")).mapInArrow(run, "lsn long, payload binary")


def relation_layouts(spark, sf_dir):
    """SRC8: a row per column of each relation message."""
    rows = wire.relation_rows(wire.decode_messages(_relation_messages(spark, sf_dir)))
    rows = rows.select("relation_id", "since_lsn", "schema", F.col("table").alias("table_name"), "identity", F.posexplode("columns").alias("position", "c"))
    return rows.select("relation_id", "since_lsn", "schema", "table_name", "identity", F.col("position"), F.col("c.name").alias("column_name"), F.col("c.oid").alias("type_oid"), F.col("c.key").alias("is_key"))


def typed_relations(spark, sf_dir):
    """J3: the catalog's type first, then the type id's, then text."""
    k = F.col("c_custkey")
    column = lambda name, kind, key: F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("data_type"), F.lit(key).alias("is_key"))
    known = table(spark, sf_dir, "customer").filter("c_custkey % 3 = 0").select(F.when(k % 2 == 1, "public").otherwise("private").alias("schema"), F.concat(F.lit("table_"), k.cast("string")).alias("table_name"), F.explode(F.array(column("id", "integer", True), column("balance", "numeric(12,2)", False))).alias("c"))
    return catalog.typed_relations(relation_layouts(spark, sf_dir).drop("is_key", "identity"), known.select("schema", "table_name", "c.*"))


def audit_scenario(spark, sf_dir):
    """The whole way: snapshot and messages to change tables, the source's figures as a file, the audit against them."""
    top = scratch(spark, "scenario")
    out, copies = f"{top}/out", f"{top}/copy"
    scenario.snapshot(spark).write.parquet(copies)
    main = ChangeTable(spark, f"{out}/integration_test")
    land_snapshot(main, wire.copy_rows(spark.read.parquet(copies), scenario.KNOWN, scenario.WATERMARK))
    spool(scenario.messages(spark), f"{top}/feed", max_rows=3_000)
    run = lambda: run_bronze(spark, f"{top}/feed", out, f"{top}/checkpoint", {"public.integration_test": scenario.KNOWN}, watermark=scenario.WATERMARK, max_files=4, received_us=5).awaitTermination()
    run()
    run()  # nothing new
    audits.write_results(scenario.expected(spark), f"{top}/expected")
    figures = {r["key"]: float(r["value"]) for r in audits.read_expected(spark, f"{top}/expected").collect()}
    return audits.audit(main.read(), count=int(figures["COUNT"]), total=figures["SUM"], secondary=ChangeTable(spark, f"{out}/secondary_test").read(), secondary_count=int(figures["SECONDARY_COUNT"]), deletes=101)


def union_by_name(spark, sf_dir):
    """SRC12: files of different writers below one folder."""
    top = scratch(spark, "files")
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_custkey") + 5).cast("decimal(20,0)").alias("_cdc_lsn"))
    c.filter("id % 2 = 0").write.parquet(f"{top}/a")
    c.filter("id % 2 = 1").withColumn("tags", F.lit("none")).write.parquet(f"{top}/b/c")
    return read_union_by_name(spark, top)


def added_to_table(spark, sf_dir):
    """DML7: a migration that adds columns, run twice; the second run commits nothing."""
    t = ChangeTable(spark, scratch(spark, "migrated"))
    t.append(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"))
    versions = [t.add_columns("iframe_blocked boolean, hn_rank int") for _ in range(2)]
    return t.read().withColumn("version", F.lit(versions[-1]))


def slot_exists(spark, sf_dir):
    """AGG11."""
    return catalog.slot_exists(table(spark, sf_dir, "nation").select(F.concat(F.lit("slot_"), F.lower("n_name")).alias("slot_name")), "slot_france")


def random_workload(spark, sf_dir):
    """FN15."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("id"), text.seeded_uniform(F.col("c_custkey"), 0, 100, seed=7).alias("score"), text.seeded_choice(F.col("c_custkey"), ["t", "f", "x"], seed=8).alias("flag"))


def flat_strings(spark, sf_dir):
    """FN13 over JSON built from parts: a string, an array of strings, an array of arrays."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.regexp_replace("p_name", r'["\\]', "").alias("n"))
    k = F.col("p_partkey") % 3
    raw = F.when(k == 0, F.concat(F.lit('"'), "n", F.lit('"'))).when(k == 1, F.concat(F.lit('["'), "n", F.lit('", "b"]'))).otherwise(F.concat(F.lit('[["'), "n", F.lit('", "x"], ["c"]]')))
    return p.select("p_partkey", F.array_join(text.flatten_strings(F.parse_json(raw)), "|").alias("flat"))


def workload_changes(spark, sf_dir):
    """DML8, FLT11: the workload's range update and its delete of one key."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("score"))
    k = F.col("id")
    return serving.delete_where(serving.update_where(rows, (k > 100) & (k < 200), {"score": F.col("score") + 100}), k == 960)


def temp_view(spark, sf_dir):
    """SRC13: the newest state under a name, asked by SQL text."""
    latest_state(spark, sf_dir).createOrReplaceTempView("changeloom_latest")
    return spark.sql("select status, count(*) as n, max(_cdc_lsn) as last from changeloom_latest group by status")


_RANDOM = "cast('0x' || substr(md5('{seed}:' || c_custkey), 1, 8) as bigint)"
_SCENARIO_SQL = """
with own as (select i as id, (i * 37 % 400) / 4.0 + case when i < 200 then 100 else 0 end as score from range(101, 10101) t(i)
  union all select i, 50 from range(90000, 90005) t(i) union all select i, 75 from range(95000, 95005) t(i) union all select i, 90 from range(96001, 96005) t(i)),
f as (select cast(count(*) as double) as n, cast(sum(score) as double) as s from own)
select 'row_count' as "check", n as actual, 10014.0::double as expected, n = 10014 as passed from f
union all select 'value_sum', s, s, true from f
union all select 'secondary_count', 10.0, 10.0, true
union all select 'rollback_leak', 0.0, 0.0, true
union all select 'snapshot_rows', 100.0, 100.0, true
union all select 'schema_evolution', 2.0, 2.0, true
union all select 'delete_rows', 101.0, 101.0, true"""
_COLUMNS_SQL = """
c as (select c_custkey as k, c_name as n from customer),
r as (select cast(k as bigint) as relation_id, cast(10 * k as bigint) as since_lsn, case when k % 2 = 1 then 'public' else 'private' end as schema, 'table_' || k as table_name, case when k % 5 = 0 then 'f' else 'd' end as identity, k,
  unnest([{'position': 0, 'name': 'id', 'oid': 20}, {'position': 1, 'name': n, 'oid': 25}, {'position': 2, 'name': 'balance', 'oid': 701}, {'position': 3, 'name': 'other', 'oid': 99999}]) as x from c)"""

QUERIES = {
    "bronze_stream": (
        bronze_stream,
        f"""select cast(o_orderkey as bigint) as id, o_orderstatus as status, o_totalprice as amount, cast(null as integer) as priority, 'INSERT' as _cdc_op, cast(7 as bigint) as _cdc_timestamp, cast(2000000 + o_orderkey as bigint) as _cdc_lsn from orders where 2000000 + o_orderkey >= {_FROM}
        union all select o_orderkey, 'U', o_totalprice + 100, cast(o_orderkey % 5 as integer), 'UPDATE', 7, 3000000000 + o_orderkey from orders where o_orderkey % 3 = 0
        union all select o_orderkey, null, null, null, 'DELETE', 7, 4000000000 + o_orderkey from orders where o_orderkey % 7 = 0""",
    ),
    "bronze_positions": (bronze_positions, "select cast(4999999999 as bigint) as lsn, '72' || repeat('000000012A05F1FF', 3) || repeat('00', 9) as message, cast(1 as bigint) as rejected"),
    "relation_layouts": (relation_layouts, f"with {_COLUMNS_SQL} select relation_id, since_lsn, schema, table_name, identity, x.position as position, x.name as column_name, cast(x.oid as bigint) as type_oid, x.position = 0 as is_key from r"),
    "typed_relations": (
        typed_relations,
        f"""with {_COLUMNS_SQL} select relation_id, since_lsn, schema, table_name, x.position as position, x.name as column_name, cast(x.oid as bigint) as type_oid,
        case x.position when 0 then case when k % 3 = 0 then 'integer' else 'bigint' end when 2 then case when k % 3 = 0 then 'numeric(12,2)' else 'double precision' end else 'text' end as data_type, k % 3 = 0 and x.position = 0 as is_key from r""",
    ),
    "audit_scenario": (audit_scenario, _SCENARIO_SQL),
    "union_by_name": (union_by_name, "select c_custkey as id, c_name as name, cast(c_custkey + 5 as bigint) as _cdc_lsn, case when c_custkey % 2 = 1 then 'none' end as tags from customer"),
    "added_to_table": (added_to_table, "select s_suppkey, s_name, cast(null as boolean) as iframe_blocked, cast(null as integer) as hn_rank, 1 as version from supplier"),
    "slot_exists": (slot_exists, "select count(*) as n, count(*) > 0 as present from nation where lower(n_name) = 'france'"),
    "random_workload": (random_workload, f"select c_custkey as id, 0 + 100 * ({_RANDOM.format(seed=7)} / 4294967296.0::double) as score, ['t', 'f', 'x'][cast({_RANDOM.format(seed=8)} % 3 as integer) + 1] as flag from customer"),
    "flat_strings": (flat_strings, """select p_partkey, case p_partkey % 3 when 1 then n || '|b' when 2 then n || '|c' else n end as flat from (select p_partkey, regexp_replace(p_name, '["\\\\]', '', 'g') as n from part)"""),
    "workload_changes": (workload_changes, "select o_orderkey as id, o_totalprice + case when o_orderkey > 100 and o_orderkey < 200 then 100 else 0 end as score from orders where o_orderkey <> 960"),
    "temp_view": (temp_view, _FEED + f", live as ({_LIVE}) select status, count(*) as n, max(_cdc_lsn) as last from live group by status"),
}
