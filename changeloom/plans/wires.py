"""Registered queries over the wire formats, types, catalog and routing, each with its SQL."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import pgtypes, text
from ..sources import catalog, items, wire
from ..sources.files import filesystem, scratch, spread
from .synth import table

ORDERS = catalog.Table("public", "orders", (catalog.Column("id", "bigint", key=True), catalog.Column("status", "text"), catalog.Column("amount", "double precision")), 16_384)


def _encoded(orders: DataFrame) -> DataFrame:
    """``lsn, payload``: each order as an insert, each third one also as an update, each seventh also as a delete."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lsn, payload = [], []
            for k, s, a in zip(*(b.column(c).to_pylist() for c in ("k", "s", "a"))):
                lsn.append(2_000_000 + k), payload.append(wire.insert(ORDERS.relation_id, [k, s, repr(a)]))
                if k % 3 == 0:
                    lsn.append(3_000_000 + k), payload.append(wire.update(ORDERS.relation_id, [k, "U", repr(a + 100)]))
                if k % 7 == 0:
                    lsn.append(4_000_000 + k), payload.append(wire.delete(ORDERS.relation_id, [k, None, None]))
            yield pa.RecordBatch.from_arrays([pa.array(lsn, pa.int64()), pa.array(payload, pa.binary())], ["lsn", "payload"])

    return spread(orders.select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"), F.col("o_totalprice").alias("a"))).mapInArrow(run, "lsn long, payload binary")


def wire_decode_pgoutput(spark, sf_dir):
    decoded = wire.decode_messages(_encoded(table(spark, sf_dir, "orders")))
    return wire.typed_rows(decoded, [(0, ORDERS)], unchanged=False, received_us=7)


#: Rows of a copy file; a file is read by one task.
COPY_ROWS = 50_000


def wire_decode_copy(spark, sf_dir):
    """Customers as binary copy files, of COPY_ROWS at most, read back as snapshot rows.

    An attempt writes files under names of its own; only those that Spark's commit lists are read.
    """
    folder = scratch(spark, "copy")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        key, whole, real = (struct.Struct(f).pack for f in (">q", ">i", ">d"))
        fs, top = filesystem(folder)
        fs.create_dir(top, recursive=True)
        names = []

        def opened():
            names.append(f"part-{uuid.uuid4().hex}.copy")
            f = fs.open_output_stream(f"{top}/{names[-1]}")
            f.write(wire.copy_head())
            return f

        def closed(f) -> None:
            f.write(wire.COPY_END)
            f.close()

        f, left = opened(), COPY_ROWS
        for b in batches:
            for a in range(0, b.num_rows, COPY_ROWS):
                part = b.slice(a, COPY_ROWS)
                if part.num_rows > left:
                    closed(f)
                    f, left = opened(), COPY_ROWS
                rows = zip(*(part.column(c).to_pylist() for c in ("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")))
                f.write(wire.copy_records((key(k), whole(n), real(bal), None if k % 9 == 0 else seg.encode(), bytes((k % 2,)), key(k * 1_000_000)) for k, n, bal, seg in rows))
                left -= part.num_rows
        closed(f)
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}" for name in names], pa.string())], ["file"])

    spread(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")).mapInArrow(run, "file string").write.parquet(f"{folder}/_files")
    files = [r["file"] for r in spark.read.parquet(f"{folder}/_files").collect()]  # one per COPY_ROWS rows
    kinds = (("id", "bigint"), ("nation", "integer"), ("balance", "double precision"), ("segment", "text"), ("odd", "boolean"), ("seen", "timestamp with time zone"))
    t = catalog.Table("public", "customer", tuple(catalog.Column(n, k) for n, k in kinds))
    out = wire.read_copy(spark, files, t, 1_000_000)
    return out.withColumn("seen", F.unix_seconds(pgtypes.normalised_timestamp(F.col("seen"))))


def frame_demux(spark, sf_dir):
    """Frames around the messages, with keepalives and short frames between."""
    m = _encoded(table(spark, sf_dir, "orders"))
    head = lambda kind: F.concat(F.encode(F.lit(kind), "iso-8859-1"), F.unhex(F.lpad(F.hex("lsn"), 16, "0")), F.unhex(F.lit("00" * 16)))
    frames = m.select(F.when(F.col("lsn") % 10 == 0, F.expr("cast('w12' as binary)")).when(F.col("lsn") % 7 == 0, head("k")).otherwise(F.concat(head("w"), "payload")).alias("frame"))
    return wire.demux_frames(frames).groupBy("kind").agg(F.count("*").alias("n"), F.sum("lsn").alias("lsns"), F.count("payload").alias("payloads"))


def _items(spark, sf_dir):
    """Orders as JSON items: every 50th is a story, the others hang below the item of a fifth of their number."""
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders")
    story = k < 5
    kids = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: k * 5 + i)
    item = F.struct(k.alias("id"), F.when(story, "story").otherwise("comment").alias("type"), F.when(k % 4 != 0, F.concat(F.lit("u"), (k % 10).cast("string"))).alias("by"), k.alias("time"), F.when(k % 17 == 0, True).alias("deleted"), kids.alias("kids"))
    return items.parsed(o.select(F.when(k % 1000 == 999, "{broken").otherwise(F.to_json(item)).alias("value")))


def item_comments(spark, sf_dir):
    return items.comments(_items(spark, sf_dir)).select("id", "story_id", "parent_id", F.unix_seconds("posted_at").alias("posted"))


def item_authors(spark, sf_dir):
    return items.authors(_items(spark, sf_dir))


def corrupt_messages(spark, sf_dir):
    """FLT13: whole rows are rejected, and none is half read."""
    good = _encoded(table(spark, sf_dir, "orders"))
    cut = good.withColumn("payload", F.when(F.col("lsn") % 13 == 0, F.expr("substring(payload, 1, 9)")).when(F.col("lsn") % 17 == 0, F.expr("substring(payload, 1, 0)")).otherwise(F.col("payload")))
    decoded = wire.decode_messages(cut)
    return decoded.agg(F.count("error").alias("rejected"), F.count_if(F.col("error").isNull()).alias("good"), F.count_if(F.col("error").isNotNull() & F.col("cells").isNotNull()).alias("half_read"))


def type_casts(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 5 == 0, "x1").otherwise(F.col("p_size").cast("string")).alias("cell"), F.when(F.col("p_partkey") % 3 == 0, "t").when(F.col("p_partkey") % 3 == 1, "false").alias("flag"))
    return p.select("id", pgtypes.from_text(F.col("cell"), "integer").alias("as_int"), pgtypes.from_text(F.col("cell"), "bigint").alias("as_long"), pgtypes.from_text(F.col("cell"), "double precision").alias("as_double"), pgtypes.from_text(F.col("flag"), "boolean").alias("as_bool"), pgtypes.from_text(F.col("cell"), "varchar(9)").alias("as_text"))


def pg_timestamp(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), "o_orderdate")
    micros = (F.unix_micros(F.col("o_orderdate").cast("timestamp")) - pgtypes.PG_EPOCH_US).cast("string")
    iso = F.date_format(F.col("o_orderdate").cast("timestamp"), "yyyy-MM-dd HH:mm:ss'+00'")
    cell = F.when(F.col("id") % 2 == 0, micros).when(F.col("id") % 7 == 0, "no time").otherwise(iso)
    return o.select("id", F.unix_micros(pgtypes.normalised_timestamp(cell)).alias("us"))


def lsn_codec(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select((F.col("o_orderkey") * 4_294_967_311).cast("long").alias("lsn"))
    shown = pgtypes.format_lsn(F.col("lsn"))
    return o.select("lsn", shown.alias("shown"), pgtypes.parse_lsn(shown).alias("parsed"), pgtypes.parse_lsn(F.lit("no/position")).alias("bad"))


def int_arrays(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.concat(F.lit("{"), F.col("c_custkey").cast("string"), F.lit(",NULL,"), F.col("c_nationkey").cast("string"), F.lit("}")).alias("cell"))
    a = pgtypes.int_array(F.col("cell"))
    return c.select("id", F.size(a).alias("n"), a[0].alias("first"), a[1].alias("second"), a[2].alias("third"))


def op_names(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.substring(F.upper("event_type"), 1, 1).alias("code"))
    return e.groupBy(pgtypes.op_name(F.col("code")).alias("op")).agg(F.count("*").alias("n"))


def generated_series(spark, sf_dir):
    """SRC16, FN11, DML9."""
    return spark.range(1, 101).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("Historical_"), F.col("id").cast("string")).alias("name"), (F.col("id") * 1.5).cast("double").alias("score"), F.lit(True).alias("is_active"))


def answer_json(spark, sf_dir):
    """FN12 over conversation turns wrapped as answers."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    raw = F.when(F.col("turn") % 3 == 0, F.concat(F.lit('```json\n{"summary": "'), F.col("role"), F.lit('", "topics": ["a", "b"]}\n```'))).when(F.col("turn") % 3 == 1, F.concat(F.lit('Here: {"summary": ["x", "'), F.col("role"), F.lit('"], "topics": []} done'))).otherwise(F.lit("no answer"))
    summary, topics = text.answer(raw)
    return c.select("conv_id", "turn", summary.alias("summary"), F.array_join(topics, "|").alias("topics"))


def catalog_join(spark, sf_dir):
    q = spark.sql
    return catalog.catalog_columns(
        q("select * from values (1L,'stories',10L,'r','d'), (2L,'comments',10L,'r','f'), (3L,'a_view',10L,'v','d'), (4L,'other',11L,'r','d') t(oid, relname, relnamespace, relkind, relreplident)"),
        q("select * from values (10L,'public'), (11L,'private') t(oid, nspname)"),
        q("select * from values (1L,'id',1,'bigint',true,false), (1L,'title',2,'text',true,false), (1L,'gone',3,'text',false,true), (1L,'ctid',-1,'tid',true,false), (2L,'id',1,'bigint',true,false), (2L,'story_id',2,'bigint',true,false), (2L,'text',3,'text',false,false), (3L,'x',1,'text',false,false), (4L,'y',1,'text',false,false) t(attrelid, attname, attnum, type_name, attnotnull, attisdropped)"),
        q("select * from values (1L,array(1),true), (2L,array(1,2),true), (2L,array(3),false) t(indrelid, indkey, indisprimary)"),
    )


_RELATIONS = "(0, 0, 'even', 1), (0, 40000, 'even', 2), (1, 0, 'odd', 1)"


def route_relation(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 3).cast("int").alias("relation_id"), F.col("o_orderkey").cast("long").alias("lsn"))
    relations = spark.sql(f"select relation_id, cast(since_lsn as bigint) as since_lsn, table_name, layout from values {_RELATIONS} t(relation_id, since_lsn, table_name, layout)")
    return catalog.route(rows, relations)


_CATALOG_VALUES = """(values ('stories','id',1,'bigint','r','public',1,false,true), ('stories','title',2,'text','r','public',1,false,true), ('stories','gone',3,'text','r','public',1,true,false), ('stories','ctid',-1,'tid','r','public',1,false,true),
 ('comments','id',1,'bigint','r','public',2,false,true), ('comments','story_id',2,'bigint','r','public',2,false,true), ('comments','text',3,'text','r','public',2,false,false), ('a_view','x',1,'text','v','public',3,false,false), ('other','y',1,'text','r','private',4,false,false)) t(relname, attname, attnum, type_name, relkind, nspname, oid, dropped, required)"""

QUERIES = {
    "wire_decode_pgoutput": (
        wire_decode_pgoutput,
        """select cast(o_orderkey as bigint) as id, o_orderstatus as status, o_totalprice as amount, 'INSERT' as _cdc_op, cast(7 as bigint) as _cdc_timestamp, cast(2000000 + o_orderkey as bigint) as _cdc_lsn from orders
        union all select o_orderkey, 'U', o_totalprice + 100, 'UPDATE', 7, 3000000 + o_orderkey from orders where o_orderkey % 3 = 0
        union all select o_orderkey, null, null, 'DELETE', 7, 4000000 + o_orderkey from orders where o_orderkey % 7 = 0""",
    ),
    "wire_decode_copy": (
        wire_decode_copy,
        "select c_custkey as id, c_nationkey as nation, c_acctbal as balance, case when c_custkey % 9 <> 0 then c_mktsegment end as segment, c_custkey % 2 = 1 as odd, c_custkey + 946684800 as seen, 'SNAPSHOT' as _cdc_op, cast(0 as bigint) as _cdc_timestamp, cast(1000000 as bigint) as _cdc_lsn from customer",
    ),
    "frame_demux": (
        frame_demux,
        """with m as (select 2000000 + o_orderkey as lsn from orders union all select 3000000 + o_orderkey from orders where o_orderkey % 3 = 0 union all select 4000000 + o_orderkey from orders where o_orderkey % 7 = 0),
        k as (select case when lsn % 10 = 0 then null when lsn % 7 = 0 then 'k' else 'w' end as kind, lsn from m)
        select kind, count(*) as n, case when kind is not null then cast(sum(lsn) as bigint) end as lsns, case when kind = 'w' then count(*) else 0 end as payloads from k group by kind""",
    ),
    "item_comments": (
        item_comments,
        """with recursive i as (select o_orderkey as id, o_orderkey % 17 = 0 and o_orderkey >= 5 as gone from orders where o_orderkey % 1000 <> 999),
        tree as (select c.id, s.id as story_id, cast(null as bigint) as parent_id from i s join i c on s.id < 5 and c.id >= 5 and c.id // 5 = s.id and not c.gone
          union all select c.id, t.story_id, t.id from tree t join i c on c.id // 5 = t.id and not c.gone)
        select id, story_id, parent_id, id as posted from tree""",
    ),
    "item_authors": (item_authors, "select distinct 'u' || (o_orderkey % 10) as id from orders where o_orderkey % 1000 <> 999 and o_orderkey % 4 <> 0"),
    "corrupt_messages": (
        corrupt_messages,
        """with m as (select 2000000 + o_orderkey as lsn from orders union all select 3000000 + o_orderkey from orders where o_orderkey % 3 = 0 union all select 4000000 + o_orderkey from orders where o_orderkey % 7 = 0)
        select count(*) filter (lsn % 13 = 0 or lsn % 17 = 0) as rejected, count(*) filter (lsn % 13 <> 0 and lsn % 17 <> 0) as good, cast(0 as bigint) as half_read from m""",
    ),
    "type_casts": (
        type_casts,
        """with p as (select p_partkey as id, case when p_partkey % 5 = 0 then 'x1' else cast(p_size as varchar) end as cell, case p_partkey % 3 when 0 then 't' when 1 then 'false' end as flag from part)
        select id, try_cast(cell as integer) as as_int, try_cast(cell as bigint) as as_long, try_cast(cell as double) as as_double, flag in ('t','true','1') as as_bool, cell as as_text from p""",
    ),
    "pg_timestamp": (pg_timestamp, "select o_orderkey as id, case when o_orderkey % 2 = 0 then epoch_us(o_orderdate) when o_orderkey % 7 = 0 then null else epoch_us(date_trunc('second', o_orderdate)) end as us from orders"),
    "lsn_codec": (lsn_codec, "select lsn, upper(printf('%x', lsn >> 32)) || '/' || upper(printf('%x', lsn & 4294967295)) as shown, lsn as parsed, cast(null as bigint) as bad from (select cast(o_orderkey * 4294967311 as bigint) as lsn from orders)"),
    "int_arrays": (int_arrays, "select c_custkey as id, 3 as n, cast(c_custkey as integer) as first, cast(null as integer) as second, c_nationkey as third from customer"),
    "op_names": (op_names, "select case upper(event_type[1]) when 'I' then 'INSERT' when 'U' then 'UPDATE' when 'D' then 'DELETE' when 'S' then 'SNAPSHOT' when 'T' then 'TRUNCATE' else 'UNKNOWN' end as op, count(*) as n from events group by 1"),
    "generated_series": (generated_series, "select cast(i as integer) as id, 'Historical_' || i as name, cast(i * 1.5 as double) as score, true as is_active from range(1, 101) t(i)"),
    "answer_json": (answer_json, "select conv_id, turn, case turn % 3 when 0 then role when 1 then 'x' || chr(10) || role else 'no answer' end as summary, case turn % 3 when 0 then 'a|b' when 1 then '' end as topics from conversations"),
    "catalog_join": (
        catalog_join,
        f"""select nspname as schema, relname as table_name, case oid when 2 then 'f' else 'd' end as identity, attname as column_name, attnum as position, type_name as data_type, not required as is_nullable,
        list_contains(case oid when 1 then [1] when 2 then [1, 2] else [] end, attnum) as is_key from {_CATALOG_VALUES} where relkind = 'r' and nspname = 'public' and attnum > 0 and not dropped""",
    ),
    "route_relation": (
        route_relation,
        """with r as (select cast(o_orderkey % 3 as integer) as relation_id, cast(o_orderkey as bigint) as lsn from orders)
        select relation_id, lsn, case relation_id when 0 then 'even' else 'odd' end as table_name, case when relation_id = 0 and lsn >= 40000 then 2 else 1 end as layout from r where relation_id in (0, 1)""",
    ),
}
