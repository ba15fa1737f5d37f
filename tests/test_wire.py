"""Codec round trips, edge cases, and the whole scenario from messages to audited state."""

from __future__ import annotations

import random
import struct
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from changeloom.functions import pgtypes
from changeloom.operators.audit import audit
from changeloom.plans import wires
from changeloom.sources import catalog, wire
from changeloom.sources.txlog import ChangeTable
from changeloom.streaming.runs import run_bronze, run_silver, silver_view

cell = st.one_of(st.none(), st.just(...), st.text(max_size=8))
cells = st.lists(cell, max_size=5)


def text_of(xs):
    return [None if x is None or x is ... else str(x) for x in xs]


@settings(max_examples=200, deadline=None)
@given(cells, cells, st.sampled_from([b"K", b"O"]), st.integers(1, 2**32 - 1))
def test_messages_round_trip(new, old, kind, rel):
    u = wire.parse_message(wire.update(rel, new, old, kind))
    assert (u["relation_id"], u["cells"], u["old"], u["old_kind"]) == (rel, text_of(new), text_of(old), kind.decode())
    assert u["unchanged"] == [i for i, x in enumerate(new) if x is ...]
    assert wire.parse_message(wire.insert(rel, new))["cells"] == text_of(new)
    assert wire.parse_message(wire.delete(rel, old))["old"] == text_of(old)


@settings(max_examples=200, deadline=None)
@given(cells, st.integers(0, 200))
def test_cut_messages_are_rejected_whole(new, n):
    data = wire.update(7, new, ["N", "xNx"], b"O")
    if n < len(data):
        with pytest.raises((wire.Bad, struct.error)):
            wire.parse_message(data[:n])


def test_marks_relations_and_frames():
    assert wire.parse_message(wire.begin(5, 77))["xid"] == 77
    assert wire.parse_message(wire.commit(5, 6))["end_lsn"] == 6
    r = wire.parse_message(wire.relation(9, "t", [("id", 23, True), ("v", 25, False)]))
    assert (r["table"], [c["name"] for c in r["columns"]], r["columns"][0]["key"]) == ("t", ["id", "v"], True)
    assert wire.parse_message(wire.truncate([3, 4]))["relations"] == [3, 4]
    assert wire.parse_frame(wire.frame(12, b"B"))[1:] == (12, b"B")
    assert wire.parse_frame(b"k" + bytes(17))[0] == "k"
    for bad in (b"", b"w123", b"k1", b"x"):
        with pytest.raises(wire.Bad):
            wire.parse_frame(bad)
    assert len(wire.status_update(5)) == 34


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.one_of(st.none(), st.binary(max_size=9)), max_size=4), max_size=6))
def test_copy_round_trips(rows):
    assert list(wire.parse_copy(wire.copy_stream(rows))) == rows


def test_binary_types():
    d = pgtypes.decoder
    assert d("integer")(struct.pack(">i", -5)) == "-5"
    assert d("smallint")(struct.pack(">h", 7)) == "7"
    assert d("integer")(b"12") is None
    assert d("real")(struct.pack(">f", 1.5)) == "1.5"
    assert d("date")(struct.pack(">i", 1)) == "2000-01-02"
    assert d("jsonb")(b"\x01{}") == "{}"
    assert d("uuid")(bytes(16)) == "00000000-0000-0000-0000-000000000000"
    assert d("numeric(10,2)")(struct.pack(">hhHHhh", 2, 0, 0, 2, 12, 3400)) == "12.34"
    assert d("numeric")(struct.pack(">hhHH", 0, 0, 0xC000, 0)) == "NaN"
    assert d("integer[]")(struct.pack(">iiIii", 1, 1, 23, 2, 1) + struct.pack(">ii", 4, 5) + struct.pack(">i", -1)) == "{5,NULL}"
    assert d("point")(b"\0") == "AA=="


def test_typed_rows_edges(spark):
    t = catalog.Table("public", "t", (catalog.Column("id", "integer", key=True), catalog.Column("r", "real"), catalog.Column("n", "numeric(8,2)"), catalog.Column("b", "boolean")), 5)
    messages = [
        (1, wire.insert(5, ["1", "1.5", "2.50", "t"])), (2, wire.insert(5, ["bad", None, "x", "no"])), (3, wire.insert(5, ["3"])), (4, wire.insert(5, ["4", "1", "1", "f", "extra"])),
        (5, wire.update(5, ["9", ..., "1", "t"], ["1", None, None, None])), (6, wire.delete(5, ["3", None, None, None])), (7, b"U\0"), (8, wire.insert(99, ["1"])), (9, wire.truncate([5])), (10, b""),
    ]
    decoded = wire.decode_messages(spark.createDataFrame(messages, "lsn long, payload binary"))
    rows = wire.typed_rows(decoded, [(0, t)], received_us=1).orderBy("_cdc_lsn", "_cdc_op").collect()
    got = [(r["id"], r["r"], r["n"], r["b"], r["_cdc_op"], r["_cdc_lsn"]) for r in rows]
    assert got == [
        (1, 1.5, "2.50", True, "INSERT", 1), (None, None, "x", False, "INSERT", 2), (3, None, None, None, "INSERT", 3), (4, 1.0, "1", False, "INSERT", 4),
        (1, None, None, None, "DELETE", 5), (9, None, "1", True, "UPDATE", 5), (3, None, None, None, "DELETE", 6),
    ]
    assert [r for r in rows if r["_cdc_op"] == "UPDATE"][0]["_cdc_unchanged"] == ["r"]
    assert {r["lsn"] for r in wire.rejected(decoded).collect()} == {7, 10}
    assert wire.typed_rows(decoded, [(0, t)], pk_change="new_only", received_us=1).count() == 6
    assert [r["relation_id"] for r in wire.truncated(decoded).collect()] == [5]


MAIN = [("id", 23, True), ("name", 25, False), ("score", 701, False), ("is_active", 16, False), ("created_at", 1184, False)]


def scenario(inserts: int):
    """The messages of the end-to-end scenario, and a plain replay of it."""
    rng = random.Random(4)
    lsn, out, live = 1_000_000, [], {}

    def send(payload):
        nonlocal lsn
        lsn += 8
        out.append((lsn, payload))

    def put(i, score, *more):
        send(wire.insert(1, [i, f"row {i}", repr(score), "t", "2026-04-12 15:30:00+00", *more]))
        live[i] = score

    send(wire.relation(1, "integration_test", MAIN))
    out.append((999_999, wire.insert(1, [77, "stale", "1", "t", None])))  # below the watermark
    for i in range(1, 101):
        send(wire.delete(1, [i, None, None, None, None]))
    send(wire.begin(lsn, 5))
    for i in range(101, 101 + inserts):
        put(i, round(rng.uniform(0, 100), 2))
    send(wire.commit(lsn, lsn))
    for i in range(90000, 90005):
        put(i, 50.0)
    send(wire.relation(1, "integration_test", [*MAIN, ("priority", 23, False)]))
    for i in range(95000, 95005):
        put(i, 75.0, 1)
    send(wire.relation(1, "integration_test", [*MAIN, ("priority", 23, False), ("tags", 25, False)]))
    for i in range(96000, 96005):
        put(i, 90.0, 1, "none")
    send(wire.delete(1, [96000, *[None] * 6]))
    del live[96000]
    for i in range(101, 200):
        live[i] += 100
        send(wire.update(1, [i, f"row {i}", repr(live[i]), "t", None, 0, "none"]))
    send(wire.relation(2, "secondary_test", [("id", 23, True), ("note", 25, False), ("val", 23, False)]))
    for i in range(1, 11):
        send(wire.insert(2, [i, f"Note {i}", i * 10]))
    out.append((lsn + 8, b"I\0\0"))
    return out, live


def test_scenario_from_messages_to_audited_state(spark, tmp_path):
    messages, live = scenario(1000)
    out = f"file://{tmp_path}/bronze"
    snap = [[struct.pack(">i", i), f"Historical_{i}".encode(), struct.pack(">d", i * 1.5), b"\1", None] for i in range(1, 101)]
    (tmp_path / "copy").mkdir()
    (tmp_path / "copy/a.copy").write_bytes(wire.copy_stream(snap))
    known = catalog.Table("public", "integration_test", tuple(catalog.Column(n, pgtypes.TYPE_OIDS[o], key=k) for n, o, k in MAIN), 1)
    main = ChangeTable(spark, f"{out}/integration_test")
    main.append(wire.read_copy(spark, f"file://{tmp_path}/copy", known, 1_000_000), "snapshot", 0)

    spark.createDataFrame(messages, "lsn long, payload binary").orderBy("lsn").coalesce(1).write.option("maxRecordsPerFile", 400).parquet(f"{tmp_path}/feed")
    run = lambda: run_bronze(spark, f"{tmp_path}/feed", out, f"{tmp_path}/check", {"public.integration_test": known}, watermark=1_000_000, max_files=2, received_us=5).awaitTermination()
    run()
    run()  # nothing new

    checks = audit(main.read(), count=len(live), total=sum(live.values()), secondary=ChangeTable(spark, f"{out}/secondary_test").read(), secondary_count=10, deletes=101).collect()
    assert len(checks) == 7 and all(r["passed"] for r in checks), checks
    assert ChangeTable(spark, f"{out}/_corrupt").read().count() == 1
    assert dict(main.read().dtypes)["priority"] == "int"

    for _ in range(2):  # a restart reads only what is new
        run_silver(spark, main.path, f"file://{tmp_path}/silver", f"{tmp_path}/check2").awaitTermination()
    got = {r["id"]: r["score"] for r in silver_view(spark, f"file://{tmp_path}/silver").collect()}
    assert got == live


def test_table_filter_holds_for_the_stream(spark, tmp_path):
    messages, _ = scenario(120)
    spark.createDataFrame(messages, "lsn long, payload binary").coalesce(1).write.parquet(f"{tmp_path}/feed")
    run_bronze(spark, f"{tmp_path}/feed", f"file://{tmp_path}/out", f"{tmp_path}/check", only=frozenset({"secondary_test"}), received_us=1).awaitTermination()
    assert not ChangeTable(spark, f"file://{tmp_path}/out/integration_test").exists()
    assert ChangeTable(spark, f"file://{tmp_path}/out/secondary_test").read().count() == 10


def test_items_of_all_orders(spark):
    """Beyond key 4999, where the registered SQL of item_comments ends."""
    from changeloom.plans import wires

    top = "/root/testdata/sf0.01"
    keys = [r[0] for r in spark.read.parquet(f"{top}/orders.parquet").select("o_orderkey").collect()]
    assert max(keys) > 4999
    read = {k for k in keys if k % 1000 != 999}
    live = {k for k in read if k >= 5 and k % 17}
    expected, level = set(), [(k, k) for k in read if k < 5]
    while level:
        level = [(c, s) for k, s in level for c in range(5 * k, 5 * k + 5) if c in live]
        expected |= {(c, s, c // 5 if c >= 25 else None, c) for c, s in level}
    assert {tuple(r) for r in wires.item_comments(spark, top).collect()} == expected
    parsed = wires._items(spark, top)
    assert {r["id"] for r in parsed.select("id").collect()} == read
    assert {r["id"] for r in wires.item_authors(spark, top).collect()} == {f"u{k % 10}" for k in read if k % 4}


def test_a_timed_run_drains_and_resumes_at_a_position(spark, tmp_path):
    from changeloom.streaming.runs import confirmed, drain, spool

    feed = [(10, wire.relation(1, "t", [("id", 23, True)])), *((20 + i, wire.insert(1, [i])) for i in range(7)), (99, b"?")]
    assert confirmed(spark, f"file://{tmp_path}/out").first()["lsn"] is None
    spool(spark.createDataFrame(feed, "lsn long, payload binary").coalesce(1), f"{tmp_path}/feed", max_rows=2)
    start = lambda out, **options: run_bronze(spark, f"{tmp_path}/feed", f"file://{tmp_path}/{out}", f"{tmp_path}/{out}-check", max_files=1, received_us=5, **options)
    drain(start("out", once=False, every="0 seconds"))
    epochs = ChangeTable(spark, f"file://{tmp_path}/out/_epochs").read()
    assert epochs.count() == 5  # of two rows at most
    assert sorted(r["id"] for r in ChangeTable(spark, f"file://{tmp_path}/out/t").read().collect()) == list(range(7))
    lsn, message = confirmed(spark, f"file://{tmp_path}/out").first()
    assert lsn == 99 and bytes(message) == wire.status_update(99)

    start("later", from_lsn=24).awaitTermination()
    assert sorted(r["id"] for r in ChangeTable(spark, f"file://{tmp_path}/later/t").read().collect()) == [4, 5, 6]


def test_copy_streams_are_read_piece_by_piece(spark, tmp_path, monkeypatch):
    rows = [[struct.pack(">i", i), None if i % 3 else b"x" * i] for i in range(300)]
    data = wire.copy_stream(rows)
    for size in (1, 7, 4096):
        assert list(wire.parse_copy(data[a : a + size] for a in range(0, len(data), size))) == rows
    with pytest.raises(wire.Bad):
        list(wire.parse_copy([data[:-30]]))
    (tmp_path / "a b.copy").write_bytes(data)
    t = catalog.Table("public", "t", (catalog.Column("id", "integer"), catalog.Column("x", "text")))
    got = sorted((r["id"], r["x"]) for r in wire.read_copy(spark, f"file://{tmp_path}", t, 5).collect())
    assert got == [(i, None if i % 3 else "x" * i) for i in range(300)]


def test_copy_streams_are_encoded_in_linear_time():
    began = time.monotonic()
    data = wire.copy_stream([[b"x" * 1000]] * 60_000)
    assert time.monotonic() - began < 10  # 60 MB; copying all of it for each row moves 2 TB
    assert sum(1 for _ in wire.parse_copy(data)) == 60_000


def test_copy_query_writes_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(wires, "COPY_ROWS", 1000)
    n, names = 5300, []
    customers = spark.range(n).selectExpr("id as c_custkey", "cast(id % 7 as int) as c_nationkey", "id / 4 as c_acctbal", "'SEG' as c_mktsegment")
    customers.repartition(2).write.parquet(f"{tmp_path}/all/customer.parquet")
    customers.limit(0).write.parquet(f"{tmp_path}/none/customer.parquet")
    monkeypatch.setattr(wire, "read_copy", lambda spark, files, *more, read=wire.read_copy: names.append(files) or read(spark, files, *more))
    got = sorted(tuple(r)[:4] for r in wires.wire_decode_copy(spark, f"{tmp_path}/all").collect())
    assert got == [(i, i % 7, i / 4, None if i % 9 == 0 else "SEG") for i in range(n)]
    assert len(names[0]) >= 6
    assert wires.wire_decode_copy(spark, f"{tmp_path}/none").count() == 0


def test_layouts_whose_types_differ_are_read_in_one_pass(spark):
    column = lambda n, k, key=False: catalog.Column(n, k, key=key)
    old = catalog.Table("public", "t", (column("id", "integer", True), column("x", "integer")), 1)
    new = catalog.Table("public", "t", (column("x", "bigint"), column("id", "integer", True), column("y", "text")), 1)
    feed = [(5, wire.insert(1, ["1", "7"])), (20, wire.insert(1, [str(2**40), "2", "z"])), (21, wire.update(1, ["3", "4", None], ["3", "2", None], b"O")), (6, wire.insert(9, ["1"]))]
    decoded = wire.decode_messages(spark.createDataFrame(feed, "lsn long, payload binary"))
    df = wire.typed_rows(decoded, [(1, old), (10, new)], unchanged=False, received_us=0)
    assert dict(df.dtypes)["x"] == "bigint"
    got = sorted((r["_cdc_lsn"], r["_cdc_op"], r["id"], r["x"], r["y"]) for r in df.collect())
    assert got == [(5, "INSERT", 1, 7, None), (20, "INSERT", 2, 2**40, "z"), (21, "DELETE", 2, 3, None), (21, "UPDATE", 4, 3, None)]
    assert df._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_catalog_is_read_over_jdbc(spark):
    """The four catalog queries, answered by frames in the place of a database."""
    frames = {
        "pg_class": spark.sql("select 1L oid, 't' relname, 9L relnamespace, 'r' relkind, 'd' relreplident"),
        "pg_namespace": spark.sql("select 9L oid, 'public' nspname"),
        "pg_attribute": spark.sql("select * from values (1L, 'id', 1, 'integer', true, false), (1L, 'x', 2, 'numeric(9,2)', false, false) t(attrelid, attname, attnum, type_name, attnotnull, attisdropped)"),
        "pg_index": spark.sql("select 1L indrelid, array(1) indkey, true indisprimary"),
    }

    class Session:
        class read:  # noqa: N801
            @staticmethod
            def jdbc(url, query, properties):
                assert url == "jdbc:x" and properties == {"user": "u"}
                return next(df for name, df in frames.items() if f"from {name})" in query)

    found = catalog.read_catalog(Session, "jdbc:x", {"user": "u"}).get("t")
    assert found.columns == (catalog.Column("id", "integer", False, True), catalog.Column("x", "numeric(9,2)", True, False))


def test_repeated_relation_messages_are_one_layout(spark):
    a, b = wire.relation(1, "t", [("id", 23, True)]), wire.relation(1, "t", [("id", 23, True), ("x", 25, False)])
    feed = spark.createDataFrame([(i, m) for i, m in enumerate((a, a, b, b, b, a, wire.relation(2, "u", [("id", 20, True)])))], "lsn long, payload binary")
    found = wire.tables_of(wire.relation_rows(wire.decode_messages(feed)))
    assert [(lsn, t.name, len(t.columns)) for lsn, t in found] == [(0, "t", 1), (2, "t", 2), (5, "t", 1), (6, "u", 1)]
