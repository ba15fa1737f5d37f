from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from changeloom.functions import pgtypes, text
from changeloom.operators import serving
from changeloom.operators.audit import read_expected
from changeloom.operators.feed import barrier, committed_only
from changeloom.sources import catalog


def one(spark, expr, **cols):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in cols.items()] or [F.lit(1)])
    return df.select(expr.alias("x")).first()["x"]


def test_lsn(spark):
    assert one(spark, pgtypes.parse_lsn(F.lit("16/B374D848"))) == 0x16B374D848
    assert one(spark, pgtypes.format_lsn(F.lit(0x16B374D848))) == "16/B374D848"
    assert one(spark, pgtypes.parse_lsn(F.lit("x"))) is None


def test_both_time_forms(spark):
    us = lambda s: one(spark, F.unix_micros(pgtypes.normalised_timestamp(F.lit(s))))
    assert us("0") == pgtypes.PG_EPOCH_US
    assert us("-1000000") == pgtypes.PG_EPOCH_US - 1_000_000
    assert us("2000-01-01 00:00:01+00") == pgtypes.PG_EPOCH_US + 1_000_000
    assert us("nonsense") is None


def test_bool_and_arrays(spark):
    b = lambda s: one(spark, pgtypes.from_text(F.lit(s), "boolean"))
    assert (b("t"), b("true"), b("1"), b("f"), b("yes"), b(None)) == (True, True, True, False, False, None)
    a = lambda s: one(spark, pgtypes.int_array(F.lit(s)))
    assert (a("{}"), a("{1,NULL,3}"), a(None)) == ([], [1, None, 3], None)


def test_type_names():
    assert pgtypes.spark_type("real").typeName() == "float"
    assert pgtypes.spark_type("numeric(10,2)").typeName() == "string"
    assert pgtypes.spark_type("numeric(10,2)", exact_numeric=True).simpleString() == "decimal(10,2)"
    assert pgtypes.version_file(7) == "00000000000000000007.json"


def test_answers(spark):
    def read(s):
        summary, topics = text.answer(F.lit(s))
        r = spark.range(1).select(summary.alias("s"), topics.alias("t")).first()
        return r["s"], r["t"]

    assert read('```json\n{"summary": "x", "topics": ["a"]}\n```') == ("x", ["a"])
    assert read('so {"summary": ["x", "y"]} end') == ("x\ny", None)
    assert read("none") == ("none", None)
    assert read("{broken") == ("{broken", None)


def test_flatten(spark):
    f = lambda s: one(spark, text.flatten_strings(F.parse_json(F.lit(s))))
    assert f('"a"') == ["a"]
    assert f('["a", null, ["b", "c"], [], 3]') == ["a", "b"]


def test_expected_file(spark, tmp_path):
    (tmp_path / "e").write_text("COUNT=3\nSUM=1.5\n\nx\n")
    assert sorted(tuple(r) for r in read_expected(spark, f"file://{tmp_path}/e").collect()) == [("COUNT", "3"), ("SUM", "1.5")]


def test_null_orders(spark):
    df = spark.createDataFrame([(1, 5, None), (2, None, 1), (3, 9, 2)], "id int, score int, hn_rank int").withColumn("title", F.lit("t")).withColumn("posted_at", F.lit(None).cast("timestamp"))
    ids = lambda s, **k: [r["id"] for r in serving.listing(df, s, **k).collect()]
    assert ids("votes") == [2, 3, 1]
    assert ids("rank") == [2, 3, 1]
    assert ids("rank", limit=1, offset=1) == [3]


def test_clearing_no_ids_changes_nothing(spark):
    df = spark.createDataFrame([(1, 5), (2, None)], "id int, hn_rank int")
    none = spark.createDataFrame([], "id int")
    assert {tuple(r) for r in serving.clear_ranks_not_in(df, none).collect()} == {(1, 5), (2, None)}
    some = spark.createDataFrame([(2,)], "id int")
    assert {tuple(r) for r in serving.clear_ranks_not_in(df, some).collect()} == {(1, None), (2, None)}


def test_thread_tree_stops_at_loops_to_itself(spark):
    items = spark.createDataFrame([(1, 0), (2, 1), (3, 2), (4, 4)], "id long, parent_id long")
    got = serving.thread_tree(items, items.filter("id in (1, 4)")).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 0), (2, 1, 1), (3, 1, 2), (4, 4, 0)]


def test_transactions_and_barrier(spark):
    feed = spark.createDataFrame([(1, None, "SNAPSHOT"), (2, 7, "INSERT"), (3, 8, "INSERT"), (4, None, "INSERT")], "id int, xid long, _cdc_op string")
    marks = spark.createDataFrame([(7,), (7,)], "xid long")
    assert {r["id"] for r in committed_only(feed, marks).collect()} == {1, 2}
    assert not barrier(spark.createDataFrame([], "epoch long"), 1).first()["complete"]


def test_relations_take_catalog_types(spark):
    rel = spark.createDataFrame([("public", "t", "a", 23), ("public", "t", "b", 99999), ("public", "t", "c", 25)], "schema string, table_name string, column_name string, type_oid int")
    cat = spark.createDataFrame([("public", "t", "c", "jsonb", True)], "schema string, table_name string, column_name string, data_type string, is_key boolean")
    got = {r["column_name"]: (r["data_type"], r["is_key"]) for r in catalog.typed_relations(rel, cat).collect()}
    assert got == {"a": ("integer", False), "b": ("text", False), "c": ("jsonb", True)}


def test_registry(spark):
    cols = spark.createDataFrame([("public", "t", "d", "id", 1, "bigint", False, True), ("public", "t", "d", "v", 2, "text", True, False), ("public", "u", "d", "x", 1, "text", True, False)], "schema string, table_name string, identity string, column_name string, position int, data_type string, is_nullable boolean, is_key boolean")
    r = catalog.registry_of(cols, only=frozenset({"t"}))
    assert [t.name for t in r.all()] == ["t"] and r.get("u") is None
    assert r.get("t").struct()["id"].dataType.typeName() == "long" and r.get("t").struct()["id"].nullable


def test_config(tmp_path):
    from changeloom.config import load

    (tmp_path / ".env").write_text("# no\nOUTPUT_DIR=s3://lake\nTABLE_NAME=a, b\n\nx\n")
    c = load([], {"PG_CONNINFO": "host=h", "OUTPUT_DIR": "else"}, tmp_path / ".env")
    assert (c.connection, c.output, c.tables) == ("host=h", "s3://lake", frozenset({"a", "b"}))
    assert load(["host=arg"], {}, tmp_path / "none").connection == "host=arg"


def test_items_pass_over_dead_branches(spark):
    from changeloom.sources import items

    texts = ['{"id":1,"type":"story","kids":[2,3],"time":5}', '{"id":2,"type":"comment","deleted":true,"kids":[4]}', '{"id":3,"type":"comment","kids":[5],"by":"u"}', '{"id":4,"type":"comment"}', '{"id":5,"type":"comment"}', "null", "{"]
    df = items.parsed(spark.createDataFrame([(t,) for t in texts], "value string"))
    got = {(r["id"], r["story_id"], r["parent_id"]) for r in items.comments(df).collect()}
    assert got == {(3, 1, None), (5, 1, 3)}
    ranks = spark.createDataFrame([(1, 9)], "id long, hn_rank int")
    assert [(r["title"], r["score"], r["hn_rank"]) for r in items.stories(df, ranks).collect()] == [("", 0, 9)]


def test_results_and_snapshots_are_written_once(spark, tmp_path):
    from changeloom.operators.audit import write_results
    from changeloom.sources.txlog import ChangeTable
    from changeloom.streaming.runs import land_snapshot

    write_results(spark.createDataFrame([("COUNT", 3)], "key string, value int"), f"file://{tmp_path}/r")
    assert [tuple(r) for r in read_expected(spark, f"file://{tmp_path}/r").collect()] == [("COUNT", "3")]
    t = ChangeTable(spark, f"file://{tmp_path}/t")
    assert land_snapshot(t, spark.range(2)) and not land_snapshot(t, spark.range(5))
    assert t.read().count() == 2


def test_hierarchies_have_no_row_or_depth_cap(spark):
    from changeloom.sources import items

    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "50")
    try:
        chain = spark.range(1, 301).select("id", (F.col("id") - 1).alias("parent_id"))
        got = serving.thread_tree(chain, chain.filter("id in (1, 250)")).collect()
        assert sorted(tuple(r) for r in got) == sorted([(i, 1, i - 1) for i in range(1, 301)] + [(i, 250, i - 250) for i in range(250, 301)])
        texts = spark.range(1, 201).select(F.to_json(F.struct("id", F.when(F.col("id") == 1, "story").otherwise("comment").alias("type"), F.array(F.col("id") + 1).alias("kids"))).alias("value"))
        rows = items.comments(items.parsed(texts)).select("id", "story_id", "parent_id").collect()
        assert sorted((tuple(r) for r in rows), key=str) == sorted(((i, 1, i - 1 if i > 2 else None) for i in range(2, 201)), key=str)
    finally:
        spark.conf.set(key, before)


def test_loops_in_hierarchies(spark):
    items = spark.createDataFrame([(1, 0), (2, 1), (7, 8), (8, 7), (9, 8)], "id long, parent_id long")
    assert sorted(tuple(r) for r in serving.thread_tree(items, items.filter("id = 1")).collect()) == [(1, 1, 0), (2, 1, 1)]
    with pytest.raises(ValueError, match="loop"):
        serving.thread_tree(items, items.filter("id = 8"))


def test_a_tree_of_more_than_a_million_rows(spark):
    n = 1_100_000
    items = spark.range(1, n).select("id", F.when(F.col("id") % 1000 == 1, F.lit(0)).otherwise(F.col("id") - 1).alias("parent_id")).union(spark.sql("select 0L, null"))
    got = serving.thread_tree(items, items.filter("id = 0")).agg(F.count("*").alias("n"), F.max("depth").alias("d"), F.sum("depth").alias("s")).first()
    assert tuple(got) == (n, 1000, sum((i - 1) % 1000 + 1 for i in range(1, n)))


def test_changes_by_condition_and_report(spark, capsys):
    from changeloom.operators.audit import report

    rows = spark.createDataFrame([(1, 1.0), (2, None), (None, 3.0)], "id long, score double")
    got = serving.update_where(rows, F.col("id") > 1, {"score": F.lit(9)})
    assert got.dtypes == rows.dtypes and sorted(map(tuple, got.collect()), key=str) == sorted([(1, 1.0), (2, 9.0), (None, 3.0)], key=str)
    assert sorted((r["id"] for r in serving.delete_where(rows, F.col("id") == 1).collect()), key=str) == [2, None]
    checks = spark.createDataFrame([("a", True), ("b", True)], "check string, passed boolean")
    assert report(checks) and not report(checks.union(spark.sql("select 'c', null")))
    assert "|a    |true  |" in capsys.readouterr().out
