"""Every registered query against its SQL."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from changeloom import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def sql_rows(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return sorted(columns), rows_of(columns, cur.fetchall())


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_its_sql(spark, sf_dir, name):
    df = registry.queries()[name](spark, sf_dir)
    columns, expected = sql_rows(registry.oracle_sql()[name], sf_dir)
    assert sorted(df.columns) == columns
    assert rows_of(df.columns, df.collect()) == expected


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
