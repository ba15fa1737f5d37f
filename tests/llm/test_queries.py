"""Registered queries that SQL can express, against it."""

from __future__ import annotations

import os

import duckdb
import pytest

from changeloom.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"create view {t} as select * from '{os.path.join(sf_dir, t)}.parquet'")
    cur = con.execute(queries.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    df = queries.queries()[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == sorted(map(tuple, cur.fetchall()), key=repr)
