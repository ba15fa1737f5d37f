"""Deterministic change feeds from the driver's tables: over ``orders`` (six legs) and over ``events``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WATERMARK = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders_feed(orders: DataFrame) -> DataFrame:
    """All legs from one scan: each order gives an array of the changes that it has.

    Snapshot rows at the watermark, inserts, stale replays below the watermark, updates, key-only deletes, re-inserts.
    """
    key = F.col("o_orderkey").cast("long")
    status, amount = F.col("o_orderstatus"), F.col("o_totalprice").cast("double")

    def leg(when, op: str, lsn, status=status, amount=amount, time=None):
        lsn = lsn.cast("long")
        time = lsn if time is None else F.lit(time).cast("long")
        return F.when(when, F.struct(key.alias("id"), status.cast("string").alias("status"), amount.cast("double").alias("amount"), F.lit(op).alias("_cdc_op"), time.alias("_cdc_timestamp"), lsn.alias("_cdc_lsn")))

    legs = F.array_compact(
        F.array(
            leg(key % 10 < 6, "SNAPSHOT", F.lit(WATERMARK), time=0),
            leg(key % 10 >= 6, "INSERT", key + 2_000_000),
            leg(key % 11 == 0, "INSERT", key + 500_000),
            leg(key % 3 == 0, "UPDATE", key + 3_000_000, F.lit("U"), amount + 100),
            leg(key % 7 == 0, "DELETE", key + 4_000_000, F.lit(None), F.lit(None)),
            leg(key % 35 == 0, "INSERT", key + 5_000_000),
        )
    )
    return orders.select(F.inline(legs))


def events_feed(events: DataFrame) -> DataFrame:
    """Keyed by user; positions are event ids."""
    kind = F.col("event_type")
    op = F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").otherwise("UPDATE")
    eid = F.col("event_id").cast("long")
    return events.select(F.col("user_id").cast("long").alias("id"), "event_type", F.col("value").cast("double").alias("value"), op.alias("_cdc_op"), eid.alias("_cdc_timestamp"), eid.alias("_cdc_lsn"))


#: The same feeds as SQL text, for the oracles.
ORDERS_FEED_SQL = """
feed as (
  select cast(o_orderkey as bigint) as id, o_orderstatus as status, cast(o_totalprice as double) as amount, 'SNAPSHOT' as _cdc_op, cast(0 as bigint) as _cdc_timestamp, cast(1000000 as bigint) as _cdc_lsn from orders where o_orderkey % 10 < 6
  union all select cast(o_orderkey as bigint), o_orderstatus, cast(o_totalprice as double), 'INSERT', cast(2000000 + o_orderkey as bigint), cast(2000000 + o_orderkey as bigint) from orders where o_orderkey % 10 >= 6
  union all select cast(o_orderkey as bigint), o_orderstatus, cast(o_totalprice as double), 'INSERT', cast(500000 + o_orderkey as bigint), cast(500000 + o_orderkey as bigint) from orders where o_orderkey % 11 = 0
  union all select cast(o_orderkey as bigint), 'U', cast(o_totalprice + 100 as double), 'UPDATE', cast(3000000 + o_orderkey as bigint), cast(3000000 + o_orderkey as bigint) from orders where o_orderkey % 3 = 0
  union all select cast(o_orderkey as bigint), cast(null as varchar), cast(null as double), 'DELETE', cast(4000000 + o_orderkey as bigint), cast(4000000 + o_orderkey as bigint) from orders where o_orderkey % 7 = 0
  union all select cast(o_orderkey as bigint), o_orderstatus, cast(o_totalprice as double), 'INSERT', cast(5000000 + o_orderkey as bigint), cast(5000000 + o_orderkey as bigint) from orders where o_orderkey % 35 = 0
),
guarded as (select * from feed where _cdc_op = 'SNAPSHOT' or _cdc_lsn >= 1000000)"""
EVENTS_FEED_SQL = """
efeed as (select cast(user_id as bigint) as id, event_type, cast(value as double) as value,
  case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' else 'UPDATE' end as _cdc_op,
  cast(event_id as bigint) as _cdc_timestamp, cast(event_id as bigint) as _cdc_lsn from events)"""
