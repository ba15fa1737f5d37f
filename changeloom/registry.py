"""The registered queries over change feeds, wire formats and the listing service, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .plans import feeds, landing, services, wires

_ALL = feeds.QUERIES | wires.QUERIES | services.QUERIES | landing.QUERIES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for name, (query, _) in _ALL.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _ALL.items() if sql is not None}
