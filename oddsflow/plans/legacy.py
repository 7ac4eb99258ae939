"""The older table shapes some readers expect, over the new tables.

The newer market and runner tables renamed their columns; the older
presentation readers look for ``id``/``type_id`` on markets and ``id``/``name``
on runners.  These functions give those shapes without storing anything twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def legacy_market(market: DataFrame, market_type: DataFrame) -> DataFrame:
    """market as (id, type_id, event_id, kick_off, settled_time, scheduled_time)."""
    types = market_type.select(F.col("type").alias("market_type"), F.col("id").alias("type_id"))
    return market.join(types, "market_type", "left").select(
        F.col("market_id").alias("id"), "type_id", "event_id", "kick_off", "settled_time", "scheduled_time")


def legacy_runner(runner: DataFrame) -> DataFrame:
    """runner as distinct (id, name)."""
    return runner.select(F.col("runner_id").alias("id"), F.col("runner_name").alias("name")).distinct()


def create_legacy_views(spark: SparkSession, namespace: str) -> None:
    """Views ``<ns>.market_v1`` and ``<ns>.runner_v1`` over the new tables."""
    spark.sql(f"""
        CREATE OR REPLACE VIEW {namespace}.market_v1 AS
        SELECT m.market_id AS id, t.id AS type_id, m.event_id, m.kick_off, m.settled_time, m.scheduled_time
        FROM {namespace}.market m LEFT JOIN {namespace}.market_type t ON t.type = m.market_type""")
    spark.sql(f"""
        CREATE OR REPLACE VIEW {namespace}.runner_v1 AS
        SELECT DISTINCT runner_id AS id, runner_name AS name FROM {namespace}.runner""")
