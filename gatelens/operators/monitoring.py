"""Latest monitoring snapshot of gateways."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatelens.functions.documents import monitoring_columns
from gatelens.functions.predicates import equals
from gatelens.functions.time import current_millis, restrict_today
from gatelens.operators.logs import newest_first


def latest_snapshot(docs: DataFrame, gateway: str, now: int | None = None, zone: str = "UTC") -> DataFrame:
    """Newest snapshot of one gateway today; no row when there is none."""
    today = restrict_today(docs, current_millis() if now is None else now, zone)
    newest = newest_first(today.where(equals("gateway", gateway))).limit(1)
    return newest.select(*monitoring_columns())


def latest_per_gateway(docs: DataFrame, now: int | None = None, zone: str = "UTC") -> DataFrame:
    """Newest snapshot of every gateway today.

    The newest instant per gateway is a hash aggregate over two narrow columns;
    the wide documents are then read only where they match it, instead of
    sorting them all.  Equal instants are settled by the larger id.
    """
    today = restrict_today(docs, current_millis() if now is None else now, zone)
    today = today.withColumn("millis", F.unix_millis("ts"))
    newest = today.groupBy("gateway").agg(F.max("millis").alias("millis"))
    candidates = today.join(newest, ["gateway", "millis"], "left_semi")
    order = Window.partitionBy("gateway").orderBy(F.desc("id"))
    chosen = candidates.withColumn("place", F.row_number().over(order)).where(F.col("place") == 1)
    return chosen.select(*monitoring_columns())
