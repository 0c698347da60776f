"""API-gateway analytics on Spark: plain functions from DataFrames to DataFrames."""

from gatelens.functions.time import TimeRange, between, days, hours, last_days, minutes
from gatelens.operators.analytics import (
    Aggregation,
    Sort,
    avg,
    count,
    date_histogram,
    group_by,
    maximum,
    minimum,
    terms,
)
from gatelens.operators.health import (
    availability,
    average_response_time,
    find_health,
    health_histogram,
    health_logs,
)
from gatelens.operators.logs import find_requests, missing_ids, tabular
from gatelens.operators.monitoring import latest_per_gateway, latest_snapshot
from gatelens.operators.shaping import assemble_dense, assemble_series
from gatelens.store import GatewayStore

__all__ = [
    "Aggregation",
    "GatewayStore",
    "Sort",
    "TimeRange",
    "assemble_dense",
    "assemble_series",
    "availability",
    "average_response_time",
    "avg",
    "between",
    "count",
    "date_histogram",
    "days",
    "find_health",
    "find_requests",
    "group_by",
    "health_histogram",
    "health_logs",
    "hours",
    "last_days",
    "latest_per_gateway",
    "latest_snapshot",
    "maximum",
    "minimum",
    "minutes",
    "missing_ids",
    "tabular",
    "terms",
]
