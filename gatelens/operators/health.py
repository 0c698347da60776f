"""Health checks: availability, response time, histogram, logs, lookups.

Every one of them reads whole days from one calendar month before ``now`` to
today; the rolling windows inside are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelens.functions.documents import extended_health_columns, health_columns
from gatelens.functions.predicates import select_documents
from gatelens.functions.time import (
    TimeRange,
    current_millis,
    days,
    instant,
    restrict_last_month,
    rolling_windows,
)
from gatelens.operators.analytics import (
    Aggregation,
    bucket_of,
    histogram_axis,
    is_finite,
    metric,
    ranked,
    truncated,
)
from gatelens.operators.logs import Pages, must_exist, page_and_total, pick_ids
from gatelens.schemas import column_name

WINDOW_TERMS = 10  # endpoints or gateways reported
AXIS_CHUNK = 10_000  # buckets of the axis that one row expands to
MONTH_DAYS = 32  # days that the last month and today cover at most

HEALTH_POINTS = "ordinal INT, timestamp BIGINT, aggregation STRING, field STRING, key STRING, value DOUBLE"


def recent(
    docs: DataFrame,
    api: str | None,
    query: str | Column | None = None,
    now: int | None = None,
    zone: str = "UTC",
) -> DataFrame:
    """Health documents of the last month for an API."""
    now = current_millis() if now is None else now
    root = None if api is None else ("api", api)
    return select_documents(restrict_last_month(docs, now, zone), root=root, query=query)


def percent(success: Column, total: Column) -> Column:
    """Share of successes; of nothing it is 100."""
    return F.when(total == 0, F.lit(100.0)).otherwise(success / total * 100)


def over_windows(
    docs: DataFrame,
    field: str,
    now: int,
    limit: int,
    measures: Callable[[Column], dict[str, Column]],
    value: Callable[[str], Column],
) -> DataFrame:
    """Per term of ``field`` and rolling window: one aggregation, then the top terms.

    ``measures`` gives a window's aggregates, ``value`` its result from them.
    The windows overlap, so each is a conditional aggregate of the same pass
    and the groups number no more than the terms.
    """
    field = column_name(field.lower())
    if field not in ("endpoint", "gateway"):
        raise ValueError(f"cannot group health checks by {field!r}")
    windows = rolling_windows(now)
    aggregates = [
        column.alias(f"{name}_{n}")
        for n, (_, start) in enumerate(windows)
        for name, column in measures(F.col("ts") >= instant(start)).items()
    ]
    grouped = (
        docs.where(F.col(field).isNotNull())
        .groupBy(F.col(field).alias("key"))
        .agg(F.count("*").alias("documents"), *aggregates)
    )
    order = (F.desc("documents"), F.asc("key"))
    top = ranked(grouped.orderBy(*order).limit(limit), *order)
    buckets = F.array(
        *[
            F.struct(F.lit(label).alias("range"), F.lit(start).cast("bigint").alias("from"), value(str(n)).alias("value"))
            for n, (label, start) in enumerate(windows)
        ]
    )
    return top.select("key", "rank", buckets.alias("buckets"))


def availability(
    docs: DataFrame,
    api: str | None,
    field: str = "endpoint",
    query: str | Column | None = None,
    now: int | None = None,
    limit: int = WINDOW_TERMS,
    zone: str = "UTC",
) -> DataFrame:
    """Percent of available checks per endpoint or gateway and rolling window."""
    now = current_millis() if now is None else now
    available = F.col("available")
    grouped = over_windows(
        recent(docs, api, query, now, zone),
        field,
        now,
        limit,
        lambda inside: {
            "up": F.count_if(inside & available),
            "all": F.count_if(inside & available.isNotNull()),
        },
        lambda n: percent(F.col(f"up_{n}"), F.col(f"all_{n}")),
    )
    return grouped.select("key", "rank", F.inline("buckets")).withColumnRenamed("value", "percent")


def average_response_time(
    docs: DataFrame,
    api: str | None,
    field: str = "endpoint",
    query: str | Column | None = None,
    now: int | None = None,
    limit: int = WINDOW_TERMS,
    zone: str = "UTC",
) -> DataFrame:
    """Mean response time per endpoint or gateway and rolling window, truncated.

    An empty window counts 0; a term whose windows are all 0 is left out after
    the top terms are chosen.
    """
    now = current_millis() if now is None else now
    grouped = over_windows(
        recent(docs, api, query, now, zone),
        field,
        now,
        limit,
        lambda inside: {"mean": F.avg(F.when(inside, F.col("response_time")))},
        lambda n: F.coalesce(truncated(F.col(f"mean_{n}")), F.lit(0).cast("bigint")),
    )
    nonzero = grouped.where(F.exists("buckets", lambda b: b["value"] != 0))
    return nonzero.select("key", "rank", F.inline("buckets"))


# --- histogram ---------------------------------------------------------------


def health_histogram_dense(
    docs: DataFrame,
    time_range: TimeRange,
    interval: int,
    aggregations: Sequence[Aggregation] = (),
    api: str | None = None,
    query: str | Column | None = None,
    now: int | None = None,
    zone: str = "UTC",
) -> DataFrame:
    """One row per bucket: ``timestamp, count`` and a ``series_<n>`` per aggregation.

    The bounds only extend the axis; documents outside them still count.  The
    documents are read once and reduced to one row per bucket.  A rollup of
    those few rows adds a total row that knows the outermost buckets; it expands
    to the stretch between them, and a last grouping merges it all.
    """
    selected = recent(docs, api, query, now, zone).where(F.col("ts").isNotNull())
    series = {f"series_{n}": health_series(a) for n, a in enumerate(aggregations)}
    per_bucket = selected.groupBy(bucket_of(interval)).agg(
        F.count("*").alias("count"), *[column.alias(name) for name, column in series.items()]
    )
    names = ["count", *series]
    spread = (
        per_bucket.withColumn("bucket", F.col("timestamp"))
        .rollup("timestamp")
        .agg(
            F.grouping("timestamp").alias("is_total"),
            F.min("bucket").alias("first"),
            F.max("bucket").alias("last"),
            *[F.max(name).alias(name) for name in names],
        )
    )
    # The stretch between the outermost buckets grows in two steps, so that many tasks share a long one.
    is_total = F.col("is_total") == 1
    step, span = F.lit(interval).cast("bigint"), F.lit(interval * AXIS_CHUNK).cast("bigint")
    begin = F.explode(F.when(is_total, F.sequence("first", "last", span)).otherwise(F.array("timestamp"))).alias("begin")
    chunks = spread.select("is_total", "last", begin, *names)
    if days(MONTH_DAYS) // interval > AXIS_CHUNK:
        chunks = chunks.repartition("begin")
    chunk = F.sequence("begin", F.least("last", F.col("begin") + span - step), step)
    rows = chunks.select(
        F.explode(F.when(is_total, chunk).otherwise(F.array("begin"))).alias("timestamp"),
        *[F.when(~is_total, F.col(name)).alias(name) for name in names],
    )
    axis = histogram_axis(docs.sparkSession, time_range, interval)
    dense = axis.unionByName(rows, allowMissingColumns=True).groupBy("timestamp")
    merged = dense.agg(*[F.max(name).alias(name) for name in names])
    return merged.withColumn("count", F.coalesce("count", F.lit(0).cast("bigint")))


def health_series(aggregation: Aggregation) -> Column:
    """A metric truncated, or for a term field the percent of true among non-null.

    True is also 1, as old documents hold it; any other term is a failure.
    """
    if aggregation.kind == "field":
        term = F.col(aggregation.column)
        known = F.count(term)
        return F.when(known > 0, percent(F.count_if(term.cast("string").isin("true", "1")), known))
    value = metric(aggregation)
    return F.when(is_finite(value), truncated(value).cast("double"))


def health_points(dense: DataFrame, aggregations: Sequence[Aggregation]) -> DataFrame:
    """Long form of the dense histogram: one point per series and non-empty bucket."""
    if not aggregations:
        return dense.sparkSession.createDataFrame([], HEALTH_POINTS)
    points = [
        F.struct(
            F.lit(n).alias("ordinal"),
            F.col("timestamp"),
            F.lit(a.kind).alias("aggregation"),
            F.lit(a.field).alias("field"),
            F.lit(a.name).alias("key"),
            F.col(f"series_{n}").alias("value"),
        )
        for n, a in enumerate(aggregations)
    ]
    return dense.select(F.inline(F.filter(F.array(*points), lambda p: p["value"].isNotNull())))


def health_histogram(
    docs: DataFrame,
    time_range: TimeRange,
    interval: int,
    aggregations: Sequence[Aggregation],
    api: str | None = None,
    query: str | Column | None = None,
    now: int | None = None,
    zone: str = "UTC",
) -> DataFrame:
    """Points of every requested series of the last month's health checks."""
    dense = health_histogram_dense(docs, time_range, interval, aggregations, api, query, now, zone)
    return health_points(dense, aggregations)


# --- logs and lookups --------------------------------------------------------


def health_logs(
    docs: DataFrame,
    api: str | None,
    page: int = 1,
    size: int = 20,
    query: str | Column | None = None,
    now: int | None = None,
    zone: str = "UTC",
) -> DataFrame:
    """One page of the last month's health logs beside their total."""
    rows, total = page_and_total(recent(docs, api, query, now, zone), page, size)
    return rows.select(*health_columns(), total.alias("total"))


def health_log_pages(
    docs: DataFrame,
    api: str | None,
    size: int,
    folder: str,
    query: str | Column | None = None,
    now: int | None = None,
    zone: str = "UTC",
) -> Pages:
    """All pages of the last month's health logs, ordered once, into ``folder``."""
    return Pages(recent(docs, api, query, now, zone).select(*health_columns()), size, folder)


def find_health(docs: DataFrame, ids: DataFrame | Iterable[str], strict: bool = False) -> DataFrame:
    """Extended health logs of the listed ids; ``strict`` fails on an unknown id."""
    if not isinstance(ids, DataFrame):
        ids = list(ids)
    found = pick_ids(docs, ids).select(*extended_health_columns())
    return must_exist(found, ids, "health check") if strict else found
