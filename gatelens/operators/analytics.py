"""Count, date histogram and group-by over request documents."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gatelens.functions.predicates import select_documents
from gatelens.functions.time import TimeRange, bucket_floor, bucket_start, current_millis, restrict_today
from gatelens.schemas import column_name

HISTOGRAM_TERMS = 10  # terms kept per bucket unless asked otherwise
GROUP_TERMS = 20  # terms kept by a group-by unless asked otherwise
BROADCAST_BUCKETS = 200_000  # a histogram of at most this many buckets is a few MB

POINTS = "ordinal INT, timestamp BIGINT, aggregation STRING, field STRING, key STRING, value BIGINT"


@dataclass(frozen=True)
class Aggregation:
    """One series a histogram computes: ``avg``/``min``/``max`` of a field, or its terms."""

    kind: str
    field: str

    def __post_init__(self):
        if self.kind not in ("avg", "min", "max", "field"):
            raise ValueError(f"unknown aggregation {self.kind!r}")

    @property
    def name(self) -> str:
        return f"by_{self.field}" if self.kind == "field" else f"{self.kind}_{self.field}"

    @property
    def column(self) -> str:
        return column_name(self.field)


def avg(field: str) -> Aggregation:
    return Aggregation("avg", field)


def minimum(field: str) -> Aggregation:
    return Aggregation("min", field)


def maximum(field: str) -> Aggregation:
    return Aggregation("max", field)


def terms(field: str) -> Aggregation:
    return Aggregation("field", field)


def metric(aggregation: Aggregation) -> Column:
    return {"avg": F.avg, "min": F.min, "max": F.max}[aggregation.kind](F.col(aggregation.column))


def is_finite(value: Column) -> Column:
    value = value.cast("double")
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def truncated(value: Column) -> Column:
    """Toward zero; null for what is empty, NaN or infinite (a cast would raise)."""
    return F.when(is_finite(value), value.cast("bigint"))


# --- count ------------------------------------------------------------------


def count(
    docs: DataFrame,
    time_range: TimeRange | None = None,
    root: tuple[str, str] | None = None,
    query: str | Column | None = None,
    default_scope: str = "all",
    now: int | None = None,
    zone: str = "UTC",
) -> DataFrame:
    """Number of matching documents.

    Without a time range all days are read, or today only with
    ``default_scope="today"``.
    """
    if default_scope not in ("all", "today"):
        raise ValueError(f"unknown scope {default_scope!r}")
    if time_range is None and default_scope == "today":
        docs = restrict_today(docs, current_millis() if now is None else now, zone)
    return select_documents(docs, time_range, root, query, zone).agg(F.count("*").alias("count"))


# --- date histogram ----------------------------------------------------------


def histogram_axis(spark: SparkSession, time_range: TimeRange, interval: int) -> DataFrame:
    """Every bucket start from the one of ``start`` to the one of ``end``."""
    first, last = bucket_floor(time_range.start, interval), bucket_floor(time_range.end, interval)
    slices = (last - first) // interval // BROADCAST_BUCKETS + 1
    return spark.range(first, last + 1, interval, slices).withColumnRenamed("id", "timestamp")


def bucket_of(interval: int) -> Column:
    return bucket_start(F.unix_millis("ts"), interval).alias("timestamp")


def histogram_counts(
    docs: DataFrame,
    time_range: TimeRange,
    interval: int,
    root: tuple[str, str] | None = None,
    query: str | Column | None = None,
    zone: str = "UTC",
) -> DataFrame:
    """Documents per bucket, empty buckets included.

    The documents are reduced to one row per bucket first; only that goes into
    the join with the axis.  Its size is known from the parameters, and it is
    broadcast while it is small.
    """
    selected = select_documents(docs, time_range, root, query, zone)
    counted = selected.groupBy(bucket_of(interval)).agg(F.count("*").alias("n"))
    if (time_range.end - time_range.start) // interval < BROADCAST_BUCKETS:
        counted = F.broadcast(counted)
    axis = histogram_axis(docs.sparkSession, time_range, interval)
    return axis.join(counted, "timestamp", "left").select(
        "timestamp", F.coalesce("n", F.lit(0).cast("bigint")).alias("count")
    )


def date_histogram(
    docs: DataFrame,
    time_range: TimeRange,
    interval: int,
    aggregations: Sequence[Aggregation],
    root: tuple[str, str] | None = None,
    query: str | Column | None = None,
    term_limit: int = HISTOGRAM_TERMS,
    zone: str = "UTC",
) -> DataFrame:
    """Points of every requested series, in long form.

    However many series are asked for, the documents are read once: metrics
    share the grouping by bucket, each term field is one more grouping set.
    ``ordinal`` is the position of the series in the request.
    """
    selected = select_documents(docs, time_range, root, query, zone)
    if not aggregations:
        return docs.sparkSession.createDataFrame([], POINTS)
    return histogram_points(selected, interval, aggregations, term_limit)


def histogram_points(
    selected: DataFrame, interval: int, aggregations: Sequence[Aggregation], term_limit: int
) -> DataFrame:
    metrics = list(dict.fromkeys(a for a in aggregations if a.kind != "field"))
    fields = list(dict.fromkeys(a.column for a in aggregations if a.kind == "field"))

    measures = {a: f"measure_{n}" for n, a in enumerate(metrics)}
    measured = [metric(a).alias(name) for a, name in measures.items()]
    # Grouping fields get names of their own: a field may be measured and grouped by.
    keys = {field: f"group_{n}" for n, field in enumerate(fields)}
    rows = selected.select(
        bucket_of(interval),
        *[F.col(field).alias(key) for field, key in keys.items()],
        *[F.col(c) for c in dict.fromkeys(a.column for a in metrics)],
    )

    sets = ([["timestamp"]] if metrics else []) + [["timestamp", key] for key in keys.values()]
    if len(sets) == 1:
        grouped = rows.groupBy(*sets[0]).agg(
            F.count("*").alias("n"), *measured, F.lit(0 if metrics else 1).alias("grouping")
        )
        marks = {key: 1 for key in keys.values()}
    else:
        columns = ["timestamp", *keys.values()]
        grouped = rows.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in columns]).agg(
            F.count("*").alias("n"), *measured, F.grouping_id().alias("grouping")
        )
        # grouping_id has one bit per column, set where the column is rolled up.
        everything = 2 ** len(keys) - 1
        marks = {key: everything - 2 ** (len(keys) - 1 - n) for n, key in enumerate(keys.values())}

    if fields:
        term = F.coalesce(*[F.when(F.col("grouping") == mark, F.col(key).cast("string")) for key, mark in marks.items()])
        is_term = F.col("grouping").isin(list(marks.values()))
        # row_number <= k is planned as a group limit before the shuffle, so a
        # bucket sends at most k rows per task however many terms it holds.
        order = Window.partitionBy("timestamp", "grouping").orderBy(F.desc("n"), F.asc("term"))
        grouped = (
            grouped.withColumn("term", term)
            .where(~is_term | F.col("term").isNotNull())
            .withColumn("place", F.row_number().over(order))
            .where(F.col("place") <= term_limit)
        )

    points = []
    for ordinal, a in enumerate(aggregations):
        if a.kind == "field":
            belongs, key, value = F.col("grouping") == marks[keys[a.column]], F.col("term"), F.col("n")
        else:
            value = truncated(F.col(measures[a]))
            belongs, key = value.isNotNull(), F.lit(a.name)
            if fields:
                belongs = belongs & ~is_term
        point = F.struct(
            F.lit(ordinal).alias("ordinal"),
            F.col("timestamp"),
            F.lit(a.kind).alias("aggregation"),
            F.lit(a.field).alias("field"),
            key.alias("key"),
            value.alias("value"),
        )
        points.append(F.when(belongs, point))
    return grouped.select(F.inline(F.filter(F.array(*points), lambda p: p.isNotNull())))


# --- group by ----------------------------------------------------------------


@dataclass(frozen=True)
class Sort:
    """Order of a group-by: the mean of a field, ``asc`` or ``desc``."""

    field: str
    order: str = "desc"
    kind: str = "avg"

    def __post_init__(self):
        if self.kind != "avg":
            raise ValueError("only the mean of a field can order a group-by")
        if self.order not in ("asc", "desc"):
            raise ValueError(f"unknown order {self.order!r}")


def ranked(top: DataFrame, *order: Column) -> DataFrame:
    """Adds ``rank`` to a frame already cut to its top rows (so one task is enough)."""
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("int"))


def top_terms(docs: DataFrame, field: str, limit: int) -> DataFrame:
    """Terms of a field with the most documents; nulls are no term."""
    key = F.col(column_name(field))
    counted = docs.where(key.isNotNull()).groupBy(key.alias("key")).agg(F.count("*").alias("value"))
    order = (F.desc("value"), F.asc("key"))
    return ranked(counted.orderBy(*order).limit(limit), *order)


def top_terms_by_mean(docs: DataFrame, field: str, sort: Sort, limit: int) -> DataFrame:
    key = F.col(column_name(field))
    means = (
        docs.where(key.isNotNull())
        .groupBy(key.alias("key"))
        .agg(F.avg(column_name(sort.field)).alias("mean"))
        .where(is_finite(F.col("mean")))
    )
    order = (F.desc("mean") if sort.order == "desc" else F.asc("mean"), F.asc("key"))
    top = ranked(means.orderBy(*order).limit(limit), *order)
    return top.select("key", truncated(F.col("mean")).alias("value"), "rank")


def range_key(start: float, end: float) -> Column:
    """Label of a numeric range: ``100.0-199.0``."""
    return F.concat_ws("-", F.lit(float(start)).cast("string"), F.lit(float(end)).cast("string"))


def range_counts(docs: DataFrame, field: str, ranges: Sequence[tuple[float, float]]) -> DataFrame:
    """Documents per numeric range, ``from`` included and ``to`` excluded.

    One pass for all ranges; they may overlap, and an empty one stays with 0.
    """
    column = F.col(column_name(field))
    ordered = sorted(ranges)
    counts = docs.agg(
        *[F.count_if((column >= start) & (column < end)).alias(f"n{i}") for i, (start, end) in enumerate(ordered)]
    )
    buckets = [
        F.struct(
            range_key(start, end).alias("key"),
            F.col(f"n{i}").alias("value"),
            F.lit(i + 1).alias("rank"),
        )
        for i, (start, end) in enumerate(ordered)
    ]
    return counts.select(F.inline(F.array(*buckets)))


def group_by(
    docs: DataFrame,
    field: str,
    time_range: TimeRange | None = None,
    root: tuple[str, str] | None = None,
    query: str | Column | None = None,
    ranges: Sequence[tuple[float, float]] = (),
    sort: Sort | None = None,
    limit: int = GROUP_TERMS,
    zone: str = "UTC",
) -> DataFrame:
    """Terms of a field by count or by a mean, or counts over numeric ranges."""
    selected = select_documents(docs, time_range, root, query, zone)
    if ranges:
        grouped = range_counts(selected, field, ranges)
    elif sort is not None:
        grouped = top_terms_by_mean(selected, field, sort, limit)
    else:
        grouped = top_terms(selected, field, limit)
    return grouped.select(F.lit(field).alias("field"), F.col("key").cast("string").alias("key"), "value", "rank")
