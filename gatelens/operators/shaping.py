"""Long-form results assembled into the nested responses, inside the plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelens.functions.time import bucket_start
from gatelens.operators.analytics import HISTOGRAM_TERMS, Aggregation

# Points that a response of one row may hold, some tens of MB.
RESPONSE_POINTS = 1_000_000


def response_fits(buckets: int, aggregations: Sequence[Aggregation]) -> None:
    """Raises where a response of one row could hold more points than it may."""
    series = sum(HISTOGRAM_TERMS if a.kind == "field" else 1 for a in aggregations)
    if buckets * (series + 1) > RESPONSE_POINTS:
        raise ValueError(f"{buckets} buckets of up to {series} points are too many for one row; ask for them in pieces")


def series(points: DataFrame) -> DataFrame:
    """One row per series key with its points in time order.

    A group is at most as long as the histogram's axis.
    """
    ordered = F.array_sort(F.collect_list(F.struct("timestamp", "value")))
    return points.groupBy("ordinal", "aggregation", "field", "key").agg(ordered.alias("points"))


# Points, or axis entries, that one row of a chunked response holds at most.
CHUNK_POINTS = 1_000


def chunk_start(interval: int, size: int) -> Column:
    """Where the stretch of ``size`` buckets begins that a bucket lies in."""
    return bucket_start(F.col("timestamp"), interval * size)


def series_chunks(points: DataFrame, aggregations: Sequence[Aggregation], interval: int, size: int = CHUNK_POINTS) -> DataFrame:
    """The series of a response in pieces: ``slot, name, field, key, chunk_start, points``, in the order of the request.

    A piece holds the points of ``size`` buckets at most, so neither a task nor a row grows with the histogram. A series
    without any point has one row, with null key and points.
    """
    slots = [(n, a.name, a.field) for n, a in enumerate(aggregations)]
    requested = points.sparkSession.createDataFrame(slots, "slot int, name string, field string")
    ordered = F.array_sort(F.collect_list(F.struct("timestamp", "value")))
    found = points.groupBy(F.col("ordinal").alias("slot"), "key", chunk_start(interval, size).alias("chunk_start")).agg(ordered.alias("points"))
    return requested.join(found, "slot", "left")


def axis_chunks(axis: DataFrame, interval: int, size: int = CHUNK_POINTS) -> DataFrame:
    """The axis in pieces: ``chunk_start, timestamps``."""
    return axis.groupBy(chunk_start(interval, size).alias("chunk_start")).agg(F.array_sort(F.collect_list("timestamp")).alias("timestamps"))


def joined_chunks(chunks: DataFrame) -> DataFrame:
    """One row per series out of its pieces, for a reader that wants it whole. It is as long as the histogram's axis."""
    pieces = F.array_sort(F.collect_list(F.struct("chunk_start", "points")))
    rows = chunks.groupBy("slot", "name", "field", "key").agg(pieces.alias("pieces"))
    points = F.when(F.col("key").isNotNull(), F.flatten(F.transform("pieces", lambda piece: piece["points"])))
    return rows.select("slot", "name", "field", "key", points.alias("points"))


def series_rows(points: DataFrame, aggregations: Sequence[Aggregation]) -> DataFrame:
    """One row per requested series and key: ``slot, name, field, key, points``, in the order of the request.

    A series without any point has one row, with null key and points.
    """
    slots = [(n, a.name, a.field) for n, a in enumerate(aggregations)]
    requested = points.sparkSession.createDataFrame(slots, "slot int, name string, field string")
    found = series(points).select(F.col("ordinal").alias("slot"), "key", "points")
    return requested.join(found, "slot", "left")


def timestamps(axis: DataFrame) -> DataFrame:
    """The axis as one ordered array."""
    return axis.agg(F.array_sort(F.collect_list("timestamp")).alias("timestamps"))


def assemble_series(points: DataFrame, axis: DataFrame, aggregations: Sequence[Aggregation]) -> DataFrame:
    """One row ``timestamps, values``; values follow the order of the request.

    A series without any point keeps its slot, as null. The row is as large as the histogram, so this is for histograms
    that a reader takes whole (``response_fits``); others come in pieces (``series_chunks``).
    """
    by_key = series(points).groupBy("ordinal").agg(
        F.map_from_entries(F.collect_list(F.struct("key", "points"))).alias("data")
    )
    by_ordinal = by_key.agg(F.map_from_entries(F.collect_list(F.struct("ordinal", "data"))).alias("found"))
    slots = []
    for ordinal, a in enumerate(aggregations):
        data = F.try_element_at(F.col("found"), F.lit(ordinal))
        slot = F.struct(F.lit(a.name).alias("name"), F.lit(a.field).alias("field"), data.alias("data"))
        slots.append(F.when(data.isNotNull(), slot))
    values = F.array(*slots).alias("values") if slots else F.array().alias("values")
    axis_row = timestamps(axis)
    return by_ordinal.select(axis_row.scalar().alias("timestamps"), values)


def assemble_dense(dense: DataFrame, aggregations: Sequence[Aggregation]) -> DataFrame:
    """The same row out of a dense histogram with a column per series.

    Axis and points come from the one frame, so its documents are read once.
    """
    series_names = [f"series_{n}" for n in range(len(aggregations))]
    rows = dense.agg(F.array_sort(F.collect_list(F.struct("timestamp", *series_names))).alias("rows"))
    slots = []
    for name, a in zip(series_names, aggregations):
        points = column_points("rows", name)
        data = F.create_map(F.lit(a.name), points)
        slot = F.struct(F.lit(a.name).alias("name"), F.lit(a.field).alias("field"), data.alias("data"))
        slots.append(F.when(F.size(points) > 0, slot))
    return rows.select(
        F.transform("rows", lambda row: row["timestamp"]).alias("timestamps"), F.array(*slots).alias("values")
    )


def column_points(rows: str, name: str) -> Column:
    """Points of one column among rows in time order; rows without it have none."""
    present = F.filter(rows, lambda row: row[name].isNotNull())
    return F.transform(present, lambda row: F.struct(row["timestamp"].alias("timestamp"), row[name].alias("value")))
