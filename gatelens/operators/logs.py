"""Request logs: pages, lookups by id, and the join with logged payloads."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gatelens.functions.documents import EXCHANGES, drop_payloads, request_columns
from gatelens.functions.predicates import all_of, has_id, select_documents
from gatelens.functions.time import TimeRange
from gatelens.sources.tables import known_part, possible_parts

# Lookups of at most this many literal ids become an IN list, which reaches the
# scan (statistics and bloom filters); longer lists belong in a frame.
LITERAL_IDS = 1_000
# Pages that end within this many rows are taken as a top-k.
TOP_K_ROWS = 10_000
# A longer list is broadcast up to this length, some tens of MB.
BROADCAST_IDS = 500_000


def hits_total(docs: DataFrame) -> DataFrame:
    """Number of matching documents, as one row."""
    return docs.agg(F.count("*").alias("total"))


def newest_first(docs: DataFrame) -> DataFrame:
    """By time descending at millisecond resolution; the id settles ties."""
    return docs.orderBy(F.unix_millis("ts").desc(), F.col("id").desc())


def page_of(docs: DataFrame, page: int, size: int) -> DataFrame:
    """The 1-based page of documents, newest first; those without a timestamp come last."""
    return page_and_total(docs, page, size)[0]


def page_and_total(docs: DataFrame, page: int, size: int) -> tuple[DataFrame, Column]:
    """A page and how many documents there are in all.

    Near the front the page is a top-k: a task keeps no more than ``page * size`` rows.
    A deep page would make every task send that many to one, so it is located by
    counting instead; both ways give the same rows. The counts give the total as well.

    In a day-partitioned table the page is found over narrow keys first, and
    whole documents are read only of the days it falls on.
    """
    if page < 1 or size < 0:
        raise ValueError("page starts at 1 and size at 0")
    offset = (page - 1) * size
    keys = [name for name in ("day", "id", "ts") if name in docs.columns]
    total = hits_total(docs).scalar()
    if offset + size > TOP_K_ROWS:
        rows, minutes, times = deep_page_keys(docs.select(*keys), offset, size)
        total = minutes.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
        docs = docs.where(times)
    elif "day" in docs.columns:
        rows = newest_first(docs.select(*keys)).offset(offset).limit(size)
    else:
        return newest_first(docs).offset(offset).limit(size), total
    rows = F.broadcast(rows) if size <= BROADCAST_IDS else rows
    return newest_first(same_keys(docs, rows, keys, "left_semi")).limit(size), total


def same_keys(docs: DataFrame, rows: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on keys that may be null, nulls being equal; days never are, and a plain test prunes by them."""
    rows = rows.withColumnsRenamed({name: f"{name}_of_page" for name in keys})
    tests = [
        F.col(name) == F.col(f"{name}_of_page") if name == "day" else F.col(name).eqNullSafe(F.col(f"{name}_of_page"))
        for name in keys
    ]
    joined = docs.join(rows, all_of(tests), how)
    return joined if how == "left_semi" else joined.drop(*[f"{name}_of_page" for name in keys])


# Length of the id prefixes that narrow down a page within one millisecond.
PREFIX = 28
MINUTE = 60_000


def deep_page_keys(keys: DataFrame, offset: int, size: int) -> tuple[DataFrame, DataFrame, Column]:
    """Keys of the documents at positions ``offset .. offset + size``, newest first; the documents per minute; and a
    condition on ``ts`` that holds for the page.

    1. Documents are counted per minute; running totals, first over days and then within each, tell which minutes the page
       overlaps. Their ends, known at run time, are filters of all later scans, which read few row groups.
    2. The documents of those minutes are counted once more, per millisecond and id prefix. The page is narrowed down over
       these counts, by milliseconds and then by prefixes; a step keeps no more groups than the page has documents.
    3. The documents of the last few groups are numbered one by one.

    Documents without a timestamp are one last minute, split up by their ids.
    """
    end = offset + size
    millis = F.unix_millis("ts")
    levels = {"minute": F.floor(millis / MINUTE).cast("bigint"), "millis": millis, "prefix": F.left("id", F.lit(PREFIX))}
    leveled = keys.select("*", *[column.alias(name) for name, column in levels.items()])
    zero = F.lit(0).cast("bigint")

    def overlapping(counts: DataFrame, parents: list, names: list[str]) -> DataFrame:
        newer = Window.partitionBy(*parents).orderBy(F.col(names[-1]).desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
        placed = counts.select(*names, "n", (F.col("before") + F.coalesce(F.sum("n").over(newer), zero)).alias("before"))
        return placed.where((F.col("before") < end) & (F.col("before") + F.col("n") > offset)).drop("n")

    def narrowed(rows: DataFrame, groups: DataFrame, names: list[str]) -> DataFrame:
        return same_keys(rows, F.broadcast(groups) if size <= BROADCAST_IDS else groups, names, "inner")

    minutes = keys.groupBy(levels["minute"].alias("minute")).agg(F.count("*").alias("n"))
    found = overlapping(after_newer_days(minutes.withColumn("before", zero)), [F.floor(F.col("minute") / 1_440)], ["minute"])
    times = within_minutes(found)
    names = ["minute"]
    counted = narrowed(leveled.where(times), found, names).groupBy(*levels, "before").agg(F.count("*").alias("n"))
    groups = counted
    for name in list(levels)[1:]:
        parents, names = names, [*names, name]
        found = overlapping(groups.groupBy(*names, "before").agg(F.sum("n").alias("n")), parents, names)
        groups = narrowed(counted.drop("before"), found, names)  # the counts as they were, not those of the step before
    near = narrowed(leveled.where(times), found, names)
    position = F.col("before") + F.row_number().over(Window.partitionBy(*names).orderBy(F.col("id").desc_nulls_last()))
    numbered = near.withColumn("position", position)
    chosen = numbered.where((F.col("position") > offset) & (F.col("position") <= end))
    return chosen.select(*keys.columns), minutes, times


def within_minutes(minutes: DataFrame) -> Column:
    """Whether ``ts`` lies between the ends of the given minutes, or is null: two numbers that are known at run time, in
    time for the scan. They are looked up apart, since only a plain value reaches the file reader."""
    dated = minutes.where(F.col("minute").isNotNull()).select("minute")
    oldest = dated.orderBy("minute").limit(1).select(F.timestamp_millis(F.col("minute") * MINUTE)).scalar()
    newest = dated.orderBy(F.desc("minute")).limit(1).select(F.timestamp_millis((F.col("minute") + 1) * MINUTE)).scalar()
    return F.col("ts").isNull() | ((F.col("ts") >= oldest) & (F.col("ts") < newest))


def after_newer_days(minutes: DataFrame) -> DataFrame:
    """Adds to ``before`` what all newer days hold; one row per day is all that has to be put in order at once."""
    day = F.floor(F.col("minute") / 1_440)
    totals = minutes.groupBy(day.alias("day_number")).agg(F.sum("n").alias("total"))
    newer = Window.orderBy(F.col("day_number").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("day_number", F.coalesce(F.sum("total").over(newer), F.lit(0).cast("bigint")).alias("start"))
    joined = minutes.join(starts, day.eqNullSafe(F.col("day_number")))
    return joined.withColumn("before", F.col("before") + F.col("start")).drop("day_number", "start")


def with_total(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Adds the total of ``docs``, counted over the filter columns only."""
    return rows.withColumn("total", hits_total(docs).scalar())


class Pages:
    """All pages of one ordering, out of two scans: one for the ranges of the order, one for the rows.

    Rows (with ``id`` and ``timestamp``) are dealt by ranges of time and id, sorted in their tasks, and written with their
    place to ``folder``, when the object is made. A page is a slice of that table. Documents that share a millisecond are
    dealt by their ids, so no moment is a hot spot.
    """

    def __init__(self, rows: DataFrame, size: int, folder: str):
        if size < 1:
            raise ValueError("a page has at least one row")
        order = [F.col("timestamp").desc_nulls_last(), F.col("id").desc_nulls_last()]
        place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
        ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
        ordered.select("*", F.spark_partition_id().alias("_range"), place.alias("_place")).write.parquet(folder)
        self.size, self.columns = size, rows.columns
        self.rows = rows.sparkSession.read.parquet(folder)
        newer = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # a row per task that wrote
        self.starts = self.rows.groupBy("_range").agg(F.count("*").alias("n")).select("_range", F.coalesce(F.sum("n").over(newer), F.lit(0)).alias("_start"))

    def all(self) -> DataFrame:
        """Every row with its page and the total."""
        placed = self.rows.join(F.broadcast(self.starts), "_range")
        number = (F.floor((F.col("_start") + F.col("_place")) / self.size) + 1).cast("int")
        return placed.select(number.alias("page"), *self.columns, hits_total(self.rows).scalar().alias("total"))

    def page(self, page: int) -> DataFrame:
        """One page, in order."""
        rows = self.all().where(F.col("page") == page).drop("page")
        return rows.orderBy(F.col("timestamp").desc_nulls_last(), F.col("id").desc_nulls_last())


def tabular(
    docs: DataFrame,
    time_range: TimeRange,
    page: int = 1,
    size: int = 20,
    root: tuple[str, str] | None = None,
    query: str | Column | None = None,
    codes: Mapping[int, str] | None = None,
    zone: str = "UTC",
) -> DataFrame:
    """One page of request logs beside the total of matching requests."""
    selected = select_documents(drop_payloads(docs), time_range, root, query, zone)
    rows, total = page_and_total(selected, page, size)
    return rows.select(*request_columns(codes), total.alias("total"))


def tabular_pages(
    docs: DataFrame,
    time_range: TimeRange,
    size: int,
    folder: str,
    root: tuple[str, str] | None = None,
    query: str | Column | None = None,
    codes: Mapping[int, str] | None = None,
    zone: str = "UTC",
) -> Pages:
    """All pages of request logs, ordered once, into ``folder``."""
    return Pages(select_documents(drop_payloads(docs), time_range, root, query, zone).select(*request_columns(codes)), size, folder)


# --- lookups -----------------------------------------------------------------


# Ids in more parts than this are looked for in all of them.
NAMED_PARTS = 4_096


def in_parts_of(docs: DataFrame, ids: DataFrame | Iterable[str]) -> DataFrame:
    """Documents of a stored table whose part of the day may hold one of the ids; others are left as they are.

    A test of the partition column ``bucket`` alone, by a run-time list of at most some thousand parts: a lookup opens the
    parts of its ids, whatever the layout of each day is, not whole days.
    """
    if "bucket" not in docs.columns:
        return docs
    parts = id_frame(docs, ids).select(F.explode(possible_parts("id")).alias("part"))
    listed = parts.agg(F.collect_set("part").alias("parts")).scalar()
    return docs.where((F.size(listed) > NAMED_PARTS) | F.array_contains(listed, known_part(F.col("bucket"))))


def pick_ids(docs: DataFrame, ids: DataFrame | Iterable[str]) -> DataFrame:
    """Documents whose id is listed, over all days; of a stored table with its ``bucket``, from the ids' parts only.

    The size of a list is known and decides how it travels; that of a frame is
    for Spark to judge, which also filters the documents by its runtime bloom
    filter where it has to shuffle them.
    """
    if not isinstance(ids, DataFrame):
        ids = list(ids)
    docs = in_parts_of(docs, ids)
    if isinstance(ids, DataFrame):
        return docs.join(ids.select("id"), "id", "left_semi")
    if len(ids) <= LITERAL_IDS:
        return docs.where(has_id(ids))
    listed = id_frame(docs, ids)
    return docs.join(F.broadcast(listed) if len(ids) <= BROADCAST_IDS else listed, "id", "left_semi")


def id_frame(docs: DataFrame, ids: DataFrame | Iterable[str]) -> DataFrame:
    if isinstance(ids, DataFrame):
        return ids.select("id").distinct()
    return docs.sparkSession.createDataFrame([(str(i),) for i in dict.fromkeys(ids)], "id string")


def missing_ids(docs: DataFrame, ids: DataFrame | Iterable[str]) -> DataFrame:
    """Requested ids no document has.

    The documents are reduced to the requested ids first, so what meets in the
    anti join is no larger than the request.
    """
    if not isinstance(ids, DataFrame):
        ids = list(ids)
    found = pick_ids(docs, ids).select("id")
    return id_frame(docs, ids).join(found, "id", "left_anti")


def must_exist(found: DataFrame, ids: DataFrame | Iterable[str], what: str) -> DataFrame:
    """``found``, or a failing query as soon as it runs when an id has no row."""
    wanted = id_frame(found, ids)
    message = F.concat(F.lit(f"no {what} has the id "), F.col("id"))
    joined = wanted.join(found.withColumn("present", F.lit(True)), "id", "left")
    # The check decides about rows, so it runs whatever columns are selected or counted.
    present = F.when(F.col("present").isNull(), F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return joined.where(present).select(*found.columns)


def request_with_log(requests: DataFrame, logs: DataFrame, codes: Mapping[int, str] | None = None) -> DataFrame:
    """Requests beside the payloads logged under the same id on the same day.

    A left join: a request that was not logged has null payloads.
    """
    left = drop_payloads(requests).select("day", *request_columns(codes))
    return left.join(logs.select("id", "day", *EXCHANGES), ["id", "day"], "left")


def on_days_of(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Documents of the days that ``found`` falls on: a run-time filter, which prunes the partitions of a stored table.

    One value per day is all that it gathers.
    """
    days = found.agg(F.collect_set("day").alias("days")).scalar()
    return docs.where(F.array_contains(days, F.col("day")))


def find_requests(
    requests: DataFrame,
    logs: DataFrame,
    ids: DataFrame | Iterable[str],
    codes: Mapping[int, str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Extended logs of the listed requests; ``strict`` fails on an unknown id."""
    if not isinstance(ids, DataFrame):
        ids = list(ids)
    # Requests are found first, over narrow rows; payloads, the widest rows of the store, are read of the days found
    # only, and cut to the ids before they meet.
    picked = pick_ids(requests, ids)
    found = request_with_log(picked, pick_ids(on_days_of(logs, picked), ids), codes)
    return must_exist(found, ids, "request") if strict else found
