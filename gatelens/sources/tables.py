"""Day-partitioned Parquet tables of the four document types."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from datetime import date, timedelta
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gatelens.functions.time import day_text
from gatelens.schemas import CLUSTERING, DOC_TYPES, table_schema

ROW_KEY = ["day", "id"]
PART = ["day", "bucket"]

FILE_BYTES = 128 * 1024 * 1024  # Parquet per part of a day, about; a part that has grown to twice as much is split
TEXT_RATIO = 4  # JSON text shrinks at least this much
GLOB_DAYS = 366  # directories named in one scan; longer spans prune on the partition column
MAX_DEPTH = 24  # halvings of a day
# Classes of ids that a batch's share of a day is described by.
CLASSES = 4_096
# One id in so many is looked at first to find parts that change; batches of less JSON are not worth it.
FIRST_LOOK = 64
LOOKED_AT_FIRST = 16 * 1024 * 1024

STAGED, COMMITTED = "_swap-", "_split"


def table_path(root: str, doc_type: str) -> str:
    if doc_type not in DOC_TYPES:
        raise ValueError(f"unknown document type {doc_type!r}")
    return f"{root.rstrip('/')}/{doc_type}"


# --- parts of a day ----------------------------------------------------------
#
# A day is one part until it outgrows a file. A part is then halved by one more bit of the hash of its ids, as often as its
# size asks for; the others stay as they are. After d halvings parts are numbered from -2^d on, by the d lowest bits of the
# hash: -1 is the whole day, -2 and -3 are its halves, -4 to -7 its quarters. So the number of parts is stored with each
# day, in the names of its directories. Days of earlier versions have the quarters 0 to 3; they are read, added to and split
# like -4 to -7.


def id_hash(name: str = "id") -> Column:
    return F.xxhash64(name)


def part_at(depth: int | Column, name: str = "id") -> Column:
    """The part of its day that a document lies in after so many halvings."""
    size = F.lit(1 << depth).cast("bigint") if isinstance(depth, int) else F.pow(F.lit(2), depth).cast("bigint")
    return (-(size + id_hash(name).bitwiseAND(size - 1))).cast("int")


def quarter(name: str = "id") -> Column:
    """The part as earlier versions numbered it."""
    return id_hash(name).bitwiseAND(F.lit(3).cast("bigint")).cast("int")


def depth_of(part: int) -> int:
    return 2 if part >= 0 else (-part).bit_length() - 1


def low_bits(part: int) -> int:
    """The bits of the hash that all ids of a part share."""
    return part if part >= 0 else -part - (1 << depth_of(part))


def halvings(size: int) -> int:
    """How often a part of this size is halved for its pieces to be a file each."""
    return min(MAX_DEPTH, (max(size, 1) - 1) // FILE_BYTES).bit_length()


# Lookups tell this many halvings apart; a finer part counts as the coarser one that it lies in.
KNOWN_DEPTH = 12


def possible_parts(name: str = "id") -> Column:
    """All parts in which an id may lie, whatever the layout of its day is."""
    return F.array(quarter(name), *[part_at(depth, name) for depth in range(KNOWN_DEPTH + 1)])


def known_part(part: Column) -> Column:
    """The part as ``possible_parts`` names it."""
    return F.when(part > -(2 << KNOWN_DEPTH), part).otherwise(-(F.lit(1 << KNOWN_DEPTH) + (-part).bitwiseAND((1 << KNOWN_DEPTH) - 1)))


def part_of(stored: Mapping[str, Iterable[int]], new_days: Mapping[str, int]) -> Column:
    """The part of each document: in a stored day the one that holds its id, in a new one as many halvings as given.

    An id whose part has no rows yet gets one of the deepest level, which no stored part overlaps.
    """
    depths = {day: max(map(depth_of, parts)) for day, parts in stored.items()} | dict(new_days)
    if len(set(depths.values())) <= 1:
        deepest = part_at(next(iter(depths.values()), 0))
    else:
        deepest = part_at(F.coalesce(F.try_element_at(day_map(depths), F.col("day")), F.lit(0)))
    shallow: dict[int | None, list[str]] = {}
    for day, parts in stored.items():
        for part in parts:
            if part >= 0 or depth_of(part) < depths[day]:
                shallow.setdefault(None if part >= 0 else depth_of(part), []).append(f"{day}/{part}")
    choices = []
    for level, names in shallow.items():
        choice = quarter() if level is None else part_at(level)
        choices.append(F.when(F.concat_ws("/", "day", choice).isin(names), choice))
    return F.coalesce(*choices, deepest)


def day_map(values: Mapping[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for item in sorted(values.items()) for x in item])


def file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def stored_parts(spark: SparkSession, root: str, doc_type: str, days: Iterable[str]) -> dict[str, dict[int, int]]:
    """The parts of the given days and their bytes, from a listing of their directories; no data is read."""
    found: dict[str, dict[int, int]] = {}
    for day in sorted(set(days)):
        files, folder = file_system(spark, f"{table_path(root, doc_type)}/day={day}")
        if not files.exists(folder):
            continue
        listing = files.listFiles(folder, True)
        while listing.hasNext():
            status = listing.next()
            parent = status.getPath().getParent().getName()
            if parent.startswith("bucket=") and status.getPath().getName().endswith(".parquet"):
                parts, part = found.setdefault(day, {}), int(parent.removeprefix("bucket="))
                parts[part] = parts.get(part, 0) + status.getLen()
    return found


# --- scans -------------------------------------------------------------------


def scan(spark: SparkSession, root: str, doc_type: str, days: Iterable[str] | None = None) -> DataFrame:
    """Documents of a type, of all days or of the named ones."""
    return scan_parts(spark, root, doc_type, days).drop("bucket")


def scan_parts(spark: SparkSession, root: str, doc_type: str, days: Iterable[str] | None = None) -> DataFrame:
    """The same with the bucket of each document.

    Named days become an alternation of partition directories, so only those
    are listed, and a day that does not exist simply contributes nothing.
    """
    path, schema = table_path(root, doc_type), table_schema(doc_type).add("bucket", T.IntegerType())
    wanted = None if days is None else sorted(set(days))
    if wanted == []:
        return spark.createDataFrame([], schema)
    target = path
    if wanted is not None and len(wanted) <= GLOB_DAYS:
        target = f"{path}/day={{{','.join(wanted)}}}"
    try:
        docs = spark.read.schema(schema).option("basePath", path).parquet(target)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return docs if wanted is None else docs.where(F.col("day").isin(wanted))


def scan_span(spark: SparkSession, root: str, doc_type: str, first: date, last: date) -> DataFrame:
    """Documents of the days ``first..last``, both included."""
    length = (last - first).days + 1
    if length > GLOB_DAYS:
        return scan(spark, root, doc_type).where(F.col("day").between(day_text(first), day_text(last)))
    return scan(spark, root, doc_type, [day_text(first + timedelta(days=n)) for n in range(length)])


def union_types(tables: dict[str, DataFrame]) -> DataFrame:
    """Documents of several types in one frame; columns a type lacks are null."""
    union = None
    for doc_type, docs in tables.items():
        docs = docs.withColumn("doc_type", F.lit(doc_type))
        union = docs if union is None else union.unionByName(docs, allowMissingColumns=True)
    return union


def scan_all_types(spark: SparkSession, root: str, days: Iterable[str] | None = None) -> DataFrame:
    days = None if days is None else list(days)
    return union_types({doc_type: scan(spark, root, doc_type, days) for doc_type in DOC_TYPES})


def in_parts(parts: Iterable[tuple[str, int]]) -> Column:
    return F.concat_ws("/", *PART).isin([f"{day}/{bucket}" for day, bucket in sorted(parts)])


def only_parts(docs: DataFrame, parts: Iterable[tuple[str, int]]) -> DataFrame:
    """Documents of the given (day, bucket) parts; a test of partition columns alone, which prunes directories."""
    return docs.where(in_parts(parts))


def without_parts(docs: DataFrame, parts: Iterable[tuple[str, int]]) -> DataFrame:
    return docs.where(~in_parts(parts))


# --- writing -----------------------------------------------------------------


def use_microsecond_timestamps(spark: SparkSession) -> None:
    """Parquet timestamps that carry statistics; the default INT96 cannot be skipped on.

    The writer knows this as a setting of the session only. It is set once and stays, like the other ``SETTINGS``.
    """
    key = "spark.sql.parquet.outputTimestampType"
    if spark.conf.get(key) != "TIMESTAMP_MICROS":
        spark.conf.set(key, "TIMESTAMP_MICROS")


def write(docs: DataFrame, path: str, doc_type: str, order: Sequence[str] = ()) -> None:
    """Appends rows that know their part: one file per part, since parts are sized to files.

    A day that holds most of a batch has many parts and goes to many tasks, a small one makes one file. Files are sorted by
    the columns that queries filter on. Ids are random, so lookups by id rely on bloom filters instead. Where an ``order`` is
    given, the last row of each id in it is written; rows of an id meet in the task of their part, without a shuffle of their own.
    """
    use_microsecond_timestamps(docs.sparkSession)
    columns = [*table_schema(doc_type).fieldNames(), "bucket"]
    rows = docs.select(*columns, *order).repartition(*PART)
    if order:
        rows = last_rows(rows, order).select(*columns)
    (
        rows.sortWithinPartitions(*PART, *CLUSTERING[doc_type])
        .write.mode("append")
        .option("parquet.bloom.filter.enabled#id", "true")
        .option("parquet.bloom.filter.adaptive.enabled", "true")  # sized by the ids a row group holds
        .partitionBy(*PART)
        .parquet(path)
    )


def last_rows(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The last row of each id of a part. Sorted by a hash first, as numbers are compared sooner than texts."""
    turns = Window.partitionBy("id_hash", *PART, "id").orderBy(*[F.desc(name) for name in order])
    numbered = rows.withColumn("id_hash", id_hash()).withColumn("later", F.lag(F.lit(True)).over(turns))
    return numbered.where(F.col("later").isNull()).drop("id_hash", "later")


def batch_shape() -> list[Column]:
    """What an upsert wants to know of a batch per day: the classes of its ids, 4,096 at most."""
    return [F.collect_set(id_hash().bitwiseAND(F.lit(CLASSES - 1).cast("bigint")).cast("int")).alias("classes")]


def touched(parts: Iterable[int], classes: Iterable[int]) -> set[int]:
    """The parts in which ids of these classes may lie."""
    by_depth: dict[int, set[int]] = {}
    found = set()
    for part in parts:
        depth = min(depth_of(part), CLASSES.bit_length() - 1)
        known = by_depth.setdefault(depth, {c & ((1 << depth) - 1) for c in classes})
        if low_bits(part) & ((1 << depth) - 1) in known:
            found.add(part)
    return found


def covered(parts: Iterable[int], classes: Iterable[int]) -> bool:
    """Whether all ids of these classes surely lie in stored parts."""
    known = {(depth_of(part), low_bits(part)) for part in parts if 1 << depth_of(part) <= CLASSES}
    depths = {depth for depth, _ in known}
    return all(any((depth, c & ((1 << depth) - 1)) in known for depth in depths) for c in classes)


def upsert(
    docs: DataFrame,
    root: str,
    doc_type: str,
    shape: Mapping[str, tuple[int, Iterable[int]]] | None = None,
    order: Sequence[str] = (),
) -> None:
    """Merges rows with unique ``(day, id)`` into the table; they win over stored ones.

    ``shape`` tells of each day of the batch the bytes of its JSON and the classes of its ids (``batch_shape``); where it
    is not given they are looked up. With an ``order`` ids may come a few times; the last row of each counts.

    Rows equal to a stored one are dropped, so a feed that is sent twice writes nothing. Only parts that the batch falls on
    are looked at. Those in which no stored id changes are appended to. Only the others, and those that have outgrown their
    size, are rewritten, each a file or two, however large the day is: whole rows, stored and new, are shuffled once, to their
    parts, and what was found out before is by ids and hashes alone. One changed row is enough for a part to be rewritten, so
    a small share of the ids is compared first; all ids are compared only in parts where that has shown none. The new files
    are staged beside the table and swapped in. A driver lost in the middle of that leaves a finished stage, which the next
    upsert swaps in first. One writer per table at a time.
    """
    spark = docs.sparkSession
    finish_swaps(spark, root, doc_type)
    if shape is None:
        shape = {r.day: (0, r.classes) for r in docs.groupBy("day").agg(*batch_shape()).collect()}
    incoming = {day: size // TEXT_RATIO for day, (size, _) in shape.items()}
    stored = stored_parts(spark, root, doc_type, shape)
    docs = docs.withColumn("bucket", part_of(stored, {day: halvings(size) for day, size in incoming.items() if day not in stored}))
    path = table_path(root, doc_type)
    if not stored:
        return write(docs, path, doc_type, order)
    if order:
        docs = last_rows(docs, order).drop(*order)

    def held(parts: Iterable[tuple[str, int]]) -> DataFrame:
        """Stored rows of the parts."""
        return only_parts(scan_parts(spark, root, doc_type, {day for day, _ in parts}), parts)

    # What each part that the batch falls on will hold, about.
    sizes = {
        (day, part): parts[part] + (incoming[day] >> depth_of(part)) for day, parts in stored.items() for part in touched(parts, shape[day][1])
    }
    grown = {part: halvings(size) for part, size in sizes.items() if size > 2 * FILE_BYTES}
    rewritten = set(grown)
    if sum(size for size, _ in shape.values()) >= LOOKED_AT_FIRST:
        rewritten |= surely_changed(held, docs, set(sizes) - rewritten)
    unknown = set(sizes) - rewritten
    repeated = set(part_names(with_ids_of(held(unknown), docs))) if unknown else set()
    if repeated:
        rewritten |= set(part_names(with_other_hashes(held(repeated), only_parts(docs, repeated))))
    if repeated - rewritten:
        open_ = repeated - rewritten
        rewritten |= set(part_names(with_other_texts(held(open_), only_parts(docs, open_))))
    append = without_parts(docs, repeated | rewritten) if repeated or rewritten else docs
    if repeated - rewritten:  # nothing changes there, so what isn't stored is new
        known = held(repeated - rewritten).select(*ROW_KEY)
        append = append.unionByName(only_parts(docs, repeated - rewritten).join(known, ROW_KEY, "left_anti").select(append.columns))
    if set(sizes) - rewritten or not all(covered(stored.get(day, ()), classes) for day, (_, classes) in shape.items()):
        write(append, path, doc_type)
    if rewritten:
        replace(held(rewritten), only_parts(docs, rewritten), root, doc_type, rewritten, grown)


def replace(
    old: DataFrame, new: DataFrame, root: str, doc_type: str, parts: Iterable[tuple[str, int]], grown: Mapping[tuple[str, int], int]
) -> None:
    """Puts ``old`` rows and ``new`` ones, which win, in the place of their parts, those ``grown`` halved so many times."""
    spark, path = old.sparkSession, table_path(root, doc_type)
    rows = old.withColumn("turn", F.lit(0)).unionByName(new.withColumn("turn", F.lit(1)))
    split = {part: extra for part, extra in grown.items() if part in parts and depth_of(part[1]) + extra <= MAX_DEPTH and extra}
    if split:
        deeper = day_map({f"{day}/{part}": depth_of(part) + extra for (day, part), extra in split.items()})
        depth = F.try_element_at(deeper, F.concat_ws("/", *PART))
        rows = rows.withColumn("bucket", F.when(depth.isNotNull(), part_at(depth)).otherwise(F.col("bucket")))
    stage = f"{path}/{STAGED}{uuid4().hex}"
    write(rows, stage, doc_type, ["turn"])
    files, target = file_system(spark, f"{stage}/{COMMITTED}.part")
    out = files.create(target, True)
    out.write(bytearray("".join(f"day={day}/bucket={part}\n" for day, part in sorted(split)), "utf-8"))
    out.close()
    files.rename(target, spark._jvm.org.apache.hadoop.fs.Path(f"{stage}/{COMMITTED}"))
    swap(spark, path, stage)


def swap(spark: SparkSession, path: str, stage: str) -> None:
    """Moves the parts of a finished stage into the table. Begun anew after a failure, it does what is left."""
    files, folder = file_system(spark, stage)
    at = spark._jvm.org.apache.hadoop.fs.Path
    committed = at(f"{stage}/{COMMITTED}")
    stream = files.open(committed)
    split = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
    stream.close()
    for name in split:  # their rows are in the staged halves
        files.delete(at(f"{path}/{name}"), True)
    for day in files.listStatus(folder):
        if not day.isDirectory() or not day.getPath().getName().startswith("day="):
            continue
        files.mkdirs(at(f"{path}/{day.getPath().getName()}"))
        for part in files.listStatus(day.getPath()):
            target = at(f"{path}/{day.getPath().getName()}/{part.getPath().getName()}")
            files.delete(target, True)
            if not files.rename(part.getPath(), target):
                raise OSError(f"could not move {part.getPath()} to {target}")
    files.delete(folder, True)


def finish_swaps(spark: SparkSession, root: str, doc_type: str) -> None:
    """Ends what a lost driver left: finished stages are swapped in, others removed."""
    path = table_path(root, doc_type)
    files, folder = file_system(spark, path)
    if not files.exists(folder):
        return
    at = spark._jvm.org.apache.hadoop.fs.Path
    for status in files.listStatus(folder):
        if status.getPath().getName().startswith(STAGED):
            stage = f"{path}/{status.getPath().getName()}"
            if files.exists(at(f"{stage}/{COMMITTED}")):
                swap(spark, path, stage)
            else:
                files.delete(status.getPath(), True)


def looked_at_first(docs: DataFrame) -> DataFrame:
    """The rows of a share of the ids, by bits of the hash that have no say in parts."""
    return docs.where(F.shiftrightunsigned(id_hash(), 40) % FIRST_LOOK == 0)


def surely_changed(held: Callable[[Iterable[tuple[str, int]]], DataFrame], docs: DataFrame, parts: set[tuple[str, int]]) -> set[tuple[str, int]]:
    """Parts in which a stored row changes, as far as a share of the ids tells; it says nothing about the others."""
    repeated = part_names(with_ids_of(looked_at_first(held(parts)), looked_at_first(docs))) if parts else []
    if not repeated:
        return set()
    return set(part_names(with_other_hashes(looked_at_first(held(repeated)), looked_at_first(only_parts(docs, repeated)))))


def with_ids_of(stored: DataFrame, docs: DataFrame) -> DataFrame:
    """Keys of stored rows that ``docs`` holds too."""
    return stored.select(*PART, "id").join(docs.select(*ROW_KEY), ROW_KEY, "left_semi")


def row_hash(docs: DataFrame) -> Column:
    """A hash of the whole row; nested columns go as JSON, because maps have none."""
    nested = {field.name for field in docs.schema if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))}
    return F.xxhash64(*[F.to_json(name) if name in nested else F.col(name) for name in sorted(docs.columns)])


def with_other_hashes(stored: DataFrame, docs: DataFrame) -> DataFrame:
    """Keys of stored rows that ``docs`` holds with another hash, and so in another form; equal hashes prove nothing."""
    ours = stored.select(*PART, "id", row_hash(stored).alias("stored_hash"))
    return ours.join(docs.select(*ROW_KEY, row_hash(docs).alias("hash")), ROW_KEY).where("hash != stored_hash").select(*PART, "id")


def with_other_texts(stored: DataFrame, docs: DataFrame) -> DataFrame:
    """Keys of stored rows that ``docs`` holds in another form.

    Stored rows are cut to the keys of ``docs`` before whole rows are compared,
    as JSON because maps have no equality (timestamps are whole milliseconds).
    """
    text = F.to_json(F.struct(*sorted(docs.columns)))
    candidates = stored.join(docs.select(*ROW_KEY), ROW_KEY, "left_semi").select(*PART, "id", text.alias("stored_text"))
    return candidates.join(docs.select(*ROW_KEY, text.alias("text")), ROW_KEY).where("text != stored_text").select(*PART, "id")


def part_names(docs: DataFrame) -> list[tuple[str, int]]:
    """The (day, bucket) parts of a batch; a handful of names, like directories."""
    return sorted((r.day, r.bucket) for r in docs.select(*PART).distinct().collect())
