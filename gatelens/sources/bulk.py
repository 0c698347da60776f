"""Bulk feed: pairs of an action line and a document line.

    {"index":{"_index":"prefix-2017.05.22","_type":"request","_id":"a1"}}
    {"@timestamp":"2017-05-22T18:10:11.079+01:00", ...}
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gatelens.functions.documents import UNREADABLE, read_timestamp, table_columns, try_document
from gatelens.functions.time import DAY_FORMAT
from gatelens.schemas import DOC_TYPES, DOCUMENT_FIELDS
from gatelens.sources.tables import batch_shape, file_system, stored_parts, upsert, use_microsecond_timestamps

# How an action usually opens; files split in front of it, between records.
ACTION = '{"index":'
OPENING = r'^\s*\{\s*"index"\s*:'

ACTION_SCHEMA = "index struct<_index:string,_type:string,_id:string>"
DAY_PATTERN = r"(\d{4}\.\d{2}\.\d{2})$"
PLACE = "struct<turn:int,time:timestamp,file:string,offset:bigint,row:bigint>"
REJECTS = "rejected"
OLD_REJECTS = "rejects"  # of earlier versions: one folder for all days
BATCH = "_batch-"  # a parsed batch while it is merged
FEED_ORDER = ("place", "pair")
# A staged batch is read a few times as a whole and removed, so its files need no dictionaries or statistics.
PASSING_FILES = {
    "parquet.enable.dictionary": "false",
    "parquet.column.statistics.enabled": "false",
    "parquet.size.statistics.enabled": "false",
}
# Where no id comes more often in a batch, its records may all go to the task of their part.
FEW_TIMES = 4
# Files named in the filter on stored rejects; of more, their days alone prune.
NAMED_FILES = 1_000


def separator(opening: str = ACTION) -> str:
    return "\n" + opening


def opening_of(spark: SparkSession, path: str) -> str:
    """How the first action of a file or folder opens, spaces included.

    It only decides where files are cut for reading. Actions that open otherwise
    are found within the pieces.
    """
    first = spark.read.text(path).where(F.trim("value") != "").limit(1).collect()
    found = re.match(OPENING, first[0][0]) if first else None
    return found[0].lstrip() if found else ACTION


def read_bulk(spark: SparkSession, *paths: str) -> DataFrame:
    """Records of bulk files with their place in the feed: paths in the given order."""
    feeds = []
    for turn, path in enumerate(paths):
        opening = opening_of(spark, path)
        lines = spark.read.option("lineSep", separator(opening)).text(path)
        feeds.append(placed(located(lines), opening, turn))
    union = feeds[0]
    for feed in feeds[1:]:
        union = union.unionByName(feed)
    return union


def text_records(spark: SparkSession, text: str) -> DataFrame:
    """Records of a bulk request held as a string."""
    parts = text.replace("\r\n", "\n").split(separator())
    rows = [(part, ACTION, (0, None, "", 0, row)) for row, part in enumerate(parts)]
    return spark.createDataFrame(rows, f"value string, opening string, place {PLACE}")


def located(records: DataFrame) -> DataFrame:
    """Records with the file, its age and the split they were read from."""
    return records.select(
        "value",
        F.col("_metadata.file_modification_time").alias("time"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("offset"),
    )


def placed(records: DataFrame, opening: str = ACTION, turn: int = 0) -> DataFrame:
    """Adds ``place``: files by age, then by name, then position in the file.

    Within a split rows are numbered as read, and splits carry their offset, so
    this orders a file exactly although many tasks read it. The age decides in a
    stream, too, so it doesn't matter how many files a batch takes.
    """
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    place = F.struct(F.lit(turn).alias("turn"), "time", "file", "offset", row.alias("row"))
    return records.select("value", F.lit(opening).alias("opening"), place.alias("place"))


def parse_bulk(records: DataFrame, on_error: str = "reject") -> DataFrame:
    """``doc_type, day, id, <a struct per type>, ts, bytes, place, pair, reason, source`` of every record.

    Each document is parsed once. ``reason`` tells why a record can't be stored, and is null for all others; with
    ``on_error="fail"`` such a record fails the query instead.
    """
    if on_error not in ("reject", "fail"):
        raise ValueError(f"unknown way to treat bad records: {on_error!r}")
    if "opening" not in records.columns:
        records = records.withColumn("opening", F.lit(ACTION))
    # The separator eats the start of the action; only the first record of a file still has it.
    text = F.when(F.col("value").rlike(OPENING), F.col("value")).otherwise(F.concat("opening", "value"))
    lines = records.select("place", F.split(text, "\n").alias("lines"))
    # One pair of lines, or more where an action opens in another way than the first of its file.
    pairs = lines.select("place", F.posexplode(pairs_of(F.col("lines"))).alias("pair", "lines"))
    cut = pairs.select("*", F.split(F.col("lines")[0], '"').alias("texts"))
    parsed = cut.select(
        action_of(F.col("lines")[0], F.col("texts")).alias("action"),
        F.try_element_at("lines", F.lit(2)).alias("source"),
        F.col("lines")[0].alias("action_text"),
        "place",
        "pair",
    )
    doc_type = F.col("action._type")
    # One of the four is evaluated, the one of the record's type.
    structs = [F.when(doc_type == name, try_document(name, F.col("source"))).alias(name) for name in DOC_TYPES]
    typed = parsed.select(
        doc_type.alias("doc_type"),
        F.regexp_extract(F.col("action._index"), DAY_PATTERN, 1).alias("day"),
        F.col("action._id").alias("id"),
        F.octet_length("source").alias("bytes"),
        *structs,
        "place",
        "pair",
        "source",
        "action_text",
    )
    # Rows are wide, so each step that copies them counts: the timestamp is one, all that follows from it another.
    dated = typed.withColumn("ts", read_timestamp(of_any("@timestamp")))
    # Of good records the document is all that moves on.
    texts = [F.when(reason().isNotNull(), F.col(c)).alias(c) for c in ("source", "action_text")]
    checked = dated.select("doc_type", "day", "id", "bytes", *DOC_TYPES, "ts", "place", "pair", reason().alias("reason"), *texts)
    if on_error == "fail":
        complaint = F.raise_error(F.concat_ws(" ", F.lit("unusable bulk record:"), "reason", "action_text"))
        checked = checked.withColumn("id", F.when(F.col("reason").isNull(), F.col("id")).otherwise(complaint))
    return checked


def pairs_of(lines: Column) -> Column:
    """Action and document lines, two by two; a last line without a partner is a pair of its own, blank lines don't count.

    Nearly all records are two lines, and those need no more than being looked at.
    """
    filled = F.filter(lines, lambda line: F.trim(line) != "")
    starts = F.when(F.size(filled) > 0, F.sequence(F.lit(1), F.greatest(F.size(filled), F.lit(1)), F.lit(2))).otherwise(F.array().cast("array<int>"))
    general = F.transform(starts, lambda start: F.slice(filled, start, F.lit(2)))
    plain = (F.size(lines) == 2) & (F.trim(lines[0]) != "") & (F.trim(F.get(lines, F.lit(1))) != "")
    return F.when(plain, F.array(lines)).otherwise(general)


# An action as nearly all producers write it, cut at its quotes; others go through a JSON parser.
PLAIN_ACTION = ("{", "index", ":{", "_index", ":", None, ",", "_type", ":", None, ",", "_id", ":", None, "}}")


def action_of(line: Column, texts: Column) -> Column:
    """The struct of an action line, given with its texts between quotes; null if it isn't one."""
    plain = (F.size(texts) == len(PLAIN_ACTION)) & ~F.contains(line, F.lit("\\"))
    for n, text in enumerate(PLAIN_ACTION):
        if text is not None:
            plain = plain & (F.get(texts, F.lit(n)) == text)
    names = ("_index", "_type", "_id")
    values = [n for n, text in enumerate(PLAIN_ACTION) if text is None]
    found = F.struct(*[F.get(texts, F.lit(n)).alias(name) for n, name in zip(values, names)])
    return F.when(plain, found).otherwise(F.from_json(line, ACTION_SCHEMA)["index"])


def of_any(field: str) -> Column:
    """A field of the record's document, whichever type it has."""
    have = [name for name, fields in DOCUMENT_FIELDS.items() if field == UNREADABLE or field in fields]
    return F.coalesce(*[F.col(f"{name}.`{field}`") for name in have])


def reason() -> Column:
    """Why a record can't be stored."""
    known = F.col("doc_type").isin(list(DOC_TYPES))
    # The documents of the other types are null, so what is common to the types is looked up in all.
    return (
        F.when(F.col("id").isNull() | F.col("doc_type").isNull(), "no usable action")
        .when(~known, "unknown type")
        .when(F.coalesce("day", F.lit("")) == "", "no day in the index name")
        .when(F.trim(F.coalesce("source", F.lit(""))) == "", "no document")
        .when(of_any(UNREADABLE).isNotNull(), "unreadable document")
        .when(of_any("@timestamp").isNotNull() & F.col("ts").isNull(), "bad timestamp")
    )


def last_actions(parsed: DataFrame) -> DataFrame:
    """The last good document of each id, and all bad records.

    The others were overwritten within the feed. Planned as a group limit before
    the shuffle, so an id that comes a million times sends one row per task.
    """
    bad = F.when(F.col("reason").isNotNull(), F.struct("place", "pair"))
    order = Window.partitionBy("doc_type", "day", "id", bad).orderBy(F.desc("place"), F.desc("pair"))
    return parsed.withColumn("recency", F.row_number().over(order)).where(F.col("recency") == 1).drop("recency")


def typed_rows(typed: DataFrame, doc_type: str, more: Sequence[str] = ()) -> DataFrame:
    """Table rows of one document type, with ``more`` columns of the record if wanted."""
    chosen = typed.where((F.col("doc_type") == doc_type) & F.col("reason").isNull())
    return chosen.select("id", *table_columns(doc_type, doc_type, stamp=F.col("ts")), "day", *more)


def file_day() -> Column:
    """The day under which a bad record is kept: that of its file, which a replay doesn't change; else today."""
    return F.date_format(F.coalesce(F.col("place.time"), F.current_timestamp()), DAY_FORMAT)


def rejected_rows(typed: DataFrame) -> DataFrame:
    """Bad records: reason, place and text, and the day they are kept under."""
    bad = typed.where(F.col("reason").isNotNull())
    return bad.select("reason", "doc_type", "id", "place.file", "place.offset", "place.row", "pair", F.col("action_text").alias("action"), "source", file_day().alias("day"))


def ingest(records: DataFrame, root: str, on_error: str = "reject") -> list[str]:
    """Upserts a batch of records into the tables; returns the types it held.

    Bad records are set aside under ``rejected`` (with ``on_error="fail"`` one of
    them fails the batch). Merging needs the batch several times (its days, its
    ids, its rows), so the parsed batch is written beside the tables for the length of the call: the
    feed is read and its JSON parsed once, nothing is sorted or held in memory for it, and each later pass
    reads its own columns only. Documents are shuffled once, to the parts of their days; a type
    that holds an id twice has its rows put in order there if its days are new and no id comes often, else before that.
    """
    spark = records.sparkSession
    use_microsecond_timestamps(spark)
    folder = f"{root.rstrip('/')}/{BATCH}{uuid4().hex}"
    files, target = file_system(spark, folder)
    files.deleteOnExit(target)
    try:
        parsed = parse_bulk(records, on_error)
        parsed.write.options(**PASSING_FILES).parquet(f"{folder}/parsed")
        staged = spark.read.schema(parsed.schema).parquet(f"{folder}/parsed")
        shapes, repeated = batch_shapes(staged)
        bad_days = {r.day for r in staged.where(F.col("reason").isNotNull()).select(file_day().alias("day")).distinct().collect()}
        if bad_days:
            set_aside(rejected_rows(staged), root, bad_days)
        for doc_type, shape in sorted(shapes.items()):
            rows = staged.where((F.col("doc_type") == doc_type) & F.col("reason").isNull())
            if doc_type not in repeated:
                upsert(typed_rows(rows, doc_type), root, doc_type, shape)
                continue
            if repeated[doc_type] <= FEW_TIMES and not stored_parts(spark, root, doc_type, shape):
                upsert(typed_rows(rows, doc_type, FEED_ORDER), root, doc_type, shape, FEED_ORDER)
                continue
            last = typed_rows(last_actions(rows), doc_type)
            last.write.options(**PASSING_FILES).parquet(f"{folder}/{doc_type}")
            upsert(spark.read.schema(last.schema).parquet(f"{folder}/{doc_type}"), root, doc_type, shape)
        return sorted(shapes)
    finally:
        files.delete(target, True)


def batch_shapes(staged: DataFrame) -> tuple[dict[str, dict[str, tuple[int, list[int]]]], dict[str, int]]:
    """Per type and day the bytes and the classes of the ids of good records, an id that is repeated counting once; and of the
    types that hold an id more than once, how often at most."""
    keys = staged.where(F.col("reason").isNull()).groupBy("doc_type", "day", "id").agg(F.count("*").alias("n"), F.max("bytes").alias("bytes"))
    per_day = keys.groupBy("doc_type", "day").agg(F.sum("bytes").alias("bytes"), F.max("n").alias("most"), *batch_shape())
    shapes: dict[str, dict[str, tuple[int, list[int]]]] = {}
    repeated: dict[str, int] = {}
    for row in per_day.collect():  # one row per type and day
        shapes.setdefault(row.doc_type, {})[row.day] = row.bytes, row.classes
        if row.most > 1:
            repeated[row.doc_type] = max(row.most, repeated.get(row.doc_type, 0))
    return shapes, repeated


REJECT_COLUMNS = ["reason", "doc_type", "id", "file", "offset", "row", "pair", "action", "source"]


def read_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def rejects(spark: SparkSession, root: str) -> DataFrame | None:
    """Bad records of all batches, or None where there were none."""
    found = [read_if_any(spark, f"{root.rstrip('/')}/{name}") for name in (REJECTS, OLD_REJECTS)]
    frames = [frame.select(*REJECT_COLUMNS) for frame in found if frame is not None]
    if not frames:
        return None
    return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])


def known_places(spark: SparkSession, root: str, days: Iterable[str], files: list[str]) -> DataFrame | None:
    """Places of the rejects that the given files left, read from the days of the files only."""
    kept = read_if_any(spark, f"{root.rstrip('/')}/{REJECTS}")
    if kept is None:
        return None
    kept = kept.where(F.col("day").cast("string").isin(sorted(days)) & (F.col("file") != ""))
    if len(files) <= NAMED_FILES:
        kept = kept.where(F.col("file").isin(files))
    return kept.select("file", "offset", "row", "pair")


def set_aside(rows: DataFrame, root: str, days: Iterable[str]) -> None:
    """Appends rejects to their days; those of a batch that is replayed are there already."""
    files = [r.file for r in rows.select("file").distinct().limit(NAMED_FILES + 1).collect()]
    known = known_places(rows.sparkSession, root, days, files)
    if known is not None:
        rows = rows.join(known, ["file", "offset", "row", "pair"], "left_anti")
    rows.write.mode("append").partitionBy("day").parquet(f"{root.rstrip('/')}/{REJECTS}")


def bulk_lines(docs: DataFrame, doc_type: str, prefix: str, document) -> DataFrame:
    """The feed of a frame: one record per row, ready for ``write.text``.

    ``document`` is the JSON text column; ``id`` and ``day`` name the target.
    """
    action = F.to_json(
        F.struct(
            F.struct(
                F.concat(F.lit(prefix + "-"), F.col("day")).alias("_index"),
                F.lit(doc_type).alias("_type"),
                F.col("id").alias("_id"),
            ).alias("index")
        )
    )
    return docs.select(F.concat(action, F.lit("\n"), document).alias("value"))
