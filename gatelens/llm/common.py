"""Helpers of the operators: intermediate tables, hashed words of Arrow texts, components of a graph."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatelens.session import shared_folder

#: White space of the contracts: blank, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of text hashed at once; eight-byte numbers per byte exist for so much text only.
WINDOW = 1 << 20


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case and nothing else. A text without other letters takes the faster of two equal ways."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def work_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables: the cluster's shared one; a temporary folder for local masters only."""
    shared = shared_folder(spark)
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.gettempdir()


def saved(frame: DataFrame, *by: str) -> DataFrame:
    """Writes a frame as Parquet into the shared folder and reads it back: its lineage ends there, and a lost
    executor costs no recomputation. The table goes when the application ends."""
    spark = frame.sparkSession
    path = f"{work_folder(spark)}/gatelens-llm-{uuid.uuid4().hex}"
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    writer = frame.write.partitionBy(*by) if by else frame.write
    writer.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, so that it needs no installation there."""
    if spark.sparkContext.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = f"{tempfile.mkdtemp()}/{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(spark.sparkContext.applicationId)


# Hashed words ---------------------------------------------------------------------------------------------------

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def random_words(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers."""
    start = np.uint64((seed * 0xD1342543DE82EF95 + 1) & _MASK)
    return mix(start + np.arange(1, count + 1, dtype=np.uint64) * np.uint64(_BASE))


_LETTERS = random_words(256, 1)
_FOLDED = _LETTERS.copy()
_FOLDED[65:91] = _LETTERS[97:123]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, count: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < count:
        steps = np.full(max(count, WINDOW + 1), base, dtype=np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        _powers[base] = have
    return have[:count]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of an Arrow string array and the edges of its rows in them; nulls count as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, edges, data = texts.buffers()
    offsets = np.frombuffer(edges, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def give_back() -> None:
    """Returns memory that a Python worker has freed to the machine; workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


_kept: dict[object, object] = {}


def kept(name: object, make: Callable[[], object]):
    """What a Python worker keeps from task to task under a name; nothing that was kept under another one stays beside it."""
    if name not in _kept:
        forget()
        _kept[name] = make()
    return _kept[name]


def forget() -> None:
    """Drops what the tasks of earlier operators kept in this Python worker."""
    if _kept:
        _kept.clear()
        give_back()


def row_slices(batch: pa.RecordBatch, column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows with about ``size`` bytes of text; a longer text is a run of its own."""
    _, edges = text_bytes(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = int(np.searchsorted(edges, edges[start] + size, side="right")) - 1
        end = min(max(end, start + 1), batch.num_rows)
        yield batch.slice(start, end - start)
        start = end
    give_back()


def word_spans(data: np.ndarray, edges: np.ndarray, breaks: np.ndarray = _IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (byte positions in ``data``) of all words, and how many words each row has.

    ``breaks`` tells which bytes lie between words; white space if it is not given."""
    low, high = int(edges[0]), int(edges[-1])
    inside = ~breaks[data[low:high]]
    rows = len(edges) - 1
    if not len(inside):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(rows, np.int64)
    filled = edges[:-1] < edges[1:]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[edges[:-1][filled] - low] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[edges[1:][filled] - 1 - low] = False
    ends = np.flatnonzero(inside & ~after) + 1
    counts = np.diff(np.searchsorted(starts, edges - low))
    return starts + low, ends + low, counts


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """64-bit hashes of ascending byte spans (A-Z as a-z if ``fold``), of ``WINDOW`` bytes of text at a time."""
    out = np.empty(len(starts), dtype=np.uint64)
    table = _FOLDED if fold else _LETTERS
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, low + WINDOW, side="right")))
        part = data[low : int(ends[j - 1])]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(table[part] * _powers_of(_BASE, len(part)), out=sums[1:])
        a, b = starts[i:j] - low, ends[i:j] - low
        value = (sums[b] - sums[a]) * _powers_of(_INVERSE, len(part) + 1)[a]
        out[i:j] = mix(value + (b - a).astype(np.uint64) * np.uint64(_INVERSE))
        i = j
    return out


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of the texts in order, A-Z as a-z, and the edges of the rows in them."""
    data, edges = text_bytes(texts)
    starts, ends, counts = word_spans(data, edges)
    return span_hashes(data, starts, ends), np.concatenate([[0], np.cumsum(counts)])


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of ``size`` neighbours, whatever rows they belong to."""
    count = max(0, len(words) - size + 1)
    value = np.full(count, size, dtype=np.uint64)
    for k in range(size):
        value = mix(value * np.uint64(_BASE) + words[k : k + count])
    return value


# Components -----------------------------------------------------------------------------------------------------


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of links (a, b): one row (id, root) per linked id, root being the smallest id reached.

    Alternates two star steps, each one aggregation and one join: every id points its larger neighbours, then its
    smaller ones, to the smallest of its neighbourhood, until all edges lead to roots. Edges never leave Spark; each
    round is written to the shared folder.
    """
    edges = saved(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    )
    for _ in range(rounds):
        if edges.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Larger neighbours of every id, and the id itself, point to the smallest id around it.
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        step = saved(
            small.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        # Done when no id points to two roots and no root points on.
        loose = step.groupBy("a").count().where("count > 1").select("a").unionByName(
            step.select(F.col("b").alias("a")).distinct().join(step.select("a").distinct(), "a", "left_semi")
        )
        edges = step
        if loose.isEmpty():
            break
    else:
        raise RuntimeError("the components did not settle")
    roots = edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
    return roots.unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
