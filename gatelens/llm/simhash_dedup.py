"""Near-duplicate documents by SimHash fingerprints and deletion-variant signatures.

Fingerprints that differ in at most ``distance`` bits are linked. A fingerprint is cut into so few segments that one of
them differs in at most one bit (of 64 bits and four differences: three segments, for two differences in each would be
six). Each segment is indexed once per bit with that bit as a wildcard, so a segment that differs in one bit or in none
has an equal variant: candidates come from an equality join, and whole fingerprints decide.

Equal fingerprints are one class, pre-aggregated, so copies cost nothing further. A variant that many fingerprints share
is cut into blocks that meet each other in tasks of their own; a task compares a block by shifting it against itself and
sends on only as many links as join its components, never all pairs. No fingerprint and no pair is left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelens.llm.common import SPACES, WINDOW, components, lower_ascii, row_slices, saved, ship, text_bytes, word_spans

BITS = 64
SEED = 42
#: Fingerprints of one variant that meet in one task; a variant with more is cut into blocks of about this size.
BLOCK = 4096
#: A class is large if it holds more than this share of all rows, so there are never more than 1,000 large ones.
LARGE_SHARE = 1 / 1000


# Fingerprints ---------------------------------------------------------------------------------------------------

#: Every white space byte as a blank.
_BLANKS = bytes(32 if chr(i) in SPACES else i for i in range(256))

def _majority(hashes: np.ndarray) -> int:
    """The number whose bits are those set in over half of the hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 8192):
        part = np.ascontiguousarray(hashes[i : i + 8192]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def _shingle_hashes(joined: bytes, starts: list[int], ends: list[int], size: int) -> np.ndarray:
    """XXH64 of every run of ``size`` words; the words lie in ``joined`` with one blank between them."""
    last = ends[size - 1 :] if len(ends) >= size else ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, last, strict=False)), np.uint64, len(last))


def _fingerprints(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text", WINDOW):
                data, edges = text_bytes(part.column("text"))
                starts, ends, counts = word_spans(data, edges)
                at = np.concatenate([[0], np.cumsum(counts)])
                prints = np.zeros(part.num_rows, np.uint64)
                for i in np.flatnonzero(counts):
                    a, b = starts[at[i] : at[i + 1]], ends[at[i] : at[i + 1]]
                    # Words joined by one blank: every byte of a word, and the byte after it as the blank.
                    lengths = b - a
                    places = np.cumsum(lengths + 1) - lengths - 1
                    low = int(a[0])
                    text = data[low : int(b[-1])]
                    alone = len(text) == int(lengths.sum()) + len(lengths) - 1
                    joined = text.tobytes().translate(_BLANKS) if alone else b" ".join(text.tobytes().split(None))
                    prints[i] = _majority(_shingle_hashes(joined, places.tolist(), (places + lengths).tolist(), size))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(prints.view(np.int64))], names=["id", "print"])

    return run


# Variants -------------------------------------------------------------------------------------------------------


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the fewest segments of which one must differ in at most one bit."""
    count = distance // 2 + 1
    edges = [round(BITS * k / count) for k in range(count + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def variants(name: str, distance: int) -> Column:
    """The keys of a fingerprint: per bit of each segment, the segment with this bit blanked out. The bit's number
    stands above the segment, so keys of different wildcards never meet."""
    keys = []
    for first, length in segments(distance):
        segment = F.shiftrightunsigned(name, first)
        for bit in range(length):
            kept = ((1 << length) - 1) & ~(1 << bit)
            blanked = segment.bitwiseAND(F.lit(kept - (1 << BITS) if kept >= 1 << (BITS - 1) else kept).cast("long"))
            # Wide segments are hashed; should two hashes agree by chance, whole fingerprints tell them apart.
            keys.append(blanked.bitwiseOR(F.lit((first + bit) << 32).cast("long")) if length <= 32 else F.xxhash64(F.lit(first + bit), blanked))
    return F.array(*keys)


def _join_blocks(distance: int):
    """Of sorted rows (key, low, high, print): links that join the components of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, prints in _whole_groups(batches):
            change = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            edges = np.concatenate([[0], change, [len(prints)]])
            end = np.repeat(edges[1:], np.diff(edges))
            root = np.arange(len(prints))
            at, shift = np.arange(len(prints)), 1
            while True:
                at = at[at + shift < end[at]]
                if not len(at):
                    break
                other = at + shift
                apart = root[at] != root[other]
                a, b = at[apart], other[apart]
                near = np.bitwise_count(prints[a] ^ prints[b]) <= distance
                _unite(root, a[near], b[near])
                shift += 1
            linked = np.flatnonzero((root != np.arange(len(root))) & (prints != prints[root]))
            if len(linked):
                columns = [pa.array(prints[linked].view(np.int64)), pa.array(prints[root[linked]].view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["a", "b"])

    return run


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the components of the pairs; afterwards every root is a smallest place and points to itself."""
    while len(a):
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
        if not len(a):
            return
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root[:] = up


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of sorted batches, cut between groups only."""
    keys = prints = None
    for batch in batches:
        k = np.stack([batch.column(n).to_numpy() for n in ("key", "low", "high")], axis=1).astype(np.int64)
        p = batch.column("print").to_numpy().view(np.uint64)
        if keys is not None:
            k, p = np.concatenate([keys, k]), np.concatenate([prints, p])
        last = np.flatnonzero((k != k[-1]).any(axis=1)) if len(k) else []
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield k[:cut], p[:cut]
        keys, prints = k[cut:], p[cut:]
    if keys is not None and len(keys):
        yield keys, prints


def linked_fingerprints(prints: DataFrame, distance: int) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints ``print`` at most ``distance`` bits apart, directly or through
    others, into the same components."""
    spark = prints.sparkSession
    ship(spark)
    keyed = prints.select("print", F.explode(variants("print", distance)).alias("key"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    # Variants that one block can't hold. Their number is at most that of all variants over the size of a block.
    crowded = saved(sizes.where(F.col("n") > BLOCK).select("key", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")))
    whole = F.lit(0).alias("low"), F.lit(0).alias("high")
    if crowded.isEmpty():
        dealt = keyed.select("key", *whole, "print")
    else:
        rest = keyed.join(crowded, "key", "left_anti").select("key", *whole, "print")
        own = F.pmod(F.xxhash64("print"), F.col("blocks")).cast("int")
        cut = keyed.join(crowded, "key").withColumn("own", own).select("key", "print", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        dealt = rest.unionByName(cut.select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "print"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    together = dealt.repartition(parts, "key", "low", "high").sortWithinPartitions("key", "low", "high")
    return together.mapInArrow(_join_blocks(distance), "a long, b long").distinct()


# Documents ------------------------------------------------------------------------------------------------------


def with_class_value(rows: DataFrame, classes: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with ``classes`` (one row per key, ``n`` rows of its own each). The large classes, 1,000 at most,
    are broadcast, so that none of them goes to one task; the others meet by a shuffle."""
    large = classes.where(F.col("n") > total * LARGE_SHARE)
    small = classes.where(F.col("n") <= total * LARGE_SHARE)
    in_large = rows.join(F.broadcast(large), key)
    others = rows.join(F.broadcast(large.select(key)), key, "left_anti").join(small, key)
    return in_large.unionByName(others).drop("n")


def simhash_duplicates(docs: DataFrame, words: int = 4, distance: int = 4, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Fingerprints and components: (id_column, fingerprint, component_id), one row per row of ``docs``.

    A text is cut into words at white space (blank, \\t to \\r), A-Z lower-cased. Its shingles are all runs of ``words``
    words, repeats included, joined by blanks (the whole sequence if it has fewer words). A bit of the fingerprint is set
    if it is set in over half of the shingles' XXH64 values (seed 42). Rows whose fingerprints differ in at most
    ``distance`` bits are linked; ``component_id`` is the smallest id that links reach.

    Defined cases: a null, empty or blank text has the fingerprint zero and is linked like any other. A row with a null
    id links as others do; a component without any id has a null component_id. Rows that repeat or share an id are a row
    each and linked by their own texts. An empty table gives an empty result. Other columns, whatever their names, play
    no part. Ids are integers.
    """
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(F.col(id_column).cast("long").alias("id"), lower_ascii(F.col(text_column)).alias("text"))
    signed = saved(texts.mapInArrow(_fingerprints(words), "id long, print long"))
    classes = saved(signed.groupBy("print").agg(F.min("id").alias("least"), F.count("*").alias("n")))
    roots = components(linked_fingerprints(classes.select("print"), distance)).select(F.col("id").alias("print"), "root")
    placed = saved(classes.join(roots, "print", "left").select("print", "least", F.col("n").alias("own"), F.coalesce("root", "print").alias("root")))
    least = placed.groupBy("root").agg(F.min("least").alias("component"), F.count("*").alias("n"))
    of_print = with_class_value(placed.select("print", "own", "root"), least, "root", placed.count())
    of_print = saved(of_print.select("print", "component", F.col("own").alias("n")))
    found = with_class_value(signed, of_print, "print", signed.count())
    fingerprint = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return found.select(F.col("id").alias(id_column), fingerprint, F.col("component").alias("component_id"))
