"""Near-duplicate documents by MinHash bands, odd sketches and a check on full sets.

One pass over the texts gives every document its set of word shingles, and of the set a fingerprint, MinHash samples
folded into band keys, and an odd sketch: a bitmap in which each sample flips one bit. The bits in which two sketches
differ tell how many samples differ, most precisely where sets are nearly equal, at the cost of a few bytes a pair.

Equal sets become one class with one representative, so copies are linked without pairs. Of the others, those that
share a band key are candidates, the sketches discard most, and the rest are compared on their full sets:

1. Every representative is compared with one document, the smallest in most of its buckets. This makes one component
   of each usual group with as many comparisons as it has members.
2. Whatever pairs of a bucket still lie in different components are compared too. Sketches of a bucket meet in blocks of
   bounded size; documents with a partner whose sketch agrees come back to their block with their texts, where pairs are
   compared on full sets until they are in one component or all tried. No pair is skipped, however large a bucket, and
   none leaves its task but for the links that join components.

A pair at similarity 0.8 shares none of 32 bands of 5 with probability 3e-6; the sketch's margin adds about as much.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatelens.llm.common import components, hashed_words, mix, random_words, row_slices, saved, ship, window_hashes

BANDS, ROWS = 32, 5
SKETCH_BITS = 1024
#: Candidates pass if the estimate is at least the threshold less this margin (five standard deviations).
MARGIN = 0.18
#: Members of a bucket, and of a group that is compared with one document, that one task handles together.
BLOCK, GROUP = 1000, 256
#: Shingles (8 bytes each) of one side of a block; a bucket of long texts is cut into more blocks.
BLOCK_SHINGLES = 4_000_000
#: Keys with more than this part of all rows, 1,000 at most, are joined by a broadcast and not in one task each.
LARGE_SHARE = 0.001
#: Ids that may be broadcast to pick texts (16 bytes each); longer lists are joined by a shuffle.
BROADCAST_IDS = 400_000


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a text of fewer words is one shingle, one without is none."""
    words, edges = hashed_words(texts)
    runs = window_hashes(words, size)
    for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if high - low >= size:
            yield np.unique(runs[low : high - size + 1])
        elif high > low:
            yield window_hashes(words[low:high], high - low)
        else:
            yield words[:0]


_SAMPLES = BANDS * ROWS
_ODD = random_words(_SAMPLES, 21) | np.uint64(1)
_SHIFT = random_words(_SAMPLES, 22)
_PLACE = random_words(_SAMPLES, 23)
_BAND = random_words(BANDS, 24)
_MARKS = random_words(2, 25)


def _samples(shingles: np.ndarray) -> np.ndarray:
    """The smallest of the set under each of the hash functions, over runs of the set so that memory stays bounded."""
    least = None
    for i in range(0, len(shingles), 2048):
        values = ((shingles[i : i + 2048, None] ^ _SHIFT) * _ODD).min(axis=0)
        least = values if least is None else np.minimum(least, values)
    return least


def _signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    least = _samples(shingles)
    bands = _BAND.copy()
    for column in least.reshape(BANDS, ROWS).T:
        bands = mix(bands + column)
    places = mix(least ^ _PLACE) & np.uint64(SKETCH_BITS - 1)
    bits = (np.bincount(places.astype(np.int64), minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return bands, np.packbits(bits).view(np.uint64)


def _lists(rows: list[np.ndarray | None], width: int) -> pa.Array:
    """Arrays of ``width`` longs per row; None is null."""
    given = [r for r in rows if r is not None]
    flat = np.concatenate(given).view(np.int64) if given else np.zeros(0, np.int64)
    present = np.array([r is not None for r in rows])
    edges = np.concatenate([[0], np.cumsum(present * width)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(edges, mask=np.append(~present, False)), pa.array(flat))


def _sign(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text"):
                counts, f1, f2, bands, sketches = [], [], [], [], []
                for s in shingle_sets(part.column("text"), size):
                    counts.append(len(s))
                    marks = [int(mix(s ^ m).sum(dtype=np.uint64)) for m in _MARKS]
                    f1.append(marks[0]), f2.append(marks[1])
                    b, k = _signature(s) if len(s) else (None, None)
                    bands.append(b), sketches.append(k)
                as_long = lambda x: pa.array(np.array(x, dtype=np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(counts, pa.int64()), as_long(f1), as_long(f2), _lists(bands, BANDS), _lists(sketches, SKETCH_BITS // 64)],
                    names=["id", "n", "f1", "f2", "bands", "sketch"],
                )

    return run


def sketch_limit(threshold: float) -> int:
    """The most bits in which the sketches of two sets of at least this similarity differ."""
    differing = 2 * _SAMPLES * (1 - max(0.0, threshold - MARGIN))
    return math.floor(SKETCH_BITS / 2 * (1 - math.exp(-2 * differing / SKETCH_BITS)))


def _differing(a: str, b: str):
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(SKETCH_BITS // 64)), F.lit(0))


def _confirm(size: int, percent: int):
    """Compares the members of each group with its first document, both as full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, firsts = None, []
        for batch in batches:
            for part in row_slices(batch, "text"):
                a, b = [], []
                rows = zip(part.column("hub").to_pylist(), part.column("salt").to_pylist(), part.column("id").to_pylist(), shingle_sets(part.column("text"), size), strict=True)
                for hub, salt, ident, own in rows:
                    if (hub, salt) != group:
                        group, firsts = (hub, salt), []
                    if ident == hub:
                        firsts.append(own)
                        continue
                    for first in firsts:
                        low, high = sorted((len(own), len(first)))
                        if not low or 100 * low < percent * high:
                            continue
                        common = _intersection(own, first)
                        if 100 * common >= percent * (low + high - common):
                            a.append(ident), b.append(hub)
                            break
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _links(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, hub) whose full sets are similar. A document with many partners is dealt out with each part of them."""
    spark = docs.sparkSession
    fan = saved(pairs.groupBy("hub").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("parts"), F.count("*").alias("_n")))
    members = _join_large(pairs, fan, ["hub"], pairs.count()).select(F.col("a").alias("id"), "hub", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int").alias("salt"), F.lit(1).alias("order"))
    hubs = fan.select(F.col("hub").alias("id"), "hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.lit(0).alias("order"))
    wanted = saved(members.unionByName(hubs))
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = docs.join(wanted, "id").select("hub", "salt", "order", "id", "text")
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = texts.repartition(shuffles, "hub", "salt").sortWithinPartitions("hub", "salt", "order")
    return saved(dealt.mapInArrow(_confirm(size, percent), "a long, b long"))


def _pairs(roots: np.ndarray, sides: np.ndarray, bands: np.ndarray, sketches: np.ndarray, band: int, limit: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each document of a block with its later partners: in another component, with a sketch that agrees, and with this
    band as the first that both have, so that a pair is looked at once."""
    for i in range(len(roots)):
        # Sides are 0 and 1 where two blocks meet, all 2 where a block meets itself.
        at = np.flatnonzero(sides > sides[i]) if sides[i] < 2 else np.arange(i + 1, len(roots))
        at = at[roots[at] != roots[i]]
        if not len(at):
            continue
        at = at[np.bitwise_count(sketches[at] ^ sketches[i]).sum(axis=1) <= limit]
        if not len(at):
            continue
        shared = bands[at] == bands[i]
        first = bands[i][shared.argmax(axis=1)]
        at = at[shared.any(axis=1) & (first == band)]
        if len(at):
            yield i, at


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """Rows of sorted batches by (band, low, high)."""
    group, rows = None, {n: [] for n in names}
    for batch in batches:
        keys = zip(*(batch.column(n).to_pylist() for n in ("band", "low", "high")), strict=True)
        values = zip(*(batch.column(n).to_pylist() for n in names), strict=True)
        for key, value in zip(keys, values, strict=True):
            if key != group:
                if len(rows[names[0]]) > 1:
                    yield group, rows
                group, rows = key, {n: [] for n in names}
            for n, v in zip(names, value, strict=True):
                rows[n].append(v)
    if len(rows[names[0]]) > 1:
        yield group, rows


def _meet(limit: int):
    """The documents of each block that have a partner there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (band, low, high), rows in _groups(batches, ("id", "root", "side", "bands", "sketch")):
            roots, sides = np.array(rows["root"], np.int64), np.array(rows["side"], np.int8)
            bands, sketches = np.array(rows["bands"], np.int64), np.array(rows["sketch"], np.int64)
            some = np.zeros(len(roots), bool)
            for i, at in _pairs(roots, sides, bands, sketches.view(np.uint64), band, limit):
                some[i] = some[at] = True
            n = int(some.sum())
            if n:
                ids = np.array(rows["id"], np.int64)[some]
                whole = [pa.array(np.full(n, x, kind)) for x, kind in ((band, np.int64), (low, np.int32), (high, np.int32))]
                yield pa.RecordBatch.from_arrays([*whole, pa.array(ids), pa.array(roots[some]), pa.array(sides[some].astype(np.int32))], names=["band", "low", "high", "id", "root", "side"])

    return run


#: Pairs of a block from which intersections are counted by a matrix product, and the most work that one may be.
DENSE_PAIRS, DENSE_WORK = 20_000, 1 << 41


def _common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray | None:
    """Sizes of the intersections of pairs of sets, through the shingles that several of the sets hold."""
    shingles, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    several = np.cumsum(counts > 1) - 1
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    keep = counts[inverse] > 1
    columns, owner = several[inverse][keep], owner[keep]
    width = int((counts > 1).sum())
    if len(sets) ** 2 * width > DENSE_WORK:
        return None
    total = np.zeros((len(sets), len(sets)), np.int64)
    order = np.argsort(columns, kind="stable")
    columns, owner = columns[order], owner[order]
    for start in range(0, width, 2048):
        a, b = np.searchsorted(columns, [start, start + 2048])
        dense = np.zeros((len(sets), min(2048, width - start)), np.float32)
        dense[owner[a:b], columns[a:b] - start] = 1
        total += (dense @ dense.T).astype(np.int64)  # exact: a product counts 2048 at most
    return total[left, right]


def _intersection(a: np.ndarray, b: np.ndarray) -> int:
    few, many = (a, b) if len(a) < len(b) else (b, a)
    at = np.searchsorted(many, few)
    return int((many[np.minimum(at, len(many) - 1)] == few).sum())


def _compare(size: int, percent: int, limit: int):
    """Links between the components of each block, on full sets: as many as join them, not all pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def with_sets():
            for batch in batches:
                for part in row_slices(batch, "text"):
                    sets = [s.tobytes() for s in shingle_sets(part.column("text"), size)]
                    columns = [part.column(n) for n in ("band", "low", "high", "id", "root", "side")]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(sets, pa.large_binary())], names=["band", "low", "high", "id", "root", "side", "set"])

        for (band, _, _), rows in _groups(with_sets(), ("id", "root", "side", "set")):
            # A row that comes without words is another text of its id; it has no links.
            sets = [np.frombuffer(s, np.uint64) for s in rows["set"]]
            some = [i for i, s in enumerate(sets) if len(s)]
            sets = [sets[i] for i in some]
            ids, roots = (np.array([rows[n][i] for i in some], np.int64) for n in ("id", "root"))
            sides = np.array([rows["side"][i] for i in some], np.int8)
            signatures = [_signature(s) for s in sets]
            if len(sets) < 2:
                continue
            bands, sketches = (np.stack([x[k] for x in signatures]) for k in (0, 1))
            found = list(_pairs(roots, sides, bands.view(np.int64), sketches, band, limit))
            if not found:
                continue
            left = np.concatenate([np.full(len(at), i) for i, at in found])
            right = np.concatenate([at for _, at in found])
            sizes = np.array([len(s) for s in sets])
            able = 100 * np.minimum(sizes[left], sizes[right]) >= percent * np.maximum(sizes[left], sizes[right])
            left, right = left[able], right[able]
            common = _common(sets, left, right) if len(left) > DENSE_PAIRS else None
            if common is not None:
                similar = 100 * common >= percent * (sizes[left] + sizes[right] - common)
                left, right = left[similar], right[similar]
            top = {r: r for r in roots.tolist()}

            def find(x: int, top=top) -> int:
                while top[x] != x:
                    top[x] = top[top[x]]
                    x = top[x]
                return x

            a, b = [], []
            for i, j in zip(left.tolist(), right.tolist(), strict=True):
                x, y = find(int(roots[i])), find(int(roots[j]))
                if x == y:
                    continue
                if common is None:
                    n = _intersection(sets[i], sets[j])
                    if 100 * n < percent * (sizes[i] + sizes[j] - n):
                        continue
                top[max(x, y)] = min(x, y)
                a.append(int(ids[i])), b.append(int(ids[j]))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def _join_large(rows: DataFrame, values: DataFrame, key: list[str], total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``values``, which say as ``_n`` how many of all ``total`` rows have their key. Keys with a
    large share of the rows, 1,000 at most, are broadcast, so that none of them goes to one task."""
    large, small = values.where(F.col("_n") > total * LARGE_SHARE).drop("_n"), values.where(F.col("_n") <= total * LARGE_SHARE).drop("_n")
    of_large = rows.join(F.broadcast(large), key)
    others = rows.join(F.broadcast(large.select(*key)), key, "left_anti").join(small, key, how)
    return of_large.unionByName(others)


def near_duplicates(docs: DataFrame, words: int = 5, threshold: float = 0.8, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Groups of near-duplicates: (id_column, n_shingles, component_id, kept), one row per row of ``docs``.

    A text's set is that of its shingles of ``words`` words (A-Z lower-cased); a text of fewer words is one shingle.
    Texts are linked if their sets' Jaccard similarity is at least ``threshold`` (in whole percent). ``component_id`` is
    the smallest id that links reach, ``kept`` whether it is the row's own.

    Defined cases: a text that is null, empty or without words has no shingles and is linked with nothing. A null id is
    linked with nothing, has a null component and is kept. Rows that share an id count as one document with all their
    texts. An empty table gives an empty result. Other columns, whatever their names, play no part. Ids are integers.
    """
    spark = docs.sparkSession
    ship(spark)
    percent = round(threshold * 100)
    limit = sketch_limit(threshold)
    docs = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    signed = saved(docs.mapInArrow(_sign(words), "id long, n long, f1 long, f2 long, bands array<long>, sketch array<long>"))

    some = signed.where("n > 0 and id is not null")
    texts = ["n", "f1", "f2"]
    classes = saved(some.groupBy(*texts).agg(F.min("id").alias("rep"), F.count("*").alias("_n")))
    n_rows = signed.count()
    members = saved(
        _join_large(some, classes, texts, n_rows).select("id", "rep", *(F.when(F.col("id") == F.col("rep"), F.col(c)).alias(c) for c in ("n", "bands", "sketch")))
    )
    reps = members.where("id = rep")
    sketches = reps.select("id", "sketch")
    banded = reps.select("id", "n", F.explode("bands").alias("band"))
    buckets = saved(banded.groupBy("band").agg(F.min("id").alias("hub"), F.count("*").alias("_n")).where("_n > 1"))
    n_banded = BANDS * reps.count()
    shared = saved(_join_large(banded, buckets, ["band"], n_banded).select("band", "id", "n", "hub"))

    # One comparison for each representative: with the smallest document in most of its buckets.
    votes = shared.where("id <> hub").groupBy("id", "hub").agg(F.count("*").alias("votes"))
    best = votes.groupBy("id").agg(F.max_by("hub", F.struct("votes", -F.col("hub"))).alias("hub"))
    best = saved(best.join(sketches, "id"))
    hubs = best.groupBy("hub").agg(F.count("*").alias("_n")).join(sketches.select(F.col("id").alias("hub"), F.col("sketch").alias("hub_sketch")), "hub")
    first = (
        _join_large(best, saved(hubs), ["hub"], best.count())
        .where(_differing("sketch", "hub_sketch") <= limit)
        .select(F.col("id").alias("a"), "hub")
        .distinct()
    )
    first = saved(first)
    links = _links(first, docs, words, percent)
    roots = saved(components(links))

    # Everything else that shares a bucket across components.
    one_each = shared.groupBy("band", "id").agg(F.max("n").alias("n"))
    placed = saved(one_each.join(roots, "id", "left").select("band", "id", "n", F.coalesce("root", "id").alias("root")))
    # Of a bucket with several components, the largest is cut into blocks that meet those of the others, but not each
    # other; so a large group with a few strays costs about as much as its members.
    per_root = placed.groupBy("band", "root").agg(F.count("*").alias("docs"), F.sum("n").alias("shingles"))
    blocks = lambda docs, shingles: F.ceil(F.greatest(docs / BLOCK, shingles / BLOCK_SHINGLES)).cast("int")
    size = F.struct("docs", "shingles", "root")
    open_bands = (
        per_root.groupBy("band")
        .agg(F.count("*").alias("roots"), F.max(size).alias("m"), F.sum("docs").alias("docs"), F.sum("shingles").alias("shingles"))
        .where("roots > 1")
        .select(
            "band", F.col("m.root").alias("major"), blocks(F.col("m.docs"), F.col("m.shingles")).alias("major_blocks"),
            blocks(F.col("docs") - F.col("m.docs"), F.col("shingles") - F.col("m.shingles")).alias("blocks"), F.col("docs").alias("_n"),
        )
    )
    open_bands = saved(open_bands)
    is_major = F.col("root") == F.col("major")
    hashed, first_other = F.xxhash64("id"), F.col("major_blocks")
    spread = (
        _join_large(placed, open_bands, ["band"], n_banded)
        .withColumn("own", F.when(is_major, F.pmod(hashed, first_other)).otherwise(first_other + F.pmod(hashed, F.col("blocks"))).cast("int"))
        .withColumn("from", F.when(is_major, first_other).otherwise(0))
        .select("band", "id", "root", "own", F.explode(F.sequence("from", first_other + F.col("blocks") - 1)).alias("other"))
        .select(
            "band", "id", "root", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
            F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
        )
    )
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block = ["band", "low", "high"]
    met = (
        spread.join(reps.select("id", "bands", "sketch"), "id")
        .select(*block, "id", "root", "side", "bands", "sketch")
        .repartition(shuffles, *block)
        .sortWithinPartitions(*block)
        .mapInArrow(_meet(limit), "band long, low int, high int, id long, root long, side int")
    )
    met = saved(met.distinct())
    wanted = F.broadcast(met) if met.count() <= BROADCAST_IDS else met
    texts = docs.join(wanted, "id").select(*block, "id", "root", "side", "text")
    dealt = texts.repartition(shuffles, *block).sortWithinPartitions(*block)
    further = saved(dealt.mapInArrow(_compare(words, percent, limit), "a long, b long"))

    # Rows that share an id but not their texts tie the classes of these texts together.
    tied = members.groupBy("id").agg(F.min("rep").alias("b"), F.max("rep").alias("last")).where("b < last").select("id", "b")
    ties = members.join(tied, "id").where("rep <> b").select(F.col("rep").alias("a"), "b")
    over = roots.select(F.col("id").alias("a"), "root")
    joined = (
        further.unionByName(ties).join(over, "a", "left").select(F.coalesce("root", "a").alias("a"), F.col("b"))
        .join(over.select(F.col("a").alias("b"), F.col("root").alias("b_root")), "b", "left")
        .select("a", F.coalesce("b_root", "b").alias("b"))
    )
    upper = components(joined).select(F.col("id").alias("root"), F.col("root").alias("top"))
    tops = roots.groupBy("root").agg(F.count("*").alias("_n")).join(upper, "root", "full").select("root", F.coalesce("top", "root").alias("top"), F.coalesce("_n", F.lit(1)).alias("_n"))
    # A class that has no link is its own root, and may be tied to others.
    root_of = classes.select("rep", F.col("_n").alias("copies")).join(roots.select(F.col("id").alias("rep"), "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    of_class = _join_large(root_of, saved(tops), ["root"], n_rows, "left").groupBy("rep").agg(F.min(F.coalesce("top", "root")).alias("top"), F.sum("copies").alias("_n"))
    of_rep = _join_large(members.select("id", "rep"), saved(of_class), ["rep"], n_rows).groupBy("id").agg(F.min("top").alias("component"))
    # Rows without an id have no component, and go to no task together.
    named, unnamed = signed.where("id is not null").select("id", "n").join(of_rep, "id", "left"), signed.where("id is null").select("id", "n")
    own = F.coalesce("component", "id")
    return named.unionByName(unnamed.withColumn("component", F.lit(None).cast("long"))).select(
        F.col("id").alias(id_column), F.col("n").alias("n_shingles"), own.alias("component_id"), F.coalesce(F.col("id") == own, F.lit(True)).alias("kept")
    )
