"""Benchmark passages in documents, also with other numbers, names or units.

Texts become sequences of canonical words: numbers (digits of any script, number words), names (capitalised words of any
script) and units after numbers are typed placeholders, everything else is itself in lower case without punctuation. A capitalised word that begins a sentence may be
a name or not; windows with such words are read both ways. Windows of ``window`` canonical words
are hashed and joined, once with the words as they are and once with placeholders. A bitmap of fixed size over the
benchmark's hashes lets documents send only windows that may match; the join then decides. Windows that agree word for
word count wherever they are. Those of which placeholders hold other values are lined up, and of each diagonal the longest
run counts in which each value of the benchmark's placeholders always met the same value in the document.
"""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatelens.llm.common import mix, random_words, row_slices, saved, ship, span_hashes, text_bytes, window_hashes, word_spans

#: Bits of the bitmap, in parts of what one bitmap aggregate holds (4 KB each, 4 MB in all).
BITMAP_PARTS, PART_BITS = 1024, 32768
#: Units that become a placeholder after a number.
UNITS = "mm cm m km in ft mi mg g kg t lb oz ml l s sec min h hr hours minutes seconds days weeks months years % percent € $ £ eur usd dollars euros cents mph kmh km/h °c °f".split()

_NUMBER, _NAME, _UNIT = (int(x) for x in random_words(3, 41))
# Number words (no articles) of English, German, French and Spanish.
NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million "
    "null eins zwei drei vier fünf sechs sieben acht neun zehn elf zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn neunzehn zwanzig dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend "
    "zéro deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente quarante cinquante soixante cent mille "
    "cero dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince dieciséis diecisiete dieciocho diecinueve veinte treinta cuarenta cincuenta sesenta setenta ochenta noventa cien mil"
).split()
_EDGE = np.zeros(256, bool)  # punctuation cut off both ends of a word
_EDGE[list(b"!\"#&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?:")] = True


def _cut_ends(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word spans without the punctuation at both ends; empty where nothing is left."""
    low, high = int(starts[0]), int(ends[-1])
    solid = np.flatnonzero(~_EDGE[data[low:high]]) + low
    if not len(solid):
        return starts, starts
    first = np.searchsorted(solid, starts)
    last = np.searchsorted(solid, ends) - 1
    some = first <= last
    inner = solid[np.minimum(first, len(solid) - 1)]
    outer = solid[np.maximum(last, 0)] + 1
    return np.where(some, inner, starts), np.where(some, outer, starts)


def _cut_money(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Starts of the words, without the signs and currency signs before a number."""
    at = starts
    for _ in range(4):  # such as -US dollar, minus, point
        x, y, z = (data[np.minimum(at + k, len(data) - 1)] for k in range(3))
        two = (x == 0xC2) & (((y >= 0xA2) & (y <= 0xA5)) | (y == 0xB1))
        three = (x == 0xE2) & (((y == 0x82) & (z >= 0xA0)) | ((y == 0x88) & (z == 0x92)))
        at = np.minimum(at + np.where(_EDGE[x] | (x == 36), 1, np.where(two, 2, np.where(three, 3, 0))), ends - 1)
    return np.where(_DIGIT[data[at]], at, starts)


def _first_letters(data: np.ndarray, at: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code points that begin at byte positions, 0 at the ends of words, and where the next ones begin."""
    x, y, z, w = (data[np.minimum(at + k, len(data) - 1)].astype(np.int32) for k in range(4))
    size = np.where(x < 0xC0, 1, np.where(x < 0xE0, 2, np.where(x < 0xF0, 3, 4)))
    tail = lambda v: v & 0x3F
    two, three = (x & 0x1F) << 6 | tail(y), (x & 0x0F) << 12 | tail(y) << 6 | tail(z)
    point = np.where(size == 1, x, np.where(size == 2, two, np.where(size == 3, three, (x & 0x07) << 18 | tail(y) << 12 | tail(z) << 6 | tail(w))))
    return np.where(at + size <= ends, point, 0), at + size


@functools.cache
def _kinds() -> np.ndarray:
    """Of every code point: 1 for a decimal digit, 2 for another letter than a capital, 0 for others."""
    names = map(unicodedata.category, map(chr, range(sys.maxunicode + 1)))
    return np.fromiter((1 if c == "Nd" else 2 if c[0] == "L" and c != "Lu" else 0 for c in names), np.int8, sys.maxunicode + 1)


@functools.cache
def _number_hashes() -> np.ndarray:
    """Number words, and English ones of two parts such as twenty-five."""
    at = NUMBER_WORDS.index("twenty")
    parts = [f"{ten}-{one}" for ten in NUMBER_WORDS[at : at + 8] for one in NUMBER_WORDS[1:10]]
    data, edges = text_bytes(pa.array(NUMBER_WORDS + parts))
    return np.unique(span_hashes(data, edges[:-1], edges[1:]))


def _lower(texts: pa.Array) -> pa.Array:
    """Letters of all scripts in lower case; of texts that are no valid UTF-8 A-Z only."""
    try:
        return pc.utf8_lower(texts)
    except pa.ArrowInvalid:
        return pc.ascii_lower(texts)


def canonical_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the canonical words, of the words themselves, of the values that placeholders stand for (0 for plain words), which
    words may be names that begin sentences, and the texts' edges."""
    data, edges = text_bytes(texts)
    starts, ends, counts = word_spans(data, edges)
    if not len(starts):
        none = np.zeros(0, np.uint64)
        return none, none, none, none.astype(bool), np.zeros(len(edges), np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    # A sentence begins with a text, with a line, and after a full stop.
    breaks = np.flatnonzero(data[int(starts[0]) : int(ends[-1])] == 10) + int(starts[0])
    begins = np.ones(len(starts), bool)
    begins[1:] = (row[1:] != row[:-1]) | _STOP[data[ends[:-1] - 1]] | (np.searchsorted(breaks, starts[1:]) > np.searchsorted(breaks, ends[:-1]))
    a, b = _cut_ends(data, starts, ends)
    some = a < b
    a, b, row, begins = a[some], b[some], row[some], begins[some]
    if not len(a):
        none = np.zeros(0, np.uint64)
        return none, none, none, none.astype(bool), np.zeros(len(edges), np.int64)
    a = _cut_money(data, a, b)
    folded, folded_edges = text_bytes(_lower(texts))
    c, d = _cut_ends(folded, *word_spans(folded, folded_edges)[:2])
    c, d = c[some], d[some]
    c = _cut_money(folded, c, d)
    plain = span_hashes(folded, c, d)
    # A capital of any script, which lower case changes, then a small letter, which it doesn't.
    kinds, (point, second), (lower, lower_second) = _kinds(), _first_letters(data, a, b), _first_letters(folded, c, d)
    after, beyond = _first_letters(data, second, b)[0], _first_letters(folded, lower_second, d)[0]
    numbers = _number_hashes()
    number = (kinds[point] == 1) | (numbers[np.minimum(np.searchsorted(numbers, plain), len(numbers) - 1)] == plain)
    name = (point != lower) & (after == beyond) & (kinds[after] == 2) & ~number
    name, may_be = name & ~begins, name & begins
    unit = np.zeros(len(a), bool)
    unit[1:] = number[:-1] & ~number[1:] & np.isin(plain[1:], _unit_hashes()) & (row[1:] == row[:-1])
    words = np.where(number, np.uint64(_NUMBER), np.where(name, np.uint64(_NAME), np.where(unit, np.uint64(_UNIT), plain)))
    values = np.where(number | name | unit, plain | np.uint64(1), np.uint64(0))
    return words, plain, values, may_be & ~unit, np.searchsorted(row, np.arange(len(counts) + 1))


def _unit_hashes() -> np.ndarray:
    data, edges = text_bytes(pa.array(UNITS))
    return span_hashes(data, edges[:-1], edges[1:])


def _windows(texts: pa.Array, window: int, lengths: list[int] | None) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]]:
    """Per kind of window its size, and of each the text, position, hash, whether at least half is plain words, and
    placeholders' values (None for windows of the words themselves). Below ``window`` words those of the given lengths, or
    whole texts."""
    words, plain, values, may_be, edges = canonical_words(texts)
    other_words, other_values = np.where(may_be, np.uint64(_NAME), words), np.where(may_be, plain | np.uint64(1), values)
    row = np.repeat(np.arange(len(edges) - 1), np.diff(edges))
    count = max(0, len(words) - window + 1)
    start = np.arange(count)
    slots, others = (np.concatenate([[0], np.cumsum(x)]) for x in (values > 0, may_be))
    slots, others = slots[start + window] - slots[start], others[start + window] - others[start]
    usable = window - slots >= window // 2
    readable = (others > 0) & (window - slots - others >= window // 2)
    whole = row[:count] == row[window - 1 : window - 1 + count]
    for hashes, kept, held in ((window_hashes(plain, window), True, None), (window_hashes(words, window), usable & (slots > 0), values), (window_hashes(other_words, window), readable, other_values)):
        at = np.flatnonzero(whole & kept)
        yield window, row[at], at - edges[row[at]], hashes[at], usable[at], None if held is None else held[at[:, None] + np.arange(window)]
    sizes = np.diff(edges)
    for size in np.unique(sizes[(sizes > 0) & (sizes < window)]).tolist() if lengths is None else lengths:
        hashes = window_hashes(plain, size)
        at = edges[:-1][sizes == size] if lengths is None else np.flatnonzero(row[: len(hashes)] == row[size - 1 : size - 1 + len(hashes)])
        yield size, row[at], np.zeros(len(at), np.int64), hashes[at], np.ones(len(at), bool), None


def _send(window: int, bitmap: np.ndarray | None, lengths: list[int] | None):
    """The windows of each text, only those in the bitmap if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text"):
                for size, row, place, hashes, usable, slots in _windows(part.column("text"), window, lengths):
                    if bitmap is not None:
                        bit = _bit(hashes)
                        hit = np.flatnonzero((bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1)
                        row, place, hashes, usable, slots = row[hit], place[hit], hashes[hit], usable[hit], None if slots is None else slots[hit]
                        if size < window:  # once is enough
                            once = np.unique(np.stack([row.astype(np.uint64), hashes]), axis=1, return_index=True)[1]
                            row, place, hashes, usable = row[once], place[once], hashes[once], usable[once]
                    if slots is None:
                        lists = pa.nulls(len(row), pa.list_(pa.int64()))
                    else:
                        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1, dtype=np.int32) * window), pa.array(slots.reshape(-1).view(np.int64)))
                    names = [n for n in part.schema.names if n != "text"]
                    own = [part.column(n).take(pa.array(row)) for n in names]
                    yield pa.RecordBatch.from_arrays([*own, pa.array(place.astype(np.int32)), pa.array(hashes.view(np.int64)), pa.array(_bit(hashes)), pa.array(np.full(len(row), size, np.int32)), pa.array(usable), lists], names=[*names, "place", "window", "bit", "size", "usable", "slots"])

    return run


def _longest_run(rows: list[tuple[int, list[int], list[int]]]) -> set[int]:
    """Of a diagonal's windows (place, values of the item, values of the document), the places of the longest run in which
    no value of the item meets two of the document."""
    pairs = [(place, {(x, y) for x, y in zip(ours, theirs, strict=True) if x}) for place, ours, theirs in sorted(rows)]
    pairs = [(place, bound) for place, bound in pairs if len(dict(bound)) == len(bound)]
    best: set[int] = set()
    first, met, uses = 0, {}, {}
    for k, (_, bound) in enumerate(pairs):
        while any(met.get(x, y) != y for x, y in bound):
            for x, _ in pairs[first][1]:
                uses[x] -= 1
                if not uses[x]:
                    del met[x]
            first += 1
        for x, y in bound:
            met[x] = y
            uses[x] = uses.get(x, 0) + 1
        if k + 1 - first > len(best):
            run = {p for p, _ in pairs[first : k + 1]}
            best = max(best, run, key=len)
    return best


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of each diagonal that count; a diagonal's rows follow each other."""
    keys, group, rows = None, None, {}
    for batch in batches:
        kept = []
        for k, (key, place, usable, ours, theirs) in enumerate(zip(batch.column("diagonal").to_pylist(), *(batch.column(n).to_pylist() for n in ("item_place", "usable", "item_slots", "slots")), strict=True)):
            if key != group:
                if rows:
                    kept.append((keys, rows))
                group, rows, keys = key, {}, batch.slice(k, 1)
            rows.setdefault((place, usable), []).append((place, ours, theirs))
        yield from _counted(kept, batch.schema)
    if rows:
        yield from _counted([(keys, rows)], keys.schema)


def _counted(groups: list[tuple[pa.RecordBatch, dict]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for first, rows in groups:
        run = _longest_run([r for found in rows.values() for r in found])
        places = sorted({k for k in rows if k[0] in run})
        own = [first.column(n).take(pa.array([0] * len(places), pa.int32())) for n in ("id", "t1", "t2", "item")]
        yield pa.RecordBatch.from_arrays([*own, pa.array([p for p, _ in places], pa.int32()), pa.array([u for _, u in places], pa.bool_())], names=["id", "t1", "t2", "item", "item_place", "usable"])


def _bit(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes) % np.uint64(BITMAP_PARTS * PART_BITS)).astype(np.int64)


def contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = 8, share: float = 0.5, run: int = 6, id_column: str = "doc_id", item_column: str = "item_id", text_column: str = "text"
) -> DataFrame:
    """Documents that hold benchmark items: (id_column, item_column, t1, t2, matched, windows, kind), a row per pair.

    A document holds an item if at least ``share`` of the item's windows, or ``run`` of them (13 words on end), match:
    word for word, or with other values in their slots, the same for the same value of the item along the longest such run
    of a diagonal (two values of the item may become one). ``kind`` is ``exact`` or, where placeholders hold other values, ``variant``. (t1, t2) is a
    fingerprint of the document's text, so that rows that share an id can be told apart.

    Defined cases: null and empty texts match nothing. Items of fewer than ``window`` words are held where all their words
    follow each other as they are; windows that are mostly placeholders match word for word only. Null ids stay null and are told apart by their texts. Repeated rows are reported once, with the
    windows of repeated items counted once. Either table may be empty: the result then is. Other columns, whatever their
    names, play no part.
    """
    spark = docs.sparkSession
    ship(spark)
    id_type, item_type = dict(docs.dtypes)[id_column], dict(benchmark.dtypes)[item_column]
    shape = "place int, window long, bit long, size int, usable boolean, slots array<long>"
    items = benchmark.select(F.col(item_column).alias("item"), F.col(text_column).alias("text")).mapInArrow(_send(window, None, None), f"item {item_type}, {shape}")
    # At most BITMAP_PARTS rows of 4 KB, however large the benchmark.
    parts = items.groupBy(F.floor(F.col("bit") / PART_BITS).cast("int").alias("part")).agg(F.bitmap_construct_agg(F.col("bit") % PART_BITS).alias("bits"), F.collect_set("size").alias("sizes")).collect()
    bitmap = np.zeros(BITMAP_PARTS * PART_BITS // 8, np.uint8)
    for r in parts:
        bitmap[r["part"] * PART_BITS // 8 : (r["part"] + 1) * PART_BITS // 8] = np.frombuffer(bytes(r["bits"]), np.uint8)

    lengths = sorted({n for r in parts for n in r["sizes"] if n < window})

    text = F.coalesce(F.col(text_column), F.lit(""))
    marked = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(7), text).alias("t2"), text.alias("text"))
    sent = marked.mapInArrow(_send(window, bitmap, lengths), f"id {id_type}, t1 long, t2 long, {shape}").drop("bit", "size", "usable")
    known = items.select("item", F.col("place").alias("item_place"), "window", "usable", F.col("slots").alias("item_slots")).distinct()
    met = saved(sent.join(known, "window"))  # texts are read once for both kinds of windows
    ids = ["id", "t1", "t2", "item"]
    exact = met.where("slots is null").select(*ids, "item_place", "usable", F.lit(True).alias("exact")).distinct()
    # Along a diagonal, words of the document and of the item move on together.
    line = [*ids, "line"]
    differing = met.where("slots is not null and slots <> item_slots").withColumn("line", F.col("place") - F.col("item_place"))
    differing = differing.select(*ids, "line", F.struct(*line).alias("diagonal"), "item_place", "usable", "item_slots", "slots").distinct()
    dealt = differing.repartition(*line).sortWithinPartitions(*line)
    counted = dealt.mapInArrow(_runs, f"id {id_type}, t1 long, t2 long, item {item_type}, item_place int, usable boolean").withColumn("exact", F.lit(False))
    places = exact.unionByName(counted).groupBy(*ids, "item_place", "usable").agg(F.max("exact").alias("exact"))
    held = places.groupBy(*ids).agg(F.count("*").alias("matched"), F.count_if("usable").alias("matched_usable"), F.min("exact").alias("exact"))
    sizes = known.groupBy("item", "item_place").agg(F.max("usable").alias("usable")).groupBy("item").agg(F.count("*").alias("windows"), F.count_if("usable").alias("usable"))
    enough = (F.col("matched") >= F.col("windows") * share) | (F.col("matched") >= run) | ((F.col("usable") > 0) & (F.col("matched_usable") >= F.col("usable") * share))
    return held.withColumnRenamed("item", "held_item").join(sizes, F.col("held_item").eqNullSafe(F.col("item"))).where(enough).select(
        F.col("id").alias(id_column), F.col("item").alias(item_column), "t1", "t2", "matched", "windows", F.when(F.col("exact"), "exact").otherwise("variant").alias("kind")
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` without the rows that :func:`contaminated` reports, null ids included."""
    found = contaminated(docs, benchmark, id_column=id_column, text_column=text_column, **options)
    prefix = "_found"
    while any(c.startswith(prefix) for c in docs.columns):  # the columns of docs may have any names
        prefix += "_"
    ident, t1, t2 = (f"{prefix}{n}" for n in ("id", "t1", "t2"))
    found = found.select(F.col(id_column).alias(ident), F.col("t1").alias(t1), F.col("t2").alias(t2)).distinct()
    text = F.coalesce(F.col(text_column), F.lit(""))
    same = F.col(id_column).eqNullSafe(F.col(ident)) & (F.xxhash64(text) == F.col(t1)) & (F.xxhash64(F.lit(7), text) == F.col(t2))
    return docs.join(found, same, "left_anti")
