"""Documents packed into sequences of a fixed length, best fit decreasing.

Tokens are made once, in tasks; what follows moves lengths and numbers only. Best fit decreasing takes pieces from the
longest to the shortest and gives each the open sequence with the least room that suffices. Pieces of one length are
alike, so the plan needs only how many pieces there are of each length (at most ``capacity`` rows, whatever the corpus):
a segment tree over remaining capacities finds the tightest class of open sequences in logarithmic time, and a run of
equal pieces goes to a run of equal sequences at once. The plan is exactly that of best fit decreasing over the whole
corpus, not of each partition. Pieces then find their place by their rank among those of their length; ranks are counted
in hashed parts, so a length that many pieces share is no hot spot.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatelens.llm.common import kept, row_slices, saved, ship, span_hashes, text_bytes, word_spans

#: Words whose ids a Python worker keeps; when it has tokenized more, it begins anew.
KEPT_WORDS = 1_500_000
#: The first bits of a word's hash are its place in a table; a word that comes to a taken place takes it.
SLOT_BITS = 21
#: Bytes of text tokenized at once; what is made of them stays in the processor's caches, about.
SLICE = 1 << 20
#: Marks at a word's end are split off up to this many.
MARKS = 8


_LATIN_WORD = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+")
#: The letters by which byte-level models name bytes, for the bytes of such words.
_BYTE_LETTERS = {b: 256 + 33 + b - 127 for b in range(127, 161)} | {173: 256 + 67}
_LETTER_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _byte_letters(word: str) -> str:
    word = word.lower()
    return word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS)


def _is_letter_run_bpe(spec: dict) -> bool:
    """Whether the tokenizer hands a run of Latin letters to a byte-level BPE model as one piece, in lower case: its model
    alone then gives the ids of such words."""
    steps = [(s["type"], s.get("pattern")) for s in (spec.get("normalizer") or {}).get("normalizers", ())]
    cuts = [{k: v for k, v in s.items() if k != "trim_offsets"} for s in (spec.get("pre_tokenizer") or {}).get("pretokenizers", ())]
    return (
        steps == [("NFC", None), ("Replace", {"Regex": r"\s+"}), ("Lowercase", None)]
        and cuts
        == [
            {"type": "Split", "pattern": {"Regex": _LETTER_RUNS}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False},
        ]
        and spec["model"]["type"] == "BPE"
        and not spec["model"].get("dropout")
        and all("|" in token["content"] for token in spec.get("added_tokens", ()))
        and not any(spec.get(part) for part in ("truncation", "padding"))
    )


class _WordIds:
    """Ids of words, each tokenized about once: white space separates the tokenizer's words and is dropped by it, and it
    lower-cases letters, so a word's ids don't depend on its neighbours or on the case of A-Z."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model if _is_letter_run_bpe(json.loads(self.tokenizer.to_str())) else None
        self.end_id = end_id
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << SLOT_BITS, np.uint64)  # 0 is an empty place
        self.first = np.zeros(1 << SLOT_BITS, np.int32)
        self.sizes = np.zeros(1 << SLOT_BITS, np.int32)
        self.flat = np.full(1 << 16, self.end_id, np.uint32)  # place 0 holds the id that ends a document
        self.words, self.used = 0, 1

    def _tokenize(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of new words begin, and how many they are."""
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        if self.model is None:
            ids = [e.ids for e in encode(words, add_special_tokens=False)]
        else:
            tokenize = self.model.tokenize
            ids = [[t.id for t in tokenize(_byte_letters(w))] if _LATIN_WORD.fullmatch(w) else None for w in words]
            others = [n for n, x in enumerate(ids) if x is None]
            for n, e in zip(others, encode([words[n] for n in others], add_special_tokens=False), strict=True):
                ids[n] = e.ids
        sizes = np.fromiter(map(len, ids), np.int32, len(ids))
        begin, end = self.used, self.used + int(sizes.sum())
        if end > len(self.flat):
            self.flat = np.concatenate([self.flat[:begin], np.empty(2 * end - begin, np.uint32)])
        self.flat[begin:end] = np.fromiter(chain.from_iterable(ids), np.uint32, end - begin)
        self.words, self.used = self.words + len(ids), end
        return (begin + np.cumsum(sizes, dtype=np.int64) - sizes).astype(np.int32), sizes

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, the end id after each, and the edges of the texts in them."""
        data, edges = text_bytes(texts)
        starts, ends, counts = word_spans(data, edges)
        starts, ends, counts = _without_marks(data, starts, ends, counts)
        keys = span_hashes(data, starts, ends)
        special = _holds_bar(data, starts, ends)
        if special.any():  # special tokens are found before letters are lower-cased
            keys[special] = span_hashes(data, starts[special], ends[special], fold=False) + np.uint64(1)
        keys[keys == 0] = 1
        if self.words > KEPT_WORDS:
            self.clear()
        slots = (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int32)
        first, sizes = self.first[slots], self.sizes[slots]
        missing = np.flatnonzero(self.keys[slots] != keys)
        if len(missing):
            distinct, new, inverse = np.unique(keys[missing], return_index=True, return_inverse=True)
            new = missing[new]
            raw = memoryview(data)
            words = [str(raw[a:b], "utf-8", "replace") for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)]
            places, lengths = self._tokenize(words)
            first[missing], sizes[missing] = places[inverse], lengths[inverse]
            taken = slots[new]  # ascending, as the keys are
            last = np.append(taken[1:] != taken[:-1], True)
            self.keys[taken[last]], self.first[taken[last]], self.sizes[taken[last]] = distinct[last], places[last], lengths[last]
        # One more "word" of one id, at place 0, ends each text.
        text_ends = np.cumsum(counts)
        first = np.insert(first, text_ends, 0)
        sizes = np.insert(sizes, text_ends, 1)
        upto = np.zeros(len(sizes) + 1, np.int64)
        np.cumsum(sizes, out=upto[1:])
        ids = self.flat[np.repeat(first - upto[:-1], sizes) + np.arange(upto[-1])]
        return ids, upto[np.concatenate([[0], text_ends + np.arange(1, len(counts) + 1)])]


_IS_MARK = np.zeros(256, bool)  # ASCII signs, without the vertical bar of special tokens
_IS_MARK[33:48] = _IS_MARK[58:65] = _IS_MARK[91:97] = _IS_MARK[123:127] = True
_IS_MARK[124] = False
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[65:91] = _IS_LETTER[97:123] = True
_IS_LATIN = np.zeros(256, bool)  # second bytes of the letters U+00C0 to U+00FF, without two signs among them
_IS_LATIN[0x80:0xC0] = True
_IS_LATIN[[0x97, 0xB7]] = False


def _without_marks(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Splits final marks off words that end in a Latin letter before them: the tokenizer does so itself, taking a run of
    marks as one piece, and fewer distinct words are left."""
    if not len(starts):
        return starts, ends, counts
    cut = ends.copy()
    marked = np.flatnonzero(_IS_MARK[data[ends - 1]])
    for _ in range(MARKS):
        cut[marked] -= 1
        marked = marked[cut[marked] > starts[marked]]
        marked = marked[_IS_MARK[data[cut[marked] - 1]]]
    at = np.flatnonzero((cut < ends) & (cut > starts))
    before, earlier = data[cut[at] - 1], data[np.maximum(cut[at] - 2, 0)]
    at = at[_IS_LETTER[before] | (_IS_LATIN[before] & (earlier == 0xC3) & (cut[at] - starts[at] >= 2))]
    split = np.zeros(len(starts), bool)
    split[at] = True
    new_starts = np.insert(starts, at + 1, cut[at])
    new_ends = ends.copy()
    new_ends[at] = cut[at]
    new_ends = np.insert(new_ends, at + 1, ends[at])
    sums = np.concatenate([[0], np.cumsum(split)])
    edges = np.concatenate([[0], np.cumsum(counts)])
    return new_starts, new_ends, counts + np.diff(sums[edges])


def _holds_bar(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Words with a vertical bar, as all special tokens have."""
    if not len(starts):
        return np.zeros(0, bool)
    low = int(starts[0])
    bars = np.flatnonzero(data[low : int(ends[-1])] == 124) + low
    return np.searchsorted(bars, ends) > np.searchsorted(bars, starts)


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept(("packing", path, end_id), lambda: _WordIds(path, end_id))
        for batch in batches:
            for part in row_slices(batch, "text", SLICE):
                ids, edges = words.of(part.column("text"))
                ids = ids.astype("<u4", copy=False)
                sizes = np.diff(edges)
                pieces = -(-sizes // capacity)
                row = np.repeat(np.arange(len(sizes)), pieces)
                number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = number * capacity
                length = np.minimum(capacity, sizes[row] - start)
                low = edges[:-1][row] + start
                crcs = [zlib.crc32(ids[a:b]) for a, b in zip(low.tolist(), (low + length).tolist(), strict=True)]
                columns = [part.column("id").take(pa.array(row)), pa.array(number.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crcs, pa.int64())]
                if with_ids:  # the pieces cut the ids without gaps
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(low, edges[-1]).astype(np.int32)), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "piece", "start", "length", "ids_crc32", "ids"][: len(columns)])

    return run


class CapacityTree:
    """How many open sequences have each remaining capacity, as a segment tree."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.sums = [0] * (2 * self.leaves)

    def add(self, room: int, count: int) -> None:
        at = self.leaves + room
        while at:
            self.sums[at] += count
            at >>= 1

    def tightest(self, length: int) -> int | None:
        """The smallest remaining capacity of at least ``length`` that an open sequence has."""
        at = self.leaves + length
        if self.sums[at]:
            return length
        while at > 1:
            if not at & 1 and self.sums[at + 1]:  # the next subtree to the right has one
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.sums[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return None


def plan_runs(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit decreasing for ``counts`` pieces of each length.

    Runs (length, first rank, pieces, first sequence, pieces per sequence, offset of the first): the piece with rank
    ``first rank + k`` goes to sequence ``first sequence + k // per`` at ``offset + k % per * length``.
    """
    tree = CapacityTree(capacity)
    open_runs: dict[int, list[tuple[int, int]]] = {}  # by remaining capacity: (first sequence, sequences)
    runs, opened = [], 0

    def leave(room: int, first: int, count: int) -> None:
        if count and room:
            open_runs.setdefault(room, []).append((first, count))
            tree.add(room, count)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            room = tree.tightest(length)
            if room is None:  # new sequences, each filled with as many pieces as fit before the next one opens
                room, first = capacity, opened
                have = -(-left // (capacity // length))
                opened += have
            else:
                first, have = open_runs[room].pop()
                tree.add(room, -have)
            fit = room // length
            full = min(have, left // fit)
            if full:
                runs.append((length, rank, full * fit, first, fit, capacity - room))
                leave(room - fit * length, first, full)
                rank, left = rank + full * fit, left - full * fit
            if left and full < have:  # fewer pieces than one more sequence takes
                runs.append((length, rank, left, first + full, left, capacity - room))
                leave(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            leave(room, first + full, have - full)
    return runs


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text", with_ids: bool = False
) -> DataFrame:
    """Pieces of all documents and their places: (id_column, piece, start, length, ids_crc32, sequence_id, offset), and
    the piece's ``ids`` if ``with_ids``.

    A document is its text's token ids and then ``end_id``; only those longer than ``capacity`` are cut, into pieces of
    that length and a rest. ``offset`` is the place in the sequence; offsets are gapless from 0.

    Defined cases: a null or empty text is its end id alone; a null id stays null; rows that repeat or share an id are
    packed each; equal lengths take places in the order in which rows are read. An empty table gives an empty result.
    Other columns, whatever their names, play no part. ``tokenizer_path`` must be readable on every executor; the
    tokenizer must drop white space and fold the case of A-Z.
    """
    spark = docs.sparkSession
    ship(spark)
    id_type = dict(docs.dtypes)[id_column]
    schema = f"id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    pieces = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(_cut(tokenizer_path, capacity, end_id, with_ids), schema)
    # Written once: texts are tokenized once, and the order of rows is fixed from here on.
    pieces = saved(pieces.withColumn("row", F.monotonically_increasing_id()))
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    counted = saved(pieces.groupBy("length", "part").agg(F.count("*").alias("n")))
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    runs = np.array(sorted(plan_runs(counts, capacity)), dtype=np.int64).reshape(-1, 6)
    firsts = (runs[:, 0] << np.int64(44)) + runs[:, 1]

    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counted.select("length", "part", F.coalesce(before, F.lit(0)).alias("before"))
    ranked = pieces.withColumn("rank", F.row_number().over(Window.partitionBy("length", "part").orderBy("row")) - 1).join(offsets, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("rank") + F.col("before")).drop("before", "part", "row")
    out = [c for c in ranked.columns if c not in ("rank", "length")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            run = runs[np.searchsorted(firsts, (length << np.int64(44)) + rank, side="right") - 1]
            k = rank - run[:, 1]
            sequence = run[:, 3] + k // run[:, 4]
            offset = run[:, 5] + k % run[:, 4] * length
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in out), b.column("length"), pa.array(sequence), pa.array(offset)], names=[*out, "length", "sequence_id", "offset"])

    types = dict(ranked.dtypes)
    placed = ranked.mapInArrow(place, ", ".join(f"{c} {types[c]}" for c in out) + ", length long, sequence_id long, offset long")
    columns = [F.col("id").alias(id_column), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return placed.select(*columns, *["ids"] * with_ids)
