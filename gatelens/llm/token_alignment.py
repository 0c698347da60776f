"""Alignment of two tokenizers: groups of tokens between shared cuts, and how strong each link of tokens is in the corpus.

Both tokenizations cover the same bytes, so a byte offset at which a token of each ends cuts the text for both. Cuts are
found by divide and conquer: near the middle of an interval a token end of the one is sought, by bisection, among the ends
of the other; the two halves go on by themselves, and an interval without a cut is one group. All intervals of a level, of
many documents, are worked on together. Within a group every two tokens whose bytes overlap are linked.

How often an id pair is linked is known only after the whole corpus. Texts are tokenized once: blocks of documents keep the
pairs of each document, and every block asks once for each of its distinct pairs. Totals are ordinary aggregations, and
what comes back to a block is one number per pair. Nothing is collected; a pair that all documents share is one row a block.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatelens.llm.common import give_back, row_slices, saved, ship, text_bytes

#: Bytes of text of a block, and of a run of documents that is aligned at once.
BLOCK_BYTES, RUN_BYTES = 16 << 20, 2 << 20
#: Pairs in one row of the exchange; a document or block with more has several rows.
ROW_PAIRS = 1 << 16
#: Fixed value: the pattern at which byte-level vocabularies cut text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# Tokenizers -----------------------------------------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteTokens:
    """Ids and bytes of a byte-level BPE file. Where its merges come in the order of their ids, as they should, the same
    merges run in tiktoken, which is four times as fast; texts that it can't take go to the tokenizer itself."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        known = self.tokenizer.get_vocab()
        letters = byte_letters()
        self.bytes = [b""] * (max(known.values()) + 1)
        added = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        for entry, ident in known.items():
            self.bytes[ident] = entry.encode() if entry in added else bytes(letters[c] for c in entry)
        self.fast = self._fast(json.loads(Path(path).read_text()), added)

    def _fast(self, parts: dict, added: set[str]):
        import tiktoken

        model, cut = parts["model"], parts["pre_tokenizer"] or {}
        usual = cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space") and parts["normalizer"] is None
        usual = usual and model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        merges = ["".join(m) if isinstance(m, list) else m.replace(" ", "") for m in model["merges"]]
        if not usual or any(model["vocab"].get(m) != 256 + k for k, m in enumerate(merges)):
            return None
        ranks = {self.bytes[ident]: ident for entry, ident in model["vocab"].items() if entry not in added}
        return tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text).astype(np.int64)
            except ValueError:  # too long a run of white space for its pattern matcher
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int64)


class PieceTokens:
    """Ids and bytes of a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        as_bytes = lambda i, piece: bytes([int(piece[3:5], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode()
        self.bytes = [as_bytes(i, self.model.id_to_piece(i)) for i in range(self.model.vocab_size())]

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text, num_threads=1), np.int64)


_loaded: dict[tuple[type, str], ByteTokens | PieceTokens] = {}


def _load(kind: type, path: str):
    if (kind, path) not in _loaded:
        _loaded[kind, path] = kind(path)
    return _loaded[kind, path]


# Alignment ------------------------------------------------------------------------------------------------------


def shared_cuts(a_ends: np.ndarray, b_ends: np.ndarray, a_edges: np.ndarray, b_edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of both sides that end at shared cuts, by divide and conquer; ``a_edges`` and ``b_edges`` cut the
    ascending ends into documents, the last tokens of which end together."""
    a_low, a_high, b_low, b_high = a_edges[:-1], a_edges[1:], b_edges[:-1], b_edges[1:]
    some = a_high > a_low
    a_found, b_found = [a_high[some] - 1], [b_high[some] - 1]
    while len(a_low):
        open_ = (a_high - a_low > 1) & (b_high - b_low > 1)  # others have no end inside
        a_low, a_high, b_low, b_high = a_low[open_], a_high[open_], b_low[open_], b_high[open_]
        cut_a, cut_b = _near_middle(a_ends, b_ends, a_low, a_high)
        hit = cut_a >= 0
        a_low, a_high, b_low, b_high, cut_a, cut_b = (x[hit] for x in (a_low, a_high, b_low, b_high, cut_a, cut_b))
        a_found.append(cut_a), b_found.append(cut_b)
        a_low, a_high = np.concatenate([a_low, cut_a + 1]), np.concatenate([cut_a + 1, a_high])
        b_low, b_high = np.concatenate([b_low, cut_b + 1]), np.concatenate([cut_b + 1, b_high])
    return np.sort(np.concatenate(a_found)), np.sort(np.concatenate(b_found))


def _near_middle(a_ends: np.ndarray, b_ends: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per interval the token nearest to its middle, but not its last, whose end the other side has too; -1 if none.
    Rings around the middle are tried, each as wide as all before it."""
    middle = (low + high - 2) >> 1
    cut_a, cut_b = np.full(len(low), -1, np.int64), np.full(len(low), -1, np.int64)
    todo, ring = np.arange(len(low)), 0
    while len(todo):
        inner, outer = (1 << ring) >> 1, max(1, 1 << ring)
        for sign in (-1, 1) if ring else (1,):
            if sign < 0:
                first = np.maximum(middle[todo] - outer + 1, low[todo])
                last = middle[todo] - inner
            else:
                first = middle[todo] + inner
                last = np.minimum(middle[todo] + outer - 1, high[todo] - 2)
            size = np.maximum(last - first + 1, 0)
            place = np.repeat(np.arange(len(todo)), size)
            probe = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
            at = np.searchsorted(b_ends, a_ends[probe])
            hit = b_ends[at] == a_ends[probe]
            place, probe, at = todo[place[hit]], probe[hit], at[hit]
            distance = np.abs(probe - middle[place])
            order = np.argsort(-distance, kind="stable")  # the nearest is written last
            place, probe, at, distance = place[order], probe[order], at[order], distance[order]
            better = (cut_a[place] < 0) | (distance < np.abs(cut_a[place] - middle[place]))
            cut_a[place[better]], cut_b[place[better]] = probe[better], at[better]
        ring += 1
        reach = (1 << ring) >> 1
        todo = todo[cut_a[todo] < 0]
        todo = todo[(middle[todo] - reach >= low[todo]) | (middle[todo] + reach <= high[todo] - 2)]
    return cut_a, cut_b


def overlaps(a_ends: np.ndarray, b_ends: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All links (token of A, token of B) whose bytes overlap. Each is known by where its common bytes end: with the
    token of A, or before it with that of B."""
    a_sizes, b_sizes = np.diff(a_cuts, prepend=-1), np.diff(b_cuts, prepend=-1)
    groups = np.arange(len(a_cuts))
    a_group, b_group = np.repeat(groups, a_sizes), np.repeat(groups, b_sizes)
    partner = b_cuts[a_group]  # of a group's last token, and wherever the other side is one token
    inside = np.ones(len(a_group), bool)
    inside[a_cuts] = False
    inside &= b_sizes[a_group] > 1
    partner[inside] = np.searchsorted(b_ends, a_ends[inside])
    others = np.ones(len(b_group), bool)
    others[b_cuts] = False
    others = np.flatnonzero(others)
    mate = a_cuts[b_group[others]]
    several = a_sizes[b_group[others]] > 1
    mate[several] = np.searchsorted(a_ends, b_ends[others[several]])
    return np.concatenate([np.arange(len(a_group)), mate]), np.concatenate([partner, others])


def _rendered(a_ids: np.ndarray, b_ids: np.ndarray, a_cuts: np.ndarray, b_cuts: np.ndarray, a_edges: np.ndarray, b_edges: np.ndarray) -> Iterator[bytes]:
    """``a1,a2|b1;a3|b2,b3`` of each document."""
    a_sizes, b_sizes = np.diff(a_cuts, prepend=-1), np.diff(b_cuts, prepend=-1)
    groups = np.arange(len(a_cuts))
    places_a = np.arange(len(a_ids)) + np.repeat((b_cuts + 1 - b_sizes)[groups], a_sizes)
    places_b = np.arange(len(b_ids)) + np.repeat((a_cuts + 1)[groups], b_sizes)
    ids = np.empty(len(a_ids) + len(b_ids), np.int64)
    ids[places_a], ids[places_b] = a_ids, b_ids
    after = np.full(len(ids), ord(","), np.uint8)
    after[places_a[a_cuts]] = ord("|")
    after[places_b[b_cuts]] = ord(";")
    edges = a_edges + b_edges
    after[edges[1:][edges[1:] > edges[:-1]] - 1] = 0
    digits = len(str(int(ids.max(initial=0))))
    cells = np.zeros((len(ids), digits + 1), np.uint8)
    left = ids.copy()
    for k in range(digits - 1, -1, -1):
        shown = (left > 0) | (k == digits - 1)
        cells[:, k] = np.where(shown, left % 10 + 48, 0)
        left //= 10
    cells[:, digits] = after
    flat = cells.ravel()
    text = flat[flat != 0]
    upto = np.concatenate([[0], np.cumsum((cells != 0).sum(axis=1))])[edges]
    for low, high in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True):
        yield text[low:high].tobytes()


# Passes over the corpus -------------------------------------------------------------------------------------------


def _tokenized(first: ByteTokens, second: PieceTokens, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Both sides' ids; none for a text that one of them doesn't give back byte by byte."""
    none = np.zeros(0, np.int64)
    a, b = [], []
    for text in texts:
        left = right = none
        if text:
            whole = b" " + text.encode()
            left, right = first.encode(" " + text), second.encode(text)
            if b"".join(map(first.bytes.__getitem__, left.tolist())) != whole or b"".join(map(second.bytes.__getitem__, right.tolist())) != whole:
                left = right = none
        a.append(left), b.append(right)
    return a, b


def _ends(ids: list[np.ndarray], table: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids, where each token's bytes end if all texts follow each other, and the edges of the documents."""
    flat = np.concatenate([*ids, np.zeros(0, np.int64)])
    return flat, np.cumsum(np.array([len(t) for t in table], np.int64)[flat]), np.concatenate([[0], np.cumsum([len(x) for x in ids])])


DOC = "block long, row long, part int, id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def _align(a_path: str, b_path: str, kind: str):
    number = np.int32 if kind == "int" else np.int64

    def rows(block: int, row: list[int], part: list[int], facts: list[tuple], pairs: list[np.ndarray], counts: list[np.ndarray], of_block: bool) -> pa.RecordBatch:
        longs = [pa.array([f[k] for f in facts], pa.int64()) for k in range(5)]
        edges = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in pairs])]).astype(np.int32))
        flat, times = (np.concatenate([*x, np.zeros(0, np.int64)]) for x in (pairs, counts))
        columns = [
            pa.array(np.full(len(row), block)), pa.array(row, pa.int64()), pa.array(part, pa.int32()), *longs, pa.array([f[5] for f in facts], pa.string()),
            pa.ListArray.from_arrays(edges, pa.array(flat.astype(number))), pa.ListArray.from_arrays(edges, pa.array(times.astype(np.int64 if of_block else np.int16))),
        ]
        if of_block:
            columns.insert(10, pa.nulls(len(row), pa.list_(pa.int16())))
        else:
            columns.append(pa.nulls(len(row), pa.list_(pa.int64())))
        names = ["block", "row", "part", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "counts", "totals"]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(row), of_block))], names=[*names, "of_block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _load(ByteTokens, a_path), _load(PieceTokens, b_path)
        width = len(second.bytes)
        block, row, size = TaskContext.get().partitionId() << 24, 0, 0
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def asked() -> Iterator[pa.RecordBatch]:
            for low in range(0, len(pairs), ROW_PAIRS):
                yield rows(block, [0], [0], [(None,) * 6], [pairs[low : low + ROW_PAIRS]], [counts[low : low + ROW_PAIRS]], True)

        for batch in batches:
            for part in row_slices(batch, "text", RUN_BYTES):
                a, b = _tokenized(first, second, part.column("text").to_pylist())
                (a_ids, a_ends, a_edges), (b_ids, b_ends, b_edges) = _ends(a, first.bytes), _ends(b, second.bytes)
                a_cuts, b_cuts = shared_cuts(a_ends, b_ends, a_edges, b_edges)
                left, right = overlaps(a_ends, b_ends, a_cuts, b_cuts)
                doc = np.searchsorted(a_edges, left, side="right") - 1
                space = len(first.bytes) * width
                cells, times = np.unique(doc * space + a_ids[left] * width + b_ids[right], return_counts=True)
                owner, cells = np.divmod(cells, space)
                # Small numbers suffice for counts: one that doesn't fit is split.
                several = -(-times // 32767)
                if (several > 1).any():
                    owner, cells, rest = np.repeat(owner, several), np.repeat(cells, several), np.repeat(times, several)
                    order = np.arange(len(rest)) - np.repeat(np.cumsum(several) - several, several)
                    times = np.minimum(rest - order * 32767, 32767)
                n_groups = np.diff(np.searchsorted(a_cuts, a_edges))
                n_links = np.bincount(doc, minlength=len(a))
                ids = part.column("id").to_pylist()
                upto = np.searchsorted(owner, np.arange(len(a) + 1)).tolist()
                number_, place, facts, mine, theirs = [], [], [], [], []
                for k, text in enumerate(_rendered(a_ids, b_ids, a_cuts, b_cuts, a_edges, b_edges)):
                    fact = (ids[k], len(a[k]), len(b[k]), int(n_groups[k]), int(n_links[k]), hashlib.sha256(text).hexdigest() if text else "")
                    for n, low in enumerate(range(upto[k], max(upto[k + 1], upto[k] + 1), ROW_PAIRS)):
                        high = min(low + ROW_PAIRS, upto[k + 1])
                        number_.append(row + k), place.append(n), facts.append(fact), mine.append(cells[low:high]), theirs.append(times[low:high])
                yield rows(block, number_, place, facts, mine, theirs, False)
                row += len(a)
                merged, inverse = np.unique(np.concatenate([pairs, cells]), return_inverse=True)
                counts = np.bincount(inverse, weights=np.concatenate([counts, times]), minlength=len(merged)).astype(np.int64)
                pairs, size = merged, size + int(a_ends[-1] if len(a_ends) else 0)
                if size >= BLOCK_BYTES:
                    yield from asked()
                    block, size, pairs, counts = block + 1, 0, pairs[:0], counts[:0]
            give_back()
        yield from asked()

    return run


RESULT = "id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _counted(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
    """The documents of one block with the totals of their pairs."""
    docs, answers = docs.combine_chunks(), answers.combine_chunks()
    known = answers.column("pair").to_numpy()
    order = np.argsort(known)
    known, total, best = known[order], answers.column("total").to_numpy()[order], answers.column("best").to_numpy(zero_copy_only=False)[order]
    lists = [c.chunk(0) if c.num_chunks else None for c in (docs.column("pairs"), docs.column("counts"))]
    pairs, times = lists[0].flatten().to_numpy(), lists[1].flatten().to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(docs.num_rows), np.diff(lists[0].offsets.to_numpy()))
    at = np.searchsorted(known, pairs)
    # Sums in whole numbers: of each row, and then of the rows of one document.
    rows, first, inverse = np.unique(docs.column("row").to_numpy(), return_index=True, return_inverse=True)
    n_best, count_sum = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
    if len(pairs):
        np.add.at(n_best, inverse[owner], times * best[at])
        np.add.at(count_sum, inverse[owner], times * total[at])
    out = docs.take(pa.array(first))
    facts = [out.column(n) for n in ("id", "n_a", "n_b", "n_groups", "n_links")]
    return pa.table([*facts, pa.array(n_best), pa.array(count_sum), out.column("groups_sha256")], names=[f.split()[0] for f in RESULT.split(", ")])


def align_tokenizers(docs: DataFrame, a_path: str, b_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """How the tokens of a byte-level BPE (A, of a blank and the text) and of a sentencepiece model (B, of the text) lie to
    each other: (id_column, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), one row per row of ``docs``.

    Groups lie between byte offsets at which tokens of both end. Every two tokens whose bytes overlap are a link; the count
    of an id pair is how many links of the corpus hold it. ``n_best``: links whose count is the highest of all pairs with
    their B id, ties included. ``count_sum``: the sum of the counts of all links. ``groups_sha256``: of ``a1,a2|b1;a3|b2``.

    Defined cases: special tokens' names in texts are plain text. A null or empty text, and one that the joined tokens of
    A or B don't give back byte by byte (B writes U+2581 and blank alike), has no tokens: zeros and an empty
    ``groups_sha256``. Null ids stay null; rows that repeat or share an id are a row each, and all count. An empty table
    gives an empty result. Other columns, whatever their names, play no part. Ids are integers. Both files must be readable
    on every executor and on the driver.
    """
    spark = docs.sparkSession
    ship(spark)
    a_size, b_size = len(_load(ByteTokens, a_path).bytes), len(_load(PieceTokens, b_path).bytes)
    kind = "int" if a_size * b_size < 1 << 31 else "long"
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    schema = f"{DOC}, pairs array<{kind}>, counts array<short>, totals array<long>, of_block boolean"
    blocks = saved(texts.mapInArrow(_align(a_path, b_path, kind), schema), "of_block")
    cells = blocks.where("of_block").select("block", F.inline(F.arrays_zip("pairs", "totals"))).withColumnsRenamed({"pairs": "pair", "totals": "n"})
    totals = saved(cells.groupBy("pair").agg(F.sum("n").alias("total")))
    b_id = F.pmod("pair", F.lit(b_size)).cast("int")
    top = totals.groupBy(b_id.alias("b")).agg(F.max("total").alias("top"))  # one row per id of B, however large the corpus
    judged = totals.withColumn("b", b_id).join(F.broadcast(top), "b").select("pair", "total", (F.col("total") == F.col("top")).alias("best"))
    answers = cells.select(F.col("block").alias("asker"), "pair").join(judged, "pair")
    found = blocks.where("not of_block and n_a > 0").drop("totals", "of_block")
    counted = found.groupBy("block").cogroup(answers.groupBy("asker")).applyInArrow(_counted, RESULT)
    zero = F.lit(0).cast("long")
    without = blocks.where("not of_block and n_a = 0").select("id", "n_a", "n_b", "n_groups", "n_links", zero.alias("n_best"), zero.alias("count_sum"), "groups_sha256")
    return counted.unionByName(without).withColumnRenamed("id", id_column)
