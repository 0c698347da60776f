"""Ranked lexical search by dense blocked matrix products.

The queries are a stated set of items. Their distinct terms are the vocabulary; all other terms of the corpus only count
towards lengths. One pass over the texts gives every document its length and how often it holds each term of the
vocabulary. With the corpus counts (documents, terms, documents per term) known, documents become tiles: a dense matrix of
the impacts of the vocabulary's terms on some thousand documents, multiplied by the dense matrix of the items' weights.

All numbers are whole. A product is done in float64 over at most ``TERMS`` terms at a time: weights stay below
1000 ln(2^63) < 44,000 and impacts below 10^6, so a partial sum stays below 4096 * 44,000 * 10^6 < 2^53 and is exact; tiles
of the vocabulary are added up as 64-bit integers. Each task keeps the best of each item, equal scores by id, and the best
of all tasks are ranked by Spark.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatelens.llm.common import row_slices, saved, ship, span_hashes, text_bytes, word_spans

#: Documents and terms of a tile.
DOCUMENTS, TERMS = 2048, 4096
#: Items, and distinct terms of items, that one pass over the corpus answers; more items take more passes. A pass holds
#: the weights of its items as a sparse list and sends 8 bytes per term to the tasks.
ITEMS, VOCABULARY = 2048, 1 << 18
#: Candidates of an item are ranked in this many parts before they meet.
PARTS = 64

#: Bytes between terms: all ASCII but digits and letters.
_BREAKS = np.zeros(256, dtype=bool)
_BREAKS[:128] = [not chr(i).isalnum() for i in range(128)]


def term_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all terms of the texts in order, A-Z as a-z, and the edges of the rows in them."""
    data, edges = text_bytes(texts)
    starts, ends, counts = word_spans(data, edges, _BREAKS)
    return span_hashes(data, starts, ends), np.concatenate([[0], np.cumsum(counts)])


def term_weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def _vectors(vocabulary: np.ndarray):
    """Length of each document and its terms of the vocabulary (places in the sorted hashes) with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in row_slices(batch, "text"):
                hashes, edges = term_hashes(part.column("text"))
                at = np.minimum(np.searchsorted(vocabulary, hashes), max(len(vocabulary) - 1, 0))
                known = np.flatnonzero(vocabulary[at] == hashes) if len(vocabulary) else np.zeros(0, np.int64)
                rows = np.searchsorted(edges, known, side="right") - 1
                cells, counts = np.unique(rows * (len(vocabulary) + 1) + at[known], return_counts=True)
                rows, terms = np.divmod(cells, len(vocabulary) + 1)
                offsets = pa.array(np.searchsorted(rows, np.arange(part.num_rows + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (terms, counts)]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(edges)), *lists], names=["id", "n", "terms", "counts"])

    return run


class _Best:
    """The ``k`` best documents of each item so far: highest scores first, equal ones by id, rows without an id last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.scores = [np.zeros(0, np.int64)] * items
        self.ids = [np.zeros(0, np.int64)] * items
        self.without = [np.zeros(0, bool)] * items
        self.least = np.ones(items, np.int64)  # a score has to reach this

    def add(self, scores: np.ndarray, ids: np.ndarray, without: np.ndarray) -> None:
        """Takes a tile of scores, items by documents."""
        if scores.shape[1] > self.k:  # what a tile's own k-th best beats can't be among the k best
            own = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, scores.shape[1] - self.k]
            floor = np.maximum(self.least, own)
        else:
            floor = self.least
        for i in np.flatnonzero((scores >= floor[:, None]).any(axis=1)):
            at = np.flatnonzero(scores[i] >= floor[i])  # all that tie with the k-th best are among them
            s, d, w = np.concatenate([self.scores[i], scores[i][at]]), np.concatenate([self.ids[i], ids[at]]), np.concatenate([self.without[i], without[at]])
            order = np.lexsort((d, w, -s))[: self.k]
            self.scores[i], self.ids[i], self.without[i] = s[order], d[order], w[order]
            if len(order) == self.k:
                self.least[i] = max(1, int(s[order][-1]))

    def batch(self) -> pa.RecordBatch:
        sizes = [len(s) for s in self.scores]
        item = np.repeat(np.arange(len(sizes)), sizes)
        ids = pa.array(np.concatenate([*self.ids, np.zeros(0, np.int64)]), mask=np.concatenate([*self.without, np.zeros(0, bool)]))
        return pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), ids, pa.array(np.concatenate([*self.scores, np.zeros(0, np.int64)]))], names=["item", "id", "score"])


def _score(item_of: np.ndarray, term_of: np.ndarray, weight_of: np.ndarray, items: int, terms: int, documents: int, total: int, k: int):
    """Scores tiles of documents for all items; (item_of, term_of, weight_of) are the cells of the weights."""

    def tile(rows: list[pa.RecordBatch]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        table = pa.Table.from_batches(rows).combine_chunks()
        size = table.num_rows
        column = table.column("id").chunk(0)
        n = table.column("n").to_numpy()
        lists = [table.column(c).chunk(0) for c in ("terms", "counts")]
        held, times = (x.flatten().to_numpy() for x in lists)
        row = np.repeat(np.arange(size), np.diff(lists[0].offsets.to_numpy()))
        m = 10 + 90 * n * documents // total
        times = times.astype(np.int64)
        impact = 1_000_000_000 * times // (1000 * times + 8 * m[row])
        present = np.flatnonzero(np.bincount(held, minlength=terms))  # the tile's own terms: its vocabulary, compact
        place = np.full(terms, -1, np.int64)
        place[present] = np.arange(len(present))
        scores = np.zeros((items, size), np.int64)
        at, own = place[held], place[term_of]
        for low in range(0, len(present), TERMS):
            width = min(TERMS, len(present) - low)
            mine, theirs = (own >= low) & (own < low + width), (at >= low) & (at < low + width)
            weights = np.zeros((items, width))
            weights[item_of[mine], own[mine] - low] = weight_of[mine]
            impacts = np.zeros((width, size))
            impacts[at[theirs] - low, row[theirs]] = impact[theirs]
            scores += (weights @ impacts).astype(np.int64)
        return scores, column.fill_null(0).to_numpy(), column.is_null().to_numpy(zero_copy_only=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, rows, held = _Best(items, k), [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, DOCUMENTS):
                part = batch.slice(start, DOCUMENTS)
                if held + part.num_rows > DOCUMENTS:
                    best.add(*tile(rows))
                    rows, held = [], 0
                rows.append(part)
                held += part.num_rows
        if rows:
            best.add(*tile(rows))
        yield best.batch()

    return run


def item_blocks(items: DataFrame) -> Iterator[tuple[list, list[np.ndarray]]]:
    """The items in blocks (ids, distinct term hashes): read one partition at a time, so the driver holds one block."""
    ids, terms, size = [], [], 0
    for row in items.toLocalIterator():
        found = np.unique(term_hashes(pa.array([row["text"]], pa.string()))[0])
        if ids and (len(ids) == ITEMS or size + len(found) > VOCABULARY):
            yield ids, terms
            ids, terms, size = [], [], 0
        ids.append(row["id"])
        terms.append(found)
        size += len(found)
    if ids:
        yield ids, terms


def _answer(docs: DataFrame, ids: list, terms: list[np.ndarray], k: int) -> DataFrame:
    """The best documents of one block of items."""
    spark = docs.sparkSession
    vocabulary = np.unique(np.concatenate(terms))
    vectors = saved(docs.mapInArrow(_vectors(vocabulary), "id long, n long, terms array<int>, counts array<int>"))
    counted = vectors.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    documents, total = counted["documents"], max(1, counted["terms"])
    holding = np.zeros(len(vocabulary), np.int64)
    for row in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).collect():  # at most one row per term of the block
        holding[row["term"]] = row["n"]
    weights = np.array([term_weight(documents, int(n)) for n in holding], np.int64)
    item_of = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    term_of = np.searchsorted(vocabulary, np.concatenate(terms))
    run = _score(item_of, term_of, weights[term_of], len(terms), len(vocabulary), documents, total, k)
    found = vectors.where("n > 0").mapInArrow(run, "item long, id long, score long")
    order = [F.desc("score"), F.col("id").asc_nulls_last()]
    part = F.pmod(F.spark_partition_id(), F.lit(PARTS))
    near = found.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).where(F.col("place") <= k)
    ranked = near.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, None if x is None else int(x)) for i, x in enumerate(ids)], "item long, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id", item_text_column: str = "text") -> DataFrame:
    """The ``k`` highest-scoring documents of each item: (item_column, rank, id_column, score), scores above 0 only.

    Terms are the longest runs of ASCII digits, letters and code points above 127; A-Z lower-cased. With N documents that
    have a term, L terms in all, n terms in the document, tf occurrences of a term in it and df documents holding the
    term, the weight is floor(1000 ln((2N + 2) / (2 df + 1))) and the score the sum over the item's distinct terms of
    weight * (10^9 tf div (1000 tf + 8 m)), m = 10 + (90 n N) div L. Ranks count from 1; equal scores come by ascending id.

    Defined cases: a null, empty or term-less text of a document has no score, one of an item no result. Every row is a
    document, or an item, of its own, so rows that repeat are ranked each and repeated items answered each; among equal
    scores null ids come last. Empty tables give an empty result. Other columns, whatever their names, play no part. Ids
    are integers.
    """
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    items = items.select(F.col(item_column).cast("long").alias("id"), F.col(item_text_column).alias("text"))
    result = spark.createDataFrame([], "item_id long, rank int, id long, score long")
    for ids, terms in item_blocks(items):
        if any(len(t) for t in terms):
            result = result.unionByName(_answer(docs, ids, terms, k))
    return result.select(F.col("item_id").alias(item_column), "rank", F.col("id").alias(id_column), "score")
