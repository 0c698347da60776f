"""Exact top-k inner products, with bounds from segment statistics from coarse to fine.

A vector's segment is known by its mean and its deviation from it. For two vectors the products of the means and of the
deviations, summed over segments, are never below the inner product (the deviations meet at best in parallel): the mirror
image of a lower bound of the distance. Both together are an inner product of short vectors, so a block of queries meets a
block of rows in one small matrix product per resolution. Pairs whose bound is below the query's k-th best score so far
are settled; the next finer resolution looks at the rest, and survivors are computed exactly.

Queries are dealt in blocks of bounded size, rows in parts; each task holds one block of queries and streams one part of
the rows, and hands on k rows per query. Nothing is broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gatelens.llm.common import saved, ship

#: Queries that a task holds, rows of a part at most about, pairs of a matrix.
QUERY_BLOCK, PART_ROWS, PAIRS = 8192, 65536, 1 << 22
#: Segments of the resolutions.
SEGMENTS = (4, 16)
_EXACT = float(1 << 53)


def _statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per row the segments' means, times the root of the segment's length, and their deviations."""
    length = -(-x.shape[1] // segments)
    padded = np.pad(x, ((0, 0), (0, length * segments - x.shape[1]))).reshape(len(x), segments, length)
    means = padded.mean(axis=2)
    deviations = np.sqrt(((padded - means[:, :, None]) ** 2).sum(axis=2))
    return np.concatenate([means * np.sqrt(length), deviations], axis=1)


def _products(q: np.ndarray, x: np.ndarray, at: np.ndarray, to: np.ndarray) -> np.ndarray:
    """q[at] . x[to] for pairs, by one matrix product where pairs are dense."""
    if len(at) * 8 > len(q) * len(x):
        return (q @ x.T)[at, to]
    out = np.empty(len(at))
    for i in range(0, len(at), 1 << 16):
        out[i : i + (1 << 16)] = np.einsum("ij,ij->i", q[at[i : i + (1 << 16)]], x[to[i : i + (1 << 16)]])
    return out


def _exact(q: np.ndarray, x: np.ndarray, at: np.ndarray, to: np.ndarray, norms: float) -> np.ndarray:
    """Integer scores. Sums below 2^53 are exact as doubles; larger ones are taken as whole numbers, and end at 64 bits."""
    if norms < _EXACT:
        return _products(q, x, at, to).astype(np.int64)
    top = (1 << 63) - 1
    whole = (sum(int(a) * int(b) for a, b in zip(q[i], x[j], strict=True)) for i, j in zip(at, to, strict=True))
    return np.array([max(-top, min(top, s)) for s in whole], np.int64)


class _Best:
    """The k best rows so far of each query of a block."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.rows, self.ids, self.vectors, self.k = rows, ids, vectors, k
        self.levels = [_statistics(vectors, s) for s in SEGMENTS if s < vectors.shape[1]]
        self.norms = np.linalg.norm(vectors, axis=1)
        self.floor = np.full(len(rows), -np.inf)  # the k-th best score
        self.query = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.found = np.zeros(0, np.int64)

    def meet(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        norms = np.linalg.norm(vectors, axis=1)
        slack = 0.5 + 1e-9 * self.norms.max() * norms.max()  # scores are whole; products are rounded
        at, to = np.nonzero(self.rows[:, None] != rows[None, :])
        for own in self.levels:
            bound = _products(own, _statistics(vectors, own.shape[1] // 2), at, to)
            alive = bound >= self.floor[at] - slack
            at, to = at[alive], to[alive]
        score = _exact(self.vectors, vectors, at, to, float(self.norms.max() * norms.max()))
        better = score >= self.floor[at]
        query = np.concatenate([self.query, at[better]])
        score = np.concatenate([self.score, score[better]])
        found = np.concatenate([self.found, ids[to[better]]])
        order = np.lexsort((found, -score, query))
        query, score, found = query[order], score[order], found[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        keep = rank < self.k
        last = rank == self.k - 1
        self.floor[query[last]] = score[last]
        self.query, self.score, self.found = query[keep], score[keep], found[keep]

    def result(self) -> pa.RecordBatch:
        columns = [self.rows[self.query], self.ids[self.query], self.found, self.score]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_row", "query_id", "vec_id", "score"])


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, queries, best = None, [], None

        def block() -> _Best | None:
            return _Best(*(np.concatenate([p[i] for p in queries]) for i in range(3)), k) if queries else None

        for batch in batches:
            keys = np.stack([batch.column(n).to_numpy().astype(np.int64) for n in ("dim", "block", "part", "is_row")], axis=1)
            edges = np.concatenate([[0], np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, [len(keys)]])
            for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                if low == high:
                    continue
                dim, number, part, is_row = keys[low].tolist()
                if (dim, number, part) != group:
                    if best:
                        yield best.result()
                    group, queries, best = (dim, number, part), [], None
                some = batch.slice(low, high - low)
                rows, ids = some.column("row").to_numpy(), some.column("id").to_numpy()
                vectors = some.column("vector").flatten().to_numpy().reshape(len(rows), dim)
                if not is_row:
                    queries.append((rows, ids, vectors))
                    continue
                best = best or block()
                if best:
                    step = max(1, PAIRS // len(best.rows))
                    for i in range(0, len(rows), step):
                        best.meet(rows[i : i + step], ids[i : i + step], vectors[i : i + step])
        if best:
            yield best.result()

    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: float = 256.0, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """The k rows with the highest inner product for each row whose id is divisible by ``every``: (query_id, rank,
    vec_id, score), ranks from 1, ties to the smaller id; all other rows if they are fewer than k.

    Components count as whole numbers ``floor(scale * x)``. A row is no candidate of itself.

    Defined cases: vectors that are null, empty or hold null or non-finite components (also after scaling), and null ids,
    take no part. Vectors are compared with those of their length. Rows that repeat or share an id are different rows:
    queries each, and candidates of each other. Scores beyond 64 bits end there. An empty table gives an empty result.
    Other columns, whatever their names, play no part. Ids are integers.
    """
    spark = vectors.sparkSession
    ship(spark)
    scaled = F.transform(vector_column, lambda x: x.cast("double") * scale)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    whole = vectors.select(F.col(id_column).cast("long").alias("id"), scaled.alias("scaled")).where((F.size("scaled") > 0) & F.col("id").isNotNull() & F.forall("scaled", finite))
    # floor() of a double is a long; what doesn't fit one stays as it is, for it has no fraction.
    floored = F.transform("scaled", lambda x: F.when(F.abs(x) < _EXACT, F.floor(x).cast("double")).otherwise(x))
    rows = saved(whole.select(F.monotonically_increasing_id().alias("row"), "id", floored.alias("vector"), F.size("scaled").alias("dim")))
    is_query = F.col("id") % every == 0
    total, queries = rows.agg(F.count("*"), F.count_if(is_query)).first()
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = max(1, -(-queries // QUERY_BLOCK))
    parts = max(1, -(-total // PART_ROWS), -(-shuffles // blocks))
    of = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every_one = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = rows.where(is_query).withColumns({"block": of(blocks), "is_row": F.lit(0)}).withColumn("part", every_one(parts))
    offered = rows.withColumns({"part": of(parts), "is_row": F.lit(1)}).withColumn("block", every_one(blocks))
    dealt = (
        asked.unionByName(offered).select("dim", "block", "part", "is_row", "row", "id", "vector")
        .repartition(blocks * parts, "dim", "block", "part").sortWithinPartitions("dim", "block", "part", "is_row")
    )
    found = dealt.mapInArrow(_search(k), "query_row long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
