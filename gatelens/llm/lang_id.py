"""Languages of documents as mixtures.

A language is a distribution over hashed letter trigrams, counted over all training texts. A document is a mixture of
languages: its words are drawn from one language each, and expectation-maximisation estimates the languages' shares from
the likelihoods of the words' trigrams. From all languages on, the one with the smallest share is left out as long as
the log-likelihood falls by less than a penalty, which grows with the logarithm of the number of words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatelens.llm.common import forget, row_slices, ship, text_bytes

BUCKETS = 1 << 16
#: Expectation-maximisation of a text ends when none of its shares changes by more in a round.
SETTLED = 1e-6
#: A word is at least so likely in any language, as a part of its likelihood in the language that explains it best.
TRACE = 1e-20
ADDED = 0.5
UNKNOWN = "und"
#: Bytes of text judged at once.
SLICE = 2 << 20

_MAP = np.zeros(256, np.uint8)  # bytes of letters, A-Z as a-z; all others are 0, the space between words
_MAP[97:123] = _MAP[65:91] = np.arange(97, 123)
_MAP[128:] = np.arange(128, 256)


def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket of the trigram around every letter; where words start among them; the edges of the texts in words."""
    data, edges = text_bytes(texts)
    low, high = int(edges[0]), int(edges[-1])
    letters = _MAP[data[low:high]]
    rows = len(edges) - 1
    if not len(letters):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(rows + 1, np.int64)
    left = np.zeros_like(letters)
    left[1:] = letters[:-1]
    right = np.zeros_like(letters)
    right[:-1] = letters[1:]
    filled = edges[:-1] < edges[1:]
    left[edges[:-1][filled] - low] = 0  # texts are apart
    right[edges[1:][filled] - 1 - low] = 0
    at = np.flatnonzero(letters)
    code = (left[at].astype(np.uint32) * np.uint32(0x01000193) ^ letters[at]) * np.uint32(0x01000193) ^ right[at]
    code *= np.uint32(0x9E3779B1)
    starts = np.flatnonzero(left[at] == 0)
    words = np.searchsorted(at[starts], edges - low)
    return (code >> np.uint32(16)).astype(np.int64), starts, words


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for part in row_slices(batch, "text", SLICE):
            codes, starts, words = _trigrams(part.column("text"))
            letters = np.append(starts, len(codes))[words]  # where each text starts among its letters
            of_text = part.column("lang").to_pylist()
            for lang in sorted(set(of_text)):
                mine = np.repeat(np.array([x == lang for x in of_text]), np.diff(letters))
                found = np.bincount(codes[mine], minlength=BUCKETS)
                totals[lang] = totals[lang] + found if lang in totals else found
    for lang, counts in totals.items():
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(seen), pa.string()), pa.array(seen), pa.array(counts[seen])], names=["lang", "bucket", "n"])


def train(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and the log-probability of each trigram bucket in each. All rows that have a text and a
    language count; what reaches the driver is one number per language and bucket."""
    ship(docs.sparkSession)
    labelled = docs.select(F.col(text_column).alias("text"), F.col(lang_column).cast("string").alias("lang")).where("text is not null and lang is not null")
    counts = labelled.mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = sorted(set(counts.column("lang").to_pylist()))
    table = np.full((len(langs), BUCKETS), ADDED)
    if langs:
        row = np.searchsorted(np.array(langs), np.array(counts.column("lang").to_pylist()))
        table[row, counts.column("bucket").to_numpy()] += counts.column("n").to_numpy()
    return langs, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def _fit(likelihood: np.ndarray, sizes: np.ndarray, shares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation for all texts, each until its shares have settled: shares (languages x texts) and
    log-likelihoods."""
    shares, unsettled, words, size = shares.astype(np.float32), np.arange(len(sizes)), likelihood, sizes
    while len(unsettled):
        before = shares[:, unsettled]
        joint = np.repeat(before, size, axis=1) * words
        joint /= joint.sum(axis=0)
        after = (np.add.reduceat(joint, np.cumsum(size) - size, axis=1, dtype=np.float64) / size).astype(np.float32)
        shares[:, unsettled] = after
        moving = np.abs(after - before).max(axis=0) > SETTLED
        if not moving.all():
            words, size, unsettled = words[:, np.repeat(moving, size)], size[moving], unsettled[moving]
    total = (np.repeat(shares, sizes, axis=1) * likelihood).sum(axis=0)
    return shares, np.add.reduceat(np.log(total).astype(np.float64), np.cumsum(sizes) - sizes)


def mixtures(words: np.ndarray, sizes: np.ndarray, penalty: float) -> np.ndarray:
    """Shares of the selected languages per text, 0 for the others.

    ``words`` are log-likelihoods (languages x words), ``sizes`` the words of each text, none of them 0.
    """
    langs = len(words)
    likelihood = np.maximum(np.exp(words - words.max(axis=0)), np.float32(TRACE))  # no sum is 0
    starts = np.cumsum(sizes) - sizes
    shares, fit = _fit(likelihood, sizes, np.full((langs, len(sizes)), 1 / langs))
    active = np.ones((langs, len(sizes)), bool)
    trying = np.arange(len(sizes))
    for _ in range(langs - 1):
        if not len(trying):
            break
        least = np.where(active[:, trying], shares[:, trying], 2).argmin(axis=0)
        fewer = np.where(active[:, trying], np.maximum(shares[:, trying], np.float32(1e-6)), np.float32(0))
        fewer[least, np.arange(len(trying))] = 0
        fewer /= fewer.sum(axis=0)
        size = sizes[trying]
        where = np.repeat(starts[trying] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        new_shares, new_fit = _fit(likelihood[:, where], size, fewer)
        gone = fit[trying] - new_fit < penalty * np.log(size + 1)
        done = trying[gone]
        shares[:, done], fit[done] = new_shares[:, gone], new_fit[gone]
        active[least[gone], done] = False
        trying = done
    return np.where(active, shares, 0)


def _judge(texts: pa.Array, lettered: np.ndarray, langs: list[str], table: np.ndarray, penalty: float) -> tuple[list[str], np.ndarray, list[list[dict]]]:
    """Predicted language, its share, and all selected languages of each text."""
    codes, starts, edges = _trigrams(texts)
    sizes = np.diff(edges)
    judged = lettered & (sizes > 0) & bool(langs)
    names, scores, found = [UNKNOWN] * len(sizes), np.zeros(len(sizes)), [[] for _ in sizes]
    if judged.any():
        words = np.stack([np.add.reduceat(t[codes], starts) for t in table])
        shares = mixtures(words[:, np.repeat(judged, sizes)], sizes[judged], penalty)
        best = shares.argmax(axis=0)
        for k, i in enumerate(np.flatnonzero(judged).tolist()):
            names[i], scores[i] = langs[best[k]], min(1.0, float(shares[best[k], k]))
            found[i] = [{"lang": langs[j], "share": float(shares[j, k])} for j in np.argsort(-shares[:, k], kind="stable").tolist() if shares[j, k] > 0]
    return names, scores, found


def _letters(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


_SHARES = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], id_column: str = "doc_id", text_column: str = "text", penalty: float = 5.0) -> DataFrame:
    """Languages per row: (id_column, lang_pred, score, languages).

    ``languages`` holds the selected languages and their shares of the words, largest first; ``lang_pred`` is the first,
    ``score`` its share. Of equal shares the language first by name leads.

    Defined cases: a text that is null, empty or without any letter, or a model without languages, gives ``und``, score
    0 and no languages. A null id stays null; repeated rows are judged each. An empty table gives an empty result. Other
    columns, whatever their names, play no part.
    """
    ship(docs.sparkSession)
    langs, table = model
    id_type = dict(docs.dtypes)[id_column]
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"), _letters(F.col(text_column)).alias("lettered"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for part in row_slices(batch, "text", SLICE):
                lettered = part.column("lettered").to_numpy(zero_copy_only=False).astype(bool)
                names, scores, found = _judge(part.column("text"), lettered, langs, table, penalty)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(names, pa.string()), pa.array(scores), pa.array(found, _SHARES)], names=["id", "lang_pred", "score", "languages"])

    out = rows.mapInArrow(run, f"id {id_type}, lang_pred string, score double, languages array<struct<lang:string,share:double>>")
    return out.withColumnRenamed("id", id_column)


def keep_identified(docs: DataFrame, model: tuple[list[str], np.ndarray], min_share: float = 0.4, text_column: str = "text", penalty: float = 5.0) -> DataFrame:
    """``docs`` without the rows whose language can't be told (``und``), or of which no language makes up ``min_share``
    of the words. All columns stay as they are; texts are not shuffled. Cases as in :func:`identify`."""
    ship(docs.sparkSession)
    langs, table = model
    at = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for part in row_slices(batch, f"c{at}", SLICE):
                lettered = part.column(part.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
                names, scores, _ = _judge(part.column(at), lettered, langs, table, penalty)
                keep = pa.array((np.array(names) != UNKNOWN) & (scores >= min_share))
                rows = part.filter(keep)
                yield pa.RecordBatch.from_arrays(rows.columns[:-1], names=batch.schema.names[:-1])

    # Columns go by their places; their names may hold dots.
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return plain.withColumn("lettered", _letters(F.col(f"c{at}"))).mapInArrow(run, plain.schema).toDF(*docs.columns)
