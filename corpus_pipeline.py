"""A corpus made ready for training: languages, repeated lines, near-duplicates, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its result is written as Parquet
and read again as the next one's ``docs``. All stages but the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatelens.llm.common import saved
from gatelens.llm.decontaminate import without_contaminated
from gatelens.llm.lang_id import keep_identified, train
from gatelens.llm.line_dedup import dedup_lines
from gatelens.llm.near_dedup import near_duplicates
from gatelens.llm.packing import pack
from gatelens.llm.queries import TOKENIZERS, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters, and those in which no language makes up two fifths of the words."""
    return keep_identified(docs, train(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes lines that several documents share out of all but one. Every document stays, if only as an empty text."""
    out = dedup_lines(docs, counts=False)
    return out.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near-duplicates: that with the smallest id, or one without an id if none has any."""
    key = "_row"
    while key in docs.columns:
        key += "_"
    rows = saved(docs.withColumn(key, F.monotonically_increasing_id()))
    groups = near_duplicates(rows, id_column=key).select(key, "component_id").join(rows.select(key, F.col("doc_id").alias("_id")), key)
    first = F.min(F.struct(F.col("_id").isNull().alias("without"), "_id", key)).getField(key)
    kept = groups.groupBy("component_id").agg(first.alias(key)).select(key)
    return rows.join(kept, key, "left_semi").select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold benchmark items."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' tokens in sequences of 2048."""
    return pack(docs, f"{TOKENIZERS}/word_bpe_49k.json", capacity=2048, end_id=0)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: SQL can't express the language mixture or the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
