"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatelens.llm.decontaminate import contaminated
from gatelens.llm.lang_id import identify, train
from gatelens.llm.lexical_search import ranked_search
from gatelens.llm.licenses import scan_licenses
from gatelens.llm.line_dedup import dedup_lines
from gatelens.llm.lm_score import score
from gatelens.llm.near_dedup import near_duplicates
from gatelens.llm.packing import pack
from gatelens.llm.secrets import find_secrets
from gatelens.llm.simhash_dedup import simhash_duplicates
from gatelens.llm.token_alignment import align_tokenizers
from gatelens.llm.topk_search import top_k
from gatelens.llm.url_filter import judge_urls

#: Where the public vocabularies lie; a parameter of the queries that tokenize.
TOKENIZERS = os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers")
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(table(spark, sf_dir, "pages"), rules)


@query
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, threshold=0.8)


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that hold benchmark items, and the items."""
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "matched", "windows", "kind")


@query
def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


@query
def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


@query
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("findings", lambda f: f["alone"])
    joined = lambda spans: F.array_join(F.transform(spans, lambda f: F.concat_ws(":", f["name"], f["start"].cast("string"), f["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("findings", lambda f: f["name"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("findings")).alias("spans"))


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id``, so that sources and languages are the directories."""
    path = F.concat_ws("/", F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), F.col("doc_id").cast("string"))
    files = table(spark, sf_dir, "documents").select("doc_id", "text", path.alias("path"))
    return scan_licenses(files, "path")


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json", capacity=2048, end_id=0)


def held_out_language(docs: DataFrame) -> DataFrame:
    """Rows that the language model must not learn from: the crc32 of the id as text leaves 2 on division by 4."""
    return docs.withColumn("held_out", F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2)


@query
def op10_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = held_out_language(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    found = identify(docs, train(docs.where("not held_out")))
    return held_out_language(found).select("doc_id", "held_out", "lang_pred", "score")


@query
def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(table(spark, sf_dir, "documents"), words=4, distance=4)


@query
def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokenizers(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")
