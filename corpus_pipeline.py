"""From raw documents to packed training sequences, in five stages.

Each stage is a function of (spark, docs, sf_dir) that works on all documents
its predecessor kept; its result is written as Parquet and read again as the
next stage's documents. All but the last return the columns of documents.

Defined cases: a document without letters is rejected by the first stage, so
a null or empty text ends there; rows that repeat an id are documents of
their own; among similar documents the one of the smallest id stays (null
ids last, then the first row); an empty table gives no sequences."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from listenlab.llm import jaccard_join, langid, mixing, packing, secrets_scan
from listenlab.llm.shared import keep

TOKENIZER = "word_bpe_49k.json"
#: Words of a shingle, and the similarity from which documents are near duplicates.
GRAM, SIMILARITY = 5, (4, 5)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the models recognise."""
    return langid.fit(docs).recognised(docs)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similarity links."""
    # the documents are a written table, whose rows are numbered alike at every reading
    numbered = docs.withColumn("row_number", F.monotonically_increasing_id())
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("row_number").alias("row"))
    found = jaccard_join.similar_components(numbered.select(place.alias("doc_id"), "text"), gram=GRAM, similarity=SIMILARITY)
    others = keep(found.where("component_id.row <> doc_id.row").select(F.col("doc_id.row").alias("row_number")), "similar")
    return numbered.join(others, "row_number", "left_anti").select(*docs.columns)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, live-looking credentials replaced by a mark."""
    return secrets_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.emit(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset per piece."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("ngram_jaccard", one_of_similar),
    ("secret_scan", secrets),
    ("mixing", mix),
    ("packing", pack),
]

#: The tokenizer and the language models have no SQL: tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
