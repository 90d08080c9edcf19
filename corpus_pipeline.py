"""From raw documents to token ids: quality rules, line dedup, near-dedup, decontamination, encoding.

Each stage takes the documents that the one before it kept, and all but the last return
documents with the same columns. Between stages the documents are Parquet in the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breachlens.llm import bpe, decontamination, line_dedup, quality, simhash
from breachlens.llm.common import ship_package, utf8
from breachlens.sources import new_folder
from breachlens.sources.layers import write_layer

QUALITY_POLICY = "v1"
RANKS = "byte_bpe_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality policy."""
    ship_package(spark)
    return quality.keep_quality(docs, QUALITY_POLICY)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that one with a smaller id holds; ``n_chars`` follows the text."""
    ship_package(spark)
    kept = line_dedup.drop_repeated_lines(spark, docs, new_folder(spark, "lines"))
    if "n_chars" in kept.columns:
        kept = kept.withColumn("n_chars", F.coalesce(F.length("text").cast(kept.schema["n_chars"].dataType), "n_chars"))
    return kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates."""
    ship_package(spark)
    return simhash.keep_one_row_of_each(spark, docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no substantial part of a benchmark item."""
    ship_package(spark)
    return decontamination.drop_contaminated_rows(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian, 32 bits) of each document, with their number and digest."""
    ship_package(spark)
    ids = bpe.encode(utf8("text"), public_tokenizers.path(RANKS))
    coded = docs.select("doc_id", "lang", "source", ids.alias("ids"))
    return coded.select(
        "doc_id", "lang", "source", (F.length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), "ids",
    )


#: Operators 7, 9, 8, 1 and 5.
STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_lines),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("byte-level bpe", encode),
]

#: Fingerprints and merges can't be written in SQL; the tests hold the result against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of a folder."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), new_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        docs = write_layer(stage(spark, docs, sf_dir), f"{folder}/{number}")
    return docs
