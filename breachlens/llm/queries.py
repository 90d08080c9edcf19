"""Registered queries of the operators on training text, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from breachlens.llm import bpe, decontamination, language, licenses, line_dedup, prefix_trie, quality, quality_classifier, secret_scan, simhash, suffix_dedup, token_files, vector_codes
from breachlens.llm.common import ship_package, utf8
from breachlens.llm.sql import ORACLE_SQL
from breachlens.sources import new_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contaminated_documents(
        spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    network = language.train(docs, ~held_out)
    found = language.predict(utf8("text"), network).alias("found")
    return docs.select("doc_id", held_out.alias("held_out"), found).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score")
    )


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    path = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_token_files(_table(spark, sf_dir, "documents"), folder, path)
    read = token_files.read_token_files(spark, folder).select(
        "part", "start", "doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )
    placed = read.join(token_files.part_starts(spark, folder), "part")
    return placed.select("doc_id", (F.col("part_start") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = _table(spark, sf_dir, "documents").select("doc_id", bpe.encode_and_decode(utf8("text"), path).alias("coded"))
    return coded.select("doc_id", "coded.*").select(
        "doc_id", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(spark, _table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality.quality_ledger(_table(spark, sf_dir, "documents"))
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.passes("failed", "base")).alias("base_failed"),
        quality.passes("failed", "v1").alias("kept"),
        "failed",
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(spark, _table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id", "text", (F.length(text) - F.length(F.replace(text, F.lit("\n"), F.lit(""))) + 1).cast("bigint").alias("n_lines")
    )
    kept = line_dedup.drop_repeated_lines(spark, docs, new_folder(spark, "lines"), n_dropped="n_dropped")
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan_secrets(_table(spark, sf_dir, "documents"), path_col="source")
    return found.select("doc_id", "finding", "kind", "start", "stop", F.sha2("value", 256).alias("value_sha256"), "score", "is_secret")


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = quality_classifier.train(spark, docs, labels, ~held_out)
    score = quality_classifier.score(utf8("text"), model)
    scored = docs.select("doc_id", held_out.alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(spark, _table(spark, sf_dir, "conversations"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.code_vectors(spark, _table(spark, sf_dir, "embeddings"))
    return vector_codes.with_label_error(coded.rows).select(
        "vec_id", "code", "error", "label_error", F.lit(coded.codebooks_sha256()).alias("codebooks_sha256")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": op1_decontamination, "op2_language": op2_language, "op3_licenses": op3_licenses, "op4_token_files": op4_token_files, "op5_bpe": op5_bpe, "op6_suffix_dedup": op6_suffix_dedup, "op7_quality": op7_quality, "op8_simhash": op8_simhash, "op9_line_dedup": op9_line_dedup,
        "op10_secrets": op10_secrets, "op11_quality_classifier": op11_quality_classifier, "op12_prefix_trie": op12_prefix_trie, "op13_vector_codes": op13_vector_codes,
    }


def oracle_sql() -> dict[str, str]:
    return ORACLE_SQL
