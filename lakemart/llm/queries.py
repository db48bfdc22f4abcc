"""The registered queries of the subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemart.llm.bpe import decode_documents, encode_documents
from lakemart.llm.decontaminate import find_leaks
from lakemart.llm.embedding_dedup import embedding_groups
from lakemart.llm.entropy_mix import mix_sources
from lakemart.llm.filter_audit import audit_filters
from lakemart.llm.jaccard_join import jaccard_groups
from lakemart.llm.language_id import identify_languages, is_held_out, learn
from lakemart.llm.license_scan import known_licenses, scan_licenses
from lakemart.llm.line_dedup import dedup_lines
from lakemart.llm.substring_dedup import MIN_WITHIN, dedup_units
from lakemart.llm.suffix_dedup import dedup_substrings
from lakemart.llm.token_files import read_token_files, write_token_files
from lakemart.llm.vector_codes import code_report
from lakemart.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(spark, _read(spark, sf_dir, "embeddings"))


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(spark, _read(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_substrings(spark, _read(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(_read(spark, sf_dir, "documents"), known_licenses(spark))
    return found.withColumn("notices", F.array_join("notices", ","))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    kept = dedup_units(spark, documents, "line", within=[("sentence", MIN_WITHIN)])
    cut = F.coalesce("removed", F.array().cast("array<struct<start: long, end: long>>"))
    return kept.select(
        "doc_id",
        F.size(cut).cast("long").alias("n_removed"),
        F.array_join(F.transform(cut, lambda s: F.concat_ws("-", s["start"], s["end"])), ",").alias("removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(spark, _read(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id",
        F.col("n_chunks").cast("long").alias("n_chunks"),
        F.array_join("removed", ",").alias("removed"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _read(spark, sf_dir, "documents")
    dictionaries = learn(spark, documents.where(~is_held_out(F.col("doc_id"))))
    found = identify_languages(documents, dictionaries)
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(spark, _read(spark, sf_dir, "documents"), TOKENIZER)
    return decode_documents(encoded, TOKENIZER).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_leaks(spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        (F.size("item_ids") > 0).alias("contaminated"),
        F.array_join("item_ids", ",").alias("item_ids"),
        "overlap",
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    write_token_files(spark, _read(spark, sf_dir, "documents"), TOKENIZER, folder)
    return read_token_files(spark, folder).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_report(spark, _read(spark, sf_dir, "embeddings"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(spark, _read(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


REGISTRY: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_embedding_dedup,
        op2_ngram_jaccard_join,
        op3_suffix_dedup,
        op4_license_scan,
        op5_substring_dedup,
        op6_line_dedup,
        op7_language_id,
        op8_bpe,
        op9_decontamination,
        op10_token_files,
        op11_vector_codes,
        op12_source_mix,
        op13_filter_audit,
    )
}
