"""A training-data pipeline over ``documents``: each stage is written as Parquet and read by the next.

Every stage takes nulls in any column, empty and very long texts and rows that share a doc_id, ignores columns that are
not those of ``documents``, and gives an empty table for an empty one. What each case means is said at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemart.llm.bpe import decode_documents, encode_documents
from lakemart.llm.decontaminate import clean_documents
from lakemart.llm.jaccard_join import jaccard_groups
from lakemart.llm.language_id import accepted, is_held_out, learn
from lakemart.llm.line_dedup import dedup_lines
from lakemart.llm.queries import TOKENIZER
from lakemart.llm.tables import Scratch
from lakemart.llm.workers import small_batches
from lakemart.session import scratch_scope

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told apart clearly enough; lang is not changed.

    Texts that are null, empty or without a letter go. Rows are judged each on its own, also those without doc_id and
    repeated ones; equal texts are judged alike.
    """
    small_batches(spark)
    docs = docs.select(*COLUMNS)
    return accepted(docs, learn(spark, docs.where(~is_held_out(F.col("doc_id")))))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated chunks of lines; documents of which nothing is left go.

    Null texts have no lines and stay as they are; so do empty ones, of which nothing is removed. Rows without doc_id have
    no rank: they stay whole. n_chars is counted anew where a text changed.
    """
    kept = dedup_lines(spark, docs, carry=("lang", "source", "n_chars"), paired=True).where(
        "size(removed) = 0 or length(text) > 0"
    )
    changed = F.size("removed") > 0
    length = F.length("text").cast("long")
    return kept.withColumn("n_chars", F.when(changed, length).otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies: the one of the smallest doc_id.

    Null and empty texts are no copies of each other, and rows without doc_id belong to no group: they stay. Rows that
    share a doc_id stay or go together.
    """
    small_batches(spark)
    scratch = Scratch(spark, "near-copies")
    copies = jaccard_groups(spark, docs).where("doc_id <> component_id").select("doc_id")
    return scratch.join_small(docs, scratch.write(copies, "copies"), "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    Null and empty texts hold none; an empty benchmark removes nothing. Rows are judged each on its own.
    """
    small_batches(spark)
    return clean_documents(spark, docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of the ids and of the text decoded from them.

    Null and empty texts have no ids; every row gives one row, also without doc_id.
    """
    small_batches(spark)
    # Written in between: else every task has two workers, each with its own vocabulary.
    ids = Scratch(spark, "encoding").write(encode_documents(spark, docs, TOKENIZER), "ids", compression="zstd")
    return decode_documents(ids, TOKENIZER).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: Language identification by compression has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        # A stage's own tables go once its result is written.
        with scratch_scope(spark):
            docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
