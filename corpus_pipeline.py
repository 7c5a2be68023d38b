"""Corpus pipeline over ``documents``: each stage applies one operator of ``ratekit.llm``.

A stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and
fits its own model on them; all but the last return the columns of ``documents``.
Null ids are documents of their own, extra columns of any name pass through, and empty tables
give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratekit.llm import bpe, langid, minhash, mixing, quality
from ratekit.llm.common import free_prefix, numbered_copy, plain_rows, table
from ratekit.session import scratch_path

# Classifiers, min-hash groups and token ids have no SQL form; tests/llm compare
# the run with a brute-force version.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; the model learns from ``docs`` itself."""
    prefix = free_prefix(docs.columns, "_lang_", ("lang_pred", "score", "rejected"))
    judged = langid.annotate(docs, langid.fit(docs), prefix=prefix)
    return judged.filter(~F.col(f"{prefix}rejected")).select(docs.columns)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts as 1."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    prefix = free_prefix(docs.columns, "_quality_", ("score", "predicted"))
    return quality.annotate(docs, model, prefix=prefix).filter(F.col(f"{prefix}predicted") == 1).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates (null last, then the first row).

    Every row is a document, whatever its id: of repeated rows and of copies without an id one stays.
    """
    rows = numbered_copy(docs)
    groups = minhash.near_duplicates(rows.select(F.col("row").alias("doc_id"), "doc.text"), width=5, percent=80)
    groups = groups.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", "doc.doc_id"), "row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))["row"]
    stays = groups.groupBy("component_id").agg(first.alias("row")).select("row")
    return plain_rows(rows.join(stays, "row", "left_semi"), docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as the source mix takes them."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix, with their hashes."""
    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=True)


STAGES = [
    ("language", language),
    ("quality", quality_filter),
    ("near_duplicates", near_duplicates),
    ("mix", mix),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
