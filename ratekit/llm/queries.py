"""The registered ``opN_<name>`` queries and their SQL, derived from the operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, digest, htmltext, langid, lexical, licences, minhash, mixing, piece_bpe, quality, runs, toxicity, vectors
from .common import held_out, table


def op1_metric_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op2_toxicity_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted", "spans"
    )


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op4_bpe_prefixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_quality_attention(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select(
        "doc_id", held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted"
    )


def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = licences.document_files(table(spark, sf_dir, "documents"))
    return licences.scan(files).withColumnRenamed("id", "doc_id")


def op7_minmax_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op8_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op9_language_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs)
    return langid.classify(docs, model).select(
        "doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score", "rejected"
    )


def op10_quartile_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.edited_likeness(table(spark, sf_dir, "documents"))


def op11_pair_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.document_runs(table(spark, sf_dir, "documents"), planted=True)


def op13_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return piece_bpe.encode_documents(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_metric_range_join,
        op2_toxicity_crf,
        op3_source_mix,
        op4_bpe_prefixes,
        op5_quality_attention,
        op6_licence_scan,
        op7_minmax_hash,
        op8_html_blocks,
        op9_language_centroids,
        op10_quartile_digest,
        op11_pair_maxscore,
        op12_word_runs,
        op13_piece_bpe,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_metric_range_join": vectors.ORACLE_SQL,
        "op3_source_mix": mixing.ORACLE_SQL,
        "op7_minmax_hash": minhash.ORACLE_SQL,
        "op11_pair_maxscore": lexical.ORACLE_SQL,
    }
