"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    byte_bpe,
    decontaminate,
    html_blocks,
    kd_search,
    lattice_lm,
    line_dedup,
    minhash_dedup,
    ngram_join,
    phrases,
    quality_knn,
    token_counts,
    variants,
    warc,
)
from .common import scratch_path
from .similar_sql import similar_sql


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(_documents(spark, sf_dir), n=3, threshold=0.9)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


def op3_html_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_blocks.extract(_pages(spark, sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(_documents(spark, sf_dir)).select("doc_id", "text", "n_removed")


def op5_lattice_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_lm.lm_scores(_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op6_quality_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    scored = quality_knn.quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", quality_knn.held_out("doc_id").alias("held_out"), "score", "predicted")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(_documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(_pages(spark, sf_dir), path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op9_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_search.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    found = decontaminate.find_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op11_phrase_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(_documents(spark, sf_dir))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(_documents(spark, sf_dir))


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.minhash_dedup(_documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_token_counts": op2_token_counts,
    "op3_html_blocks": op3_html_blocks,
    "op4_line_dedup": op4_line_dedup,
    "op5_lattice_lm": op5_lattice_lm,
    "op6_quality_knn": op6_quality_knn,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_warc": op8_warc,
    "op9_kd_search": op9_kd_search,
    "op10_decontaminate": op10_decontaminate,
    "op11_phrase_graph": op11_phrase_graph,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_minhash_dedup": op13_minhash_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": similar_sql(3, 90, "coalesce(o.n, 0) AS n_links"),
    "op4_line_dedup": line_dedup.ORACLE,
    "op9_kd_search": kd_search.ORACLE,
    "op11_phrase_graph": phrases.ORACLE,
    "op13_minhash_dedup": similar_sql(4, 80, "d.doc_id = c.component_id AS kept"),
}
