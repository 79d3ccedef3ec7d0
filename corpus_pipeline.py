"""The corpus pipeline: from the documents table to encoded training text.

Each stage is a function of (spark, docs, sf_dir). Between stages the documents are
written as Parquet to the shared folder and read again, so a lost executor costs no more than a
stage's own work.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from growthledger.llm import byte_bpe, decontaminate, line_dedup, ngram_join, quality_knn
from growthledger.llm.common import prepare, table

#: Near copies share so much of their five-word shingles.
SHINGLE_WORDS, SIMILARITY = 5, 0.8


#: The columns that stages look at; all others only pass through.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")


def _aside(docs: DataFrame) -> DataFrame:
    """``docs`` with its other columns under names that clash with nothing."""
    return docs.toDF(*[c if c in KNOWN else f"other_{i}" for i, c in enumerate(docs.columns)])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Null and empty texts are judged by the share of good labels; repeated rows are judged alike, each by itself.
    """
    aside = _aside(docs)
    scored = quality_knn.quality(aside, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 1").select(*aside.columns).toDF(*docs.columns)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that many sites share, beyond each line's first; texts of which nothing is left go."""
    aside = _aside(docs)
    shorter = line_dedup.line_dedup(aside)
    left = (F.col("n_removed") == 0) | (F.trim("text") != "")
    columns = [F.length("text").cast(aside.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c) for c in aside.columns]
    return shorter.where(left).select(*columns).toDF(*docs.columns)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; rows without id as they are.

    Rows that repeat id and text stay once, in any of them; an id that stays and has several texts keeps all of them.
    """
    groups = ngram_join.ngram_jaccard_join(docs, SHINGLE_WORDS, SIMILARITY)
    kept = groups.where("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "leftsemi").dropDuplicates(["doc_id", "text"])
    return named.union(docs.where("doc_id IS NULL"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found; null and empty texts stay, repeated rows are judged alike."""
    aside = _aside(docs)
    kept = decontaminate.decontaminate(aside, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return kept.select(*aside.columns).toDF(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count of each text, and digests of its ids and of what they decode to; null texts count as empty."""
    return byte_bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_shared_lines),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("byte-level BPE", encode),
]

#: SQL can't express the classifier, the latent space or the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole documents table."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
