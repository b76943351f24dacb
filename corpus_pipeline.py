"""Training-corpus pipeline: quality filter, near-dedup, passage dedup, mixing, tokenization.

``run`` applies the stages to the documents table; each stage's rows are
written as Parquet to the shared folder and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe, mixing, queries, quality_classifier, simhash_neardup, substring_dedup
from tessera.llm.common import read_table
from tessera.session import scratch_path


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality classifier accepts."""
    return quality_classifier.accepted(docs, queries.quality_model(spark, sf_dir))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates."""
    return simhash_neardup.keep_one(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without the passages that an earlier document has too."""
    return substring_dedup.remove_passages(docs, count_col="n_chars")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows sampled to the target weights."""
    return mixing.sample(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and the hash of the text that they decode to."""
    return bpe.encode(docs, queries.TOKENIZER, ["doc_id", "lang", "source"], want=("n_tokens", "ids", "decoded_sha256"))


STAGES = [
    ("quality classifier", quality_filter),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", passage_dedup),
    ("mixing to target weights", source_mix),
    ("BPE encoding", tokenize),
]

#: SQL has no BPE and no chained alignment; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
