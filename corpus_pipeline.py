"""From raw documents to token digests.

Stages, each an operator of ``reviewops.llm`` over what the stage before kept:

1. ``language``: documents whose language model rejects them go.
2. ``lines``: repeated chunks of lines are cut from the texts.
3. ``near_duplicates``: one document of each SimHash component stays (four-word shingles, four bits).
4. ``benchmark``: documents that hold a benchmark item go (five-word shingles, 0.8).
5. ``tokens``: texts are encoded and decoded; one row of digests per document.

All but the last return the columns of ``documents``.  Null texts are rejected by the first stage;
an empty table gives no rows; equal rows are one near-duplicate group, of which one row stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from reviewops.llm.common import stage
from reviewops.llm.op2_language import keep_known, train
from reviewops.llm.op3_simhash import one_of_each_group
from reviewops.llm.op4_benchmark import clean_documents
from reviewops.llm.op6_lines import dedup_documents
from reviewops.llm.op9_bpe import bpe_round_trip, digests


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_known(docs, train(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each_group(docs, shingle_words=4, max_bits=4)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return digests(bpe_round_trip(docs))


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("tokens", tokens)]

# Character models, XXH64 shingles and byte-pair merges have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
