"""From raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns what it kept, with the columns of documents
(the last adds ids). `run` writes what a stage returns as Parquet in the shared folder and
reads it again for the next.

Cases: a null doc_id counts as the largest, its rows are judged by their texts like any other;
repeated rows share each decision. A null text counts as empty in each decision and stays null
until the last stage, which encodes it as no ids. Empty tables give empty results; additional
columns are carried along, whatever their names; `input_ids` and `n_tokens` are replaced by the
last stage.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import bpe, decontaminate, jaccard_join, quality, secrets
from lodestone.llm.common import scratch, table
from lodestone.shipping import ship

RANKS = "byte_bpe_50k.tiktoken"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of least id stays."""
    return jaccard_join.distinct_documents(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the text become a mark; n_chars follows."""
    out = secrets.redacted(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns) if "n_chars" in docs.columns else out


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each text, as input_ids, and their number."""
    return bpe.encoded(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _shipped(stage: Stage) -> Stage:
    """The stage, with the package sent to the executors before it runs."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", _shipped(quality_classifier)),
    ("n-gram Jaccard join", _shipped(ngram_jaccard_join)),
    ("benchmark decontamination", _shipped(benchmark_decontamination)),
    ("secret scans", _shipped(secret_scan)),
    ("byte-level BPE", _shipped(bpe_encoding)),
]

#: No SQL expresses the first stage; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        path = scratch(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
