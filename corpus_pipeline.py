"""Five stages over a corpus: each one's rows are written and read again as the next one's documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pageloom.llm import bpe, decontaminate, jaccard, secret_scan, toxicity
from pageloom.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The stages' rows cannot be said in SQL; tests hold them against brute force.
ORACLE_SQL = None


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labelled ones among them does not take for toxic."""
    model = toxicity.fit_tables(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies: the one with the least id, once if its row is repeated.

    An id that stands for several texts loses only those of them that are copies.
    """
    return jaccard.without_copies(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret in their texts replaced by a mark."""
    return secret_scan.redact(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and hashes of ids and decoded text, of every document that is left."""
    return bpe.digest(bpe.encode(docs, bpe.tokenizer_path()))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("n-gram jaccard join", without_copies),
    ("benchmark decontamination", without_benchmark),
    ("secret scans", without_secrets),
    ("bpe encoding and decoding", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
