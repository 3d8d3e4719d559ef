"""The corpus pipeline: rejects toxic documents, keeps one document of each near-duplicate group,
drops documents contaminated by the benchmark, mixes sources to target weights and writes token files.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept; what it returns is
written as Parquet in the shared folder and read again as the next stage's ``docs``. All stages but the last return
the columns of ``docs``; the last returns doc_id, start, n_tokens and ids_crc32 of each document in the token files. Cases
such as nulls, repeated rows and empty tables are those of the operators called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moneytrail.llm import decontaminate, mixing, simhash, token_file, toxicity
from moneytrail.llm.common import crc_mod, fresh_path, table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below their language's threshold; a third of the labels is never learned from."""
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"), usable=crc_mod(F.col("id"), 3) != 1)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest doc_id of each SimHash group."""
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target weight draws it, in a global shuffle."""
    return mixing.mix(docs).select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the token files, laid out in the mixing stage's order, as read back."""
    return token_file.round_trip(docs, given_order=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", one_of_each_group),
    ("benchmark_decontamination", without_benchmark),
    ("mixing", mixed),
    ("token_ids", token_files),
]

#: Classifier, tokeniser and components are not SQL: tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
