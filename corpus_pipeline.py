"""Corpus pipeline: documents to token files, one operator a stage.

1. quality: documents that the quality classifier rejects go.
2. near_duplicates: of each group of near duplicates one document stays.
3. decontaminate: documents that hold a test item go.
4. mix: documents are repeated or left out, to the target weights of the sources.
5. tokens: the mixed corpus is written as token files and read back.

Each stage gets all rows that the stage before it kept, as a Parquet table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from partnerwatch.llm import decontaminate, jaccard_join, mixing, quality, token_files
from partnerwatch.llm.common import shared_table, table
from partnerwatch.llm.queries import tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.token_output(docs, tokenizer_path(), by_word=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_good),
    ("near_duplicates", one_of_each),
    ("decontaminate", clean),
    ("mix", mix),
    ("tokens", tokens),
]
#: A quadratic discriminant, shingle sets and a tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
