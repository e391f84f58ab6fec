"""A training corpus from `documents`, in five stages; each is written as Parquet and read again as the next one's input."""

import uuid

from pyspark.sql import DataFrame, SparkSession

from tabwright.llm import language, neardup, packing, quality_rules, secrets
from tabwright.llm.queries import vocabulary
from tabwright.session import checkpoint_dir


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; texts that are null or have no letter go."""
    return language.accept(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    return quality_rules.accept(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    return neardup.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked."""
    return secrets.mask(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their sequences."""
    return packing.pack_documents(docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("quality_rules", quality),
    ("near_duplicates", near_duplicates),
    ("secret_scan", secret_scan),
    ("packing", packed),
]
# The stages train models and iterate, which SQL can't express; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, with their results in the folder of spark.checkpoint.dir."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
