"""Registered queries of the operators, each over its whole table; `QUERIES` and `ORACLE` are added by the entry module."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.llm import ann, language, mixing, neardup, offsets, packing, pieces, quality_rules, quality_scores, secrets, token_counts, variants, whitening
from tabwright.llm.texts import documents


def vocabulary(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir, "doc_id", "text"), vocabulary("byte_bpe_50k.json"))


def op2_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return ann.nearest(vectors, F.coalesce(F.col("vec_id") % 50 == 0, F.lit(False)))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, manifest = offsets.write_token_files(documents(spark, sf_dir, "doc_id", "text"), vocabulary("byte_bpe_50k.json"))
    return offsets.read_token_files(spark, folder, manifest)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir, "doc_id", "text"), vocabulary("word_bpe_49k.json"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))


def op6_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_pieces(documents(spark, sf_dir, "doc_id", "text"), vocabulary("piece_bpe_32k.model"))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir, "doc_id", "text", "lang"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(documents(spark, sf_dir, "doc_id", "text", "lang", "source"))


def op9_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality_scores.score_quality(documents(spark, sf_dir, "doc_id", "text"), labels)


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir, "doc_id", "text", "source"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.spelling_variants(documents(spark, sf_dir, "doc_id", "text"))


def op12_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir, "doc_id", "text", "source"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_nearest_neighbours,
        op3_token_files,
        op4_packing,
        op5_near_duplicates,
        op6_sentence_pieces,
        op7_language,
        op8_quality_rules,
        op9_quality_scores,
        op10_secrets,
        op11_spelling_variants,
        op12_source_mix,
        op13_whitening,
    )
}

# Tokenizers, trained models, samplers, checksums and iterative estimates have no SQL; tests/llm holds them against brute force.
ORACLE: dict[str, str] = {"op12_source_mix": mixing.mix_sql()}
