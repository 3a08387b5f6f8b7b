"""The registered queries of the dealt operators, each over its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, decontaminate, language_id, line_dedup, merkle, oracles, packing, repetition, secret_scan,
               simhash, spelling, substring_dedup, token_counts, toxicity)
from .tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every text: doc_id, n_bytes, n_tokens, over_limit."""
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), max_tokens=1024)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contaminated documents, a row for each benchmark item that they hold a passage of."""
    return decontaminate.overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("text_hash")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition measures and the verdict for every text."""
    return repetition.quality(read_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that lie in 20-word windows seen earlier, and what is left, for every text."""
    return substring_dedup.dedup(read_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that an earlier line equals within one word, and what is left, for every text."""
    return line_dedup.dedup(read_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of at most 2048 ids."""
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and novel secret spans of every text."""
    return secret_scan.scan(read_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every text; the fold whose crc32(doc_id) mod 5 is 0 isn't learned from."""
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), folds=5, held_out=0)
    return toxicity.score(docs, model).select(
        "doc_id", (language_id.fold_of(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every text; the fold whose crc32(doc_id) mod 4 is 2 isn't learned from."""
    docs = read_table(spark, sf_dir, "documents")
    profiles = language_id.fit(docs.where(language_id.fold_of(F.col("doc_id"), 4) != 2))
    return language_id.predict(docs, profiles).select(
        "doc_id", (language_id.fold_of(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score")


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every row, and the root that the row leads to after tampering."""
    docs = read_table(spark, sf_dir, "documents")
    return merkle.manifest(docs, check=merkle.tampered(docs))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every repeated word with its near words, its form and its root."""
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text and the bytes they decode to, as digests."""
    return byte_bpe.round_trip(read_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline.py, applied to documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def _registered(query: QueryFn) -> QueryFn:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        # Python workers import this package from where the driver has it, whatever their folder
        path, root = spark.sparkContext.environment.get("PYTHONPATH", ""), str(Path(__file__).parents[2])
        if root not in path.split(os.pathsep):
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, path) if x)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, QueryFn]:
    return {f.__name__: _registered(f) for f in (
        op1_token_counts, op2_decontamination, op3_quality_rules, op4_substring_dedup, op5_line_dedup, op6_packing,
        op7_secret_scan, op8_toxicity, op9_language_id, op10_simhash, op11_merkle_manifest, op12_spelling_variants,
        op13_byte_bpe, pipeline)}


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql()
