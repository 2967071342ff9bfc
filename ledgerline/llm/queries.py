"""Registered queries of the corpus operators: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import (ann, decontamination, gru_lm, hard_negatives, language_id, license_scan, line_dedup, mixing, phrases,
                            secret_scan, simhash, substring_dedup, token_ids)
from ledgerline.llm.common import read_table


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = language_id.fit(docs, ~language_id.held_out())
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read_table(spark, sf_dir, "documents")).drop("matches")


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeated_spans(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_lines(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.score(read_table(spark, sf_dir, "documents"))


def op9_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    manifest = token_ids.write(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return token_ids.read(manifest)


def short_first() -> Column:
    """A source that does not fit whole keeps many documents rather than a few long ones."""
    return F.lit(1.0) / F.sqrt(F.greatest("size", F.lit(1)).cast("double"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(read_table(spark, sf_dir, "documents"), preference=short_first())
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(read_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    vectors = read_table(spark, sf_dir, "embeddings") \
        .withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine(vectors, F.col("vec_id") % 100 == 0)


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_grammar", "score")


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_license_scan": op2_license_scan,
    "op3_nearest_neighbours": op3_nearest_neighbours,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_line_dedup": op5_line_dedup,
    "op6_mixing": op6_mixing,
    "op7_decontamination": op7_decontamination,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_token_ids": op9_token_ids,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_secret_scan": op13_secret_scan,
}

ORACLES: dict[str, str] = {
    "op2_license_scan": license_scan.oracle(),
    "op4_substring_dedup": substring_dedup.ORACLE,
    "op5_line_dedup": line_dedup.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op11_phrase_mining": phrases.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
