"""Corpus pipeline: documents to token-id files, in five stages.

Every stage works on all rows its predecessor kept; each but the last returns
the columns of ``documents``.  ``run`` writes each stage's rows as Parquet to
the shared scratch folder and reads them back as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontamination, language_id, mixing, simhash, token_ids
from ledgerline.llm.common import read_table, staged
from ledgerline.llm.queries import short_first


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or between two languages, go."""
    model = language_id.fit(docs, ~language_id.held_out())
    names = [c if c == "text" else f"column_{k}" for k, c in enumerate(docs.columns)]  # none meets the prediction's
    told = language_id.predict(docs.toDF(*names), model)
    return told.where((F.col("lang_pred") != language_id.UND) & ~F.col("ambiguous")).select(*names).toDF(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.first_of_each(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, exact or edited, go."""
    return decontamination.clean(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (0 to 3 times)."""
    return mixing.mixed_documents(docs, preference=short_first())


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of the mixed corpus; the rows are read back from them."""
    return token_ids.read(token_ids.write(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language_id", detect_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("token_ids", write_tokens),
]

#: the learned, aligned and tokenized stages are beyond SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
