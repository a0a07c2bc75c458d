"""Curation of a training corpus in five stages, each on all that the one before has kept.

Every stage is written as Parquet to the shared folder and read again as the next one's documents, so a
lost executor costs no more than a stage, and goes when the next one is written. All stages but the last return
the columns of documents, further ones included, whatever their names.

Rows of null, empty or letterless text have no language and go in the first stage; so none reaches the others, which
would keep them as one class. Repeated rows and near copies leave one row. A row with a null doc_id is kept like any
other, unless its class has a row with an id. Texts of any length are read whole. Empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gristmill.llm import decontaminate, lang_id, packing, secret_scan, simhash_dedup
from gristmill.llm.common import dropped, read, stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go, those of null text or without a letter among them; a row without an id or lang is judged by its text."""
    return lang_id.recognised(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays, the one with the least id; of rows that share it, or have none, the first by content."""
    return simhash_dedup.representatives(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go, row by row; null texts hold none."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind; the documents stay, null texts as they are."""
    return secret_scan.redacted(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens, packed into sequences; a null text is one piece with the separator alone."""
    return packing.pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

#: SQL cannot express learned models, XXH64 or tokenizers.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        kept = stored(stage(spark, docs, sf_dir))
        if k:
            dropped(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)
