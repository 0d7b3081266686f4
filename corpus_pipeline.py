"""From raw documents to token files: quality rules, near-dedup, decontamination, mixing, storing.

Every stage takes ``(spark, docs, sf_dir)`` and returns a table that is written before the next
one reads it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.llm import common, decontaminate, grammar_store, mix, near_dups, quality, queries


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that fail; ``n_chars`` follows the text."""
    kept = quality.clean(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else kept


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.prepare(spark)
    return near_dups.keep_one(docs, common.shared_folder(spark, "near-dups"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    queries.prepare(spark)
    return decontaminate.without_benchmark(docs, common.read(spark, sf_dir, "benchmark"), common.shared_folder(spark, "decontaminate"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    queries.prepare(spark)
    return mix.emit(mix.plan(docs)).select(*docs.columns)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, and what they hold of each document."""
    queries.prepare(spark)
    folder = common.shared_folder(spark, "corpus")
    grammar_store.write_store(docs, public_tokenizers.path("byte_bpe_50k.json"), folder)
    return grammar_store.read_store(spark, folder)


STAGES = [
    ("quality rules", quality_rules),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token output", token_output),
]

#: Near duplicates, templates and tokens are beyond SQL; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.documents(spark, sf_dir)
    folder = common.shared_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        docs = common.stored(stage(spark, docs, sf_dir), folder, f"stage-{number}")
    return docs
