"""The registered queries of the operators over the given tables."""

from __future__ import annotations

import tempfile

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.llm import (
    alignment, common, decontaminate, grammar_store, hard_negatives, licenses, line_templates, mix, near_dups, preference, quality,
    secrets, token_counts, toxicity,
)


def prepare(spark: SparkSession) -> None:
    """This package for the workers and, in a session of one process, a place for intermediate tables if none is set."""
    context = spark.sparkContext
    if not (spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()) and context.master.split("[")[0] == "local":
        context.setCheckpointDir(tempfile.mkdtemp(prefix="vigie-llm-"))
    common.ship(spark)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return common.read(spark, sf_dir, "documents")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mix.plan(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return planned.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    labels = common.read(spark, sf_dir, "labels").where(~held_out).select("doc_id", "toxic")
    lexicon = toxicity.learn(docs, labels, common.shared_folder(spark, "toxicity"))
    return toxicity.score(docs, lexicon).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return decontaminate.contaminated(docs, common.read(spark, sf_dir, "benchmark"), common.shared_folder(spark, "decontaminate"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op6_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.classes(documents(spark, sf_dir), common.shared_folder(spark, "near-dups"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(documents(spark, sf_dir).select("doc_id", "text")).drop("text", "clean_text")


def op8_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preference.format_sides(preference.with_other_answer(common.read(spark, sf_dir, "conversations")))


def op9_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    found = line_templates.without_recurring(docs, common.shared_folder(spark, "line-templates"))
    return found.select("doc_id", "n_lines", "n_dropped", F.crc32(F.col("clean_text").cast("binary")).alias("clean_crc32"))


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    folder = common.shared_folder(spark, "token-store")
    grammar_store.write_store(docs, public_tokenizers.path("byte_bpe_50k.json"), folder)
    return grammar_store.read_store(spark, folder)


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(documents(spark, sf_dir).select("doc_id", "text"))
    base = secrets.of_kind(F.col("secrets"), *secrets.BASE)
    counts = [F.size(secrets.of_kind(F.col("secrets"), k)).cast("long").alias(f"n_{k}") for k in secrets.BASE]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.listed(base).cast("binary"), 256).alias("base_sha256"), secrets.listed(F.col("secrets")).alias("spans"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    vectors = hard_negatives.quantised(common.read(spark, sf_dir, "embeddings"), "embedding")
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", noisy), F.col("vec_id") % 50 == 0, common.shared_folder(spark, "hard-negatives"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return alignment.align(documents(spark, sf_dir), *paths, common.shared_folder(spark, "alignment"))


QUERIES = {
    "op1_mix": op1_mix,
    "op2_toxicity": op2_toxicity,
    "op3_licenses": op3_licenses,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_counts": op5_token_counts,
    "op6_near_dups": op6_near_dups,
    "op7_quality_rules": op7_quality_rules,
    "op8_preference": op8_preference,
    "op9_line_templates": op9_line_templates,
    "op10_token_store": op10_token_store,
    "op11_secrets": op11_secrets,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_alignment": op13_alignment,
}
