"""Mixing sources to target weights.

Sizes are summed per source, targets follow from the weights, and the repetition rate of a source
is its target over its size. Every document is taken floor(rate) times and once more with the
fraction as probability, decided by a hash of its id: a rerun takes the same documents.

Only one row per source is ever gathered. The documents themselves are not shuffled while the
source table is small; beyond that size the join is by source and adaptive execution splits a
source that owns a large part of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigie.llm import common

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
REPEATS = 2.0


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: float = REPEATS) -> DataFrame:
    """Target of every source from its size (columns ``source, source_size``).

    Weights repeat over the sources by code point, null last. ``share`` times all sizes are dealt
    by weight; a source stops at ``repeats`` times its size and the excess goes to the others by
    weight until none is above. That fixed point is found without iterating: sources are ordered
    by the level at which they stop, and the first source not to stop fixes the level of the rest.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(0))
    place = ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    ranked = sizes.select(
        "source", "source_size",
        F.element_at(F.array(*map(F.lit, weights)), place).alias("weight"),
        (F.col("source_size") * repeats).alias("cap"),
    )
    running = ranked.select(
        "*",
        F.coalesce(F.sum("cap").over(before), F.lit(0.0)).alias("stopped"),
        F.coalesce(F.sum("weight").over(before), F.lit(0.0)).alias("stopped_weight"),
        F.sum("weight").over(everything).alias("all_weight"),
        (F.sum("source_size").over(everything) * share).alias("budget"),
    )
    level = (F.col("budget") - F.col("stopped")) / (F.col("all_weight") - F.col("stopped_weight"))
    open_level = F.min(F.when(level * F.col("weight") < F.col("cap"), F.struct(F.col("cap") / F.col("weight"), level.alias("level")))).over(everything)
    return running.select("source", "source_size", "weight", "cap", open_level["level"].alias("level")).select(
        "source", "source_size",
        F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("weight"))).alias("target"),
    )


def chance(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the key and the seed only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def plan(documents: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, repeats: float = REPEATS, seed: str = "mix") -> DataFrame:
    """Every document with ``size, source_size, target, copies``.

    ``copies`` counts how often the mix takes the document. Null texts have size 0, null sources
    form a source of their own, rows that repeat an id share its decision, and sources without a
    word take nothing. Columns of these names are replaced.
    """
    made = ["size", "source_size", "target", "copies"]
    documents = documents.drop(*made)
    key = common.fresh(documents, "mix_source")
    sized = documents.withColumn("size", common.word_count(F.col("text")))
    # One row per source, checkpointed so that its size is known before the join is planned.
    targets = source_targets(
        sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, repeats
    ).withColumnRenamed("source", key).checkpoint()
    held = targets.agg(F.count("*"), F.coalesce(F.max(F.length(key)), F.lit(0))).first()
    if common.small_enough(held[0], 64 + 4 * held[1]):
        targets = F.broadcast(targets)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    extra = (chance(F.col("doc_id"), seed) < rate - F.floor(rate)).cast("int")
    return (
        sized.join(targets, F.col("source").eqNullSafe(F.col(key)), "left")
        .withColumn("copies", (F.floor(rate) + extra).cast("int"))
        .drop(key)
    )


def emit(planned: DataFrame) -> DataFrame:
    """The mixed corpus: a row per taken copy, numbered from 1 in ``copy``."""
    return planned.where("copies > 0").withColumn("copy", F.explode(F.expr("sequence(1, copies)")))
