"""Connected components over links, by stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.llm import common


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(high, low))")).first()
    return tuple(row)


def components(links: DataFrame, folder: str, name: str) -> DataFrame:
    """``node, label`` of every node in a link ``a, b``; the label is the component's smallest node.

    Each round hangs the larger neighbours of a node, then the node itself, on the smallest node
    around (large stars and small stars in turn), until nothing changes. A node's neighbours are
    reduced by minima and joined back, never gathered, so one huge component is no huge group; each
    round is a table in the shared folder.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct()
    edges = common.stored(edges, folder, f"{name}-0")
    before, turn = _state(edges), 0
    while before[0]:
        turn += 1
        both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).union(edges.select(F.col("low").alias("u"), F.col("high").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low")).distinct()
        large = common.stored(large, folder, f"{name}-{turn}a")
        root = large.groupBy("high").agg(F.min("low").alias("m"))
        small = large.join(root, "high").where("low <> m").select(F.col("low").alias("high"), F.col("m").alias("low"))
        small = small.union(root.select("high", F.col("m").alias("low"))).distinct()
        edges = common.stored(small, folder, f"{name}-{turn}b")
        after = _state(edges)
        if after == before:
            break
        before = after
    stars = edges.select(F.col("high").alias("node"), F.col("low").alias("label"))
    return stars.union(edges.select(F.col("low").alias("node"), F.col("low").alias("label")).distinct())
