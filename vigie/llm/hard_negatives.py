"""Hard negatives by slots of scores.

For an anchor, each positive opens a window of scores for negatives: from a share of the positive's
score up to another share of it. The windows of one anchor overlap, so they are not searched one by
one. Their distinct upper limits, in falling order, cut the scores into disjoint slots; a row falls
into one slot, and only the best k of a slot can be among the best k of any window. Slots are reduced
independently (in each cell, then in each shuffle task, then per anchor). A window is a run of slots
from its own limit downward, so its answer is the first k of its slot and those below, cut at its lower limit.

Scores are exact integers. Anchors and rows are dealt by hash into blocks of bounded size, and a
task scores one block of anchors against one block of rows; it sends on a few rows per anchor, never its scores.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (as pa.compute)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigie.llm import common

ANCHOR_BLOCK = 4096
ROW_BLOCK = 8192
#: Scores that a task holds at once.
CELL_SCORES = 1 << 21


def quantised(vectors: DataFrame, vector: str, scale: int = 256) -> DataFrame:
    """``vec_id, label, codes``: components times ``scale``, rounded down, as integers.

    Rows without an id, label or vector, and rows with a missing or non-finite component, are left out.
    Codes beyond a long stay at its end.
    """
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    whole = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)))
    codes = F.transform(vector, lambda x: F.floor(x.cast("double") * float(scale)).cast("long"))
    return whole.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), codes.alias("codes"))


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Code lists as rows of equal width; a shorter list ends in zeros."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    if len(sizes):
        out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _width(*columns: pa.ChunkedArray) -> int:
    return max([1, *(x.as_py() or 0 for c in columns if len(c) for x in [pa.compute.max(pa.compute.list_value_length(c))])])


def exact_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products as integers: by floats while every sum is exact in them, else by integers of any
    size (a score beyond a long is then its nearest long)."""
    most = [max(abs(int(m.min(initial=0))), int(m.max(initial=0))) for m in (anchors, rows)]
    bound = most[0] * most[1] * anchors.shape[1]
    if bound < 1 << 53:
        return (anchors.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)
    if bound < 1 << 63:
        return anchors @ rows.T
    ends = np.iinfo(np.int64)
    return np.clip(anchors.astype(object) @ rows.T.astype(object), ends.min, ends.max).astype(np.int64)


class Cell:
    """A block of anchors and a block of rows; rows by id, equal rows once."""

    def __init__(self, anchors: pa.Table, rows: pa.Table):
        ids, digests = rows["vec_id"].to_numpy(), rows["digest"].to_numpy()
        order = np.lexsort((digests, ids))
        new = np.ones(len(order), bool)
        new[1:] = (ids[order][1:] != ids[order][:-1]) | (digests[order][1:] != digests[order][:-1])
        order = order[new]
        width = _width(anchors["codes"], rows["codes"])
        self.ids, self.labels = ids[order], rows["label"].to_numpy()[order]
        self.codes = _matrix(rows["codes"], width)[order]
        self.anchor_ids, self.anchor_labels = anchors["vec_id"].to_numpy(), anchors["label"].to_numpy()
        self.anchor_digests = anchors["digest"].to_numpy()
        self.anchor_codes = _matrix(anchors["codes"], width)

    def parts(self, anchors: np.ndarray, rows: np.ndarray):
        """Numbers and scores of slices of the anchors against some rows."""
        step = max(1, CELL_SCORES // max(len(rows), 1))
        codes = self.codes[rows]
        for at in range(0, len(anchors), step):
            some = anchors[at:at + step]
            yield some, exact_scores(self.anchor_codes[some], codes)


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of a row of scores in falling order, earlier places first among equals."""
    if len(scores) > k:
        edge = np.partition(scores, len(scores) - k)[len(scores) - k]
        at = np.flatnonzero(scores >= edge)
    else:
        at = np.arange(len(scores))
    return at[np.argsort(-scores[at], kind="stable")][:k]


def _rows(columns: list[list], names: list[str], kinds: list) -> pa.Table:
    parts = [np.concatenate(c) if c else np.empty(0, np.int64) for c in columns]
    return pa.table([pa.array(p.astype(np.int64), pa.int64()).cast(k) for p, k in zip(parts, kinds)], names)


def _cells(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int):
    """Each block of anchors beside each block of rows, as cogroups."""
    across, down = max(1, -(-n_anchors // ANCHOR_BLOCK)), max(1, -(-n_rows // ROW_BLOCK))
    block, part = F.pmod("digest", F.lit(across)), F.pmod(F.xxhash64("digest"), F.lit(down))
    left = anchors.withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(down - 1).cast("long"))))
    right = rows.withColumn("part", part).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(across - 1).cast("long"))))
    left, right = (side.select([F.col(c).alias(c) for c in side.columns]) for side in (left, right))  # columns of their own
    return left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))


def positives(anchors: DataFrame, rows: DataFrame, sizes: tuple[int, int], k: int) -> DataFrame:
    """``anchor_id, digest, positive_id, positive_score``: the best ``k`` rows of the anchor's label."""
    names = ["anchor_id", "digest", "positive_id", "positive_score"]

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        cell, out = Cell(left, right), [[], [], [], []]
        for label in np.unique(cell.anchor_labels):
            like = np.flatnonzero(cell.labels == label)
            for some, scores in cell.parts(np.flatnonzero(cell.anchor_labels == label), like):
                for a, row in zip(some, scores):
                    other = cell.ids[like] != cell.anchor_ids[a]
                    ids, row = cell.ids[like][other], row[other]
                    at = _best(row, k)
                    for column, values in zip(out, (np.full(len(at), cell.anchor_ids[a]), np.full(len(at), cell.anchor_digests[a]), ids[at], row[at])):
                        column.append(values)
        return _rows(out, names, [pa.int64()] * 4)

    found = _cells(anchors, rows, *sizes).applyInArrow(work, ", ".join(f"{n} long" for n in names))
    order = Window.partitionBy("anchor_id", "digest").orderBy(F.desc("positive_score"), "positive_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def slot_winners(anchors: DataFrame, rows: DataFrame, sizes: tuple[int, int], k: int) -> DataFrame:
    """``anchor_id, digest, slot, score, negative_id``: the best ``k`` rows of other labels in each slot.

    Anchors carry ``uppers``, the falling upper limits, and ``least``, the lowest score that any window takes.
    """
    names = ["anchor_id", "digest", "slot", "score", "negative_id"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]

    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        cell, out = Cell(left, right), [[], [], [], [], []]
        uppers, least = [np.array(u, np.int64) for u in left["uppers"].to_pylist()], left["least"].to_numpy()
        for some, scores in cell.parts(np.arange(len(cell.anchor_ids)), np.arange(len(cell.ids))):
            for a, row in zip(some, scores):
                at = np.flatnonzero((row <= uppers[a][0]) & (row >= least[a]))
                at = at[(cell.labels[at] != cell.anchor_labels[a]) & (cell.ids[at] != cell.anchor_ids[a])]
                at = at[np.argsort(-row[at], kind="stable")]
                slot = np.searchsorted(-uppers[a], -row[at], "right") - 1  # falling scores, so slots rise
                at, slot = (x[np.arange(len(slot)) - np.searchsorted(slot, slot) < k] for x in (at, slot))
                for column, values in zip(out, (np.full(len(at), cell.anchor_ids[a]), np.full(len(at), cell.anchor_digests[a]), slot, row[at], cell.ids[at])):
                    column.append(values)
        return _rows(out, names, kinds)

    found = _cells(anchors, rows, *sizes).applyInArrow(work, "anchor_id long, digest long, slot int, score long, negative_id long")
    order = Window.partitionBy("anchor_id", "digest", "slot").orderBy(F.desc("score"), "negative_id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k).drop("place")


def mine(
    vectors: DataFrame, is_anchor: Column, folder: str, n_positives: int = 5, n_negatives: int = 3, low: int = 50, high: int = 95,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` over ``vec_id, label, codes``.

    A positive's window holds negatives of at least ``low`` and at most ``high`` percent of its score.
    Equal scores go by the smaller id. Equal rows count once; rows that share an id and differ are rows
    of their own, none of them a partner of another; vectors of unequal length end in zeros. An anchor
    without positives, and a window without rows, gives nothing. Intermediate tables go to ``folder``.
    """
    rows = vectors.select("vec_id", "label", "codes", F.xxhash64("vec_id", "label", "codes").alias("digest"))
    anchors = rows.where(is_anchor).dropDuplicates(["vec_id", "digest"])
    total, chosen = rows.agg(F.count("*"), F.count(F.when(is_anchor, 1))).first()
    sizes = (chosen, total)
    best = common.stored(positives(anchors, rows, sizes, n_positives), folder, "positives")

    top, bottom = F.expr(f"({int(high)} * positive_score) div 100"), F.expr(f"({int(low)} * positive_score + 99) div 100")
    windows = best.where("positive_score >= 0").withColumn("top", top).withColumn("bottom", bottom).where("bottom <= top")  # below 0 a window is empty
    limits = windows.groupBy("anchor_id", "digest").agg(
        F.sort_array(F.collect_set("top"), asc=False).alias("uppers"), F.min("bottom").alias("least"),  # at most n_positives limits
        F.collect_list(F.struct("positive_id", "positive_score", "top", "bottom")).alias("windows"),
    )
    limits = common.stored(limits, folder, "limits")
    searched = anchors.join(limits.select(F.col("anchor_id").alias("vec_id"), "digest", "uppers", "least"), ["vec_id", "digest"])
    winners = common.stored(slot_winners(searched, rows, sizes, n_negatives), folder, "winners")

    kept = winners.groupBy("anchor_id", "digest").agg(  # at most n_negatives for each of n_positives slots
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("fall"), "negative_id", "slot"))).alias("kept"))
    each = limits.join(kept, ["anchor_id", "digest"]).select("anchor_id", "uppers", "kept", F.explode("windows").alias("w")).select("anchor_id", "uppers", "kept", "w.*")
    slot = F.array_position("uppers", F.col("top")) - 1
    first = F.slice(F.filter("kept", lambda x: x["slot"] >= slot), 1, n_negatives)
    inside = F.filter(first, lambda x: -x["fall"] >= F.col("bottom"))
    return each.select("anchor_id", "positive_id", "positive_score", F.posexplode(inside).alias("at", "n")).select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("n.negative_id").alias("negative_id"),
        "positive_score", (-F.col("n.fall")).alias("negative_score"),
    )
