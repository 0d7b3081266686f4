"""Near-duplicate texts by ProbMinHash.

A text is its set of five-word windows, weighted by 1 + ln(count). In a signature of the text,
every window is a Poisson process whose rate is its weight; each arrival falls on one component,
and a component keeps the window that arrives first. Later arrivals than the last filled
component's cannot matter, so a window stops early. Two texts agree in a component with their
probability Jaccard similarity as probability. Bands of components make candidates, and every
candidate pair that decides something is verified by the exact similarity.

Groups of thousands of copies never meet as pairs. Equal texts are one node. In a band's bucket,
each node is compared with one of the bucket's nodes, another in each fifth of the bands. Classes
are the connected components of verified pairs. Where a bucket then still holds several classes,
windows tell which pairs are left. A window that few nodes hold is rare: nodes of two classes that
share one are compared, a few pairs a window. Any other pair shares none, so each side's rare windows
stand alone in it and bound its similarity from above; a copy that is edited too much is thereby
near nothing, whatever it is compared with. Each node is compared with the bucket's plainest, that
with the least weight in rare windows, and last the nodes outside the largest class with the rest,
except pairs that this bound or the triangle inequality (one minus the similarity is a metric) rules out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigie.llm import common, shingles
from vigie.llm.graph import components

WIDTH = 5
SIMILAR = 0.8
BANDS = 25
ROWS = 5
LEADERS = 5
#: A window is rare if at most so many nodes of mixed buckets hold it.
RARE = 8
#: For rounding, where a bound decides.
SLACK = 1e-9


def signatures(value: np.ndarray, text: np.ndarray, weight: np.ndarray, n_texts: int, size: int) -> np.ndarray:
    """One row of ``size`` window hashes per text, all texts of a batch at once."""
    time = np.full((n_texts, size), np.inf)
    winner = np.zeros((n_texts, size), np.uint64)
    flat_time, flat_winner = time.ravel(), winner.ravel()
    alive = np.arange(len(value))
    clock = np.zeros(len(value))
    last = np.full(n_texts, np.inf)
    turn = 0
    while len(alive):
        turn += 1
        draw = shingles.mix64(value[alive] + np.uint64(turn * int(shingles.BASE) % (1 << 64)))
        clock = clock - np.log((draw >> np.uint64(11)).astype(np.float64) * 2.0**-53 + 2.0**-54) / weight[alive]
        place = text[alive] * size + (shingles.mix64(draw) % np.uint64(size)).astype(np.int64)
        better = clock < flat_time[place]
        at, when, what = place[better], clock[better], value[alive[better]]
        np.minimum.at(flat_time, at, when)
        won = flat_time[at] == when
        flat_winner[at[won]] = what[won]
        live = np.flatnonzero(np.bincount(text[alive], minlength=n_texts))
        last[live] = time[live].max(axis=1)
        going = clock < last[text[alive]]
        alive, clock = alive[going], clock[going]
    return winner


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact probability Jaccard similarity of two weighted sets (sorted hashes, weights)."""
    _, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(ia):
        return 0.0
    # Common windows in order of their weight ratio; windows of one text only are at either end.
    wa, wb = a[1][ia], b[1][ib]
    order = np.argsort(wb / wa, kind="stable")
    wa, wb = wa[order], wb[order]
    ratio = wb / wa
    upto = np.searchsorted(ratio, ratio, "right")
    sum_a, sum_b = np.concatenate([[0], np.cumsum(wa)]), np.concatenate([[0], np.cumsum(wb)])
    only_a, only_b = a[1].sum() - sum_a[-1], b[1].sum() - sum_b[-1]
    return float(np.sum(1 / ((only_a + sum_a[upto]) / wa + (only_b + sum_b[-1] - sum_b[upto]) / wb)))


def _weighted(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return shingles.weighted(*shingles.windows(*shingles.word_hashes(texts), WIDTH))


def digest(text: Column) -> Column:
    """What texts are told apart by; equal to the digest that :func:`band_keys` gives."""
    return F.unhex(F.md5(text.cast("binary")))


def band_keys(texts: DataFrame) -> DataFrame:
    """``doc_id, digest, keys`` of every text: one 64-bit key per band, none for a wordless text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                nodes, some = batch.column(0).slice(at, 1024), batch.column(1).slice(at, 1024).to_pylist()
                value, text, weight = _weighted(some)
                full = np.bincount(text, minlength=len(some)) > 0
                number = np.cumsum(full) - 1
                found = signatures(value, number[text], weight, int(full.sum()), BANDS * ROWS)
                bands = (found.reshape(-1, BANDS, ROWS) * shingles.PLACES[:ROWS]).sum(axis=2, dtype=np.uint64)
                keys = shingles.mix64(bands + shingles.PLACES[:BANDS]).view(np.int64)
                ends = np.concatenate([[0], np.cumsum(full) * BANDS]).astype(np.int32)
                digests = [hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() for t in some]
                yield pa.record_batch(
                    [nodes, pa.array(digests, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel()))],
                    ["doc_id", "digest", "keys"],
                )

    return texts.select("doc_id", "text").mapInArrow(work, "doc_id long, digest binary, keys array<long>")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``a, b`` with their exact ``similarity``; ``texts`` has one row per node."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                some = part.column(2).to_pylist() + part.column(3).to_pylist()
                place = {t: i for i, t in enumerate(dict.fromkeys(some))}
                value, text, weight = _weighted(list(place))
                cut = np.searchsorted(text, np.arange(len(place) + 1))
                own = [(value[a:b], weight[a:b]) for a, b in zip(cut, cut[1:])]
                n = part.num_rows
                found = [similarity(own[place[some[i]]], own[place[some[n + i]]]) for i in range(n)]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(found, pa.float64())], ["a", "b", "similarity"])

    left, right = texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), texts.select(F.col("node").alias("b"), F.col("text").alias("tb"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
    return joined.mapInArrow(work, "a long, b long, similarity double")


def windows_of(texts: DataFrame) -> DataFrame:
    """``node, label, total, heaviest, value, weight``: the windows of every text and their weights."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                value, text, weight = _weighted(part.column(2).to_pylist())
                ends = np.searchsorted(text, np.arange(part.num_rows + 1))
                own = [weight[a:b] for a, b in zip(ends, ends[1:])]
                places = pa.array(ends.astype(np.int32))
                yield pa.record_batch(
                    [
                        part.column(0), part.column(1), pa.array([w.sum() for w in own], pa.float64()),
                        pa.array([w.max(initial=0) for w in own], pa.float64()),
                        pa.ListArray.from_arrays(places, pa.array(value.view(np.int64))),
                        pa.ListArray.from_arrays(places, pa.array(weight, pa.float64())),
                    ],
                    ["node", "label", "total", "heaviest", "value", "weight"],
                )

    schema = "node long, label long, total double, heaviest double, value array<long>, weight array<double>"
    return texts.select("node", "label", "text").mapInArrow(work, schema)


def most_alike(x: str, y: str) -> Column:
    """An upper bound for the similarity of two texts that share no rare window.

    Columns named by a side: ``total`` weight, ``rest`` of it in windows that are not rare, not 0, and ``heaviest``
    weight; no weight is below 1. A common window i adds at most 1 / (own_x / x_i + total_y / y_i), which is
    concave and homogeneous in its weights, so all add at most what their sums give; x_i sum to ``rest_x`` at most,
    and y_i to ``rest_y`` and to ``heaviest_y`` times that.
    """

    def one(a: str, b: str) -> Column:
        common_b = F.least(F.col(f"rest_{b}"), F.col(f"heaviest_{b}") * F.col(f"rest_{a}"))
        return 1 / ((F.col(f"total_{a}") - F.col(f"rest_{a}")) / F.col(f"rest_{a}") + F.col(f"total_{b}") / common_b)

    return F.least(one(x, y), one(y, x))


def _side(name: str) -> list[Column]:
    """The columns of a node as one side of a pair."""
    return [F.col(c).alias(f"{c}_{name}") for c in ("node", "label", "total", "rest", "heaviest", "near")]


def _several(named: DataFrame) -> DataFrame:
    """The rows of buckets that hold several labels."""
    spans = named.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("key")
    return named.join(spans, "key")


def _by_rare_windows(mixed: DataFrame, texts: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """``node, total, rest, heaviest`` of the nodes of mixed buckets, and the pairs ``a, b`` of two labels
    that share a bucket and a rare window."""
    nodes = common.stored(mixed.groupBy("node", "label").agg(F.collect_set("key").alias("keys")), folder, "mixed-nodes")  # at most BANDS
    held = common.stored(windows_of(nodes.select("node", "label").join(texts, "node")), folder, "windows")
    each = held.select("node", "label", F.explode(F.arrays_zip("value", "weight")).alias("w")).select("node", "label", "w.value", "w.weight")
    few = each.groupBy("value").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high"))
    rare = common.stored(each.join(few.where(F.col("n") <= RARE), "value").drop("n"), folder, "rare")
    own = rare.groupBy("node").agg(F.sum("weight").alias("own"))
    bounds = held.join(own, "node", "left").select("node", "total", (F.col("total") - F.coalesce("own", F.lit(0.0))).alias("rest"), "heaviest")
    bounds = common.stored(bounds, folder, "bounds")
    holders = rare.where("low < high").groupBy("value").agg(F.collect_list(F.struct("node", "label")).alias("who"))  # at most RARE
    pairs = F.transform("who", lambda x: F.transform(
        F.filter("who", lambda y: (x["node"] < y["node"]) & (x["label"] != y["label"])), lambda y: F.struct(x["node"].alias("a"), y["node"].alias("b"))))
    sharing = holders.select(F.explode(F.flatten(pairs)).alias("p")).select("p.a", "p.b").distinct()
    left, right = nodes.select(F.col("node").alias("a"), F.col("keys").alias("ka")), nodes.select(F.col("node").alias("b"), F.col("keys").alias("kb"))
    return bounds, sharing.join(left, "a").join(right, "b").where(F.arrays_overlap("ka", "kb")).select("a", "b")


def _ordered(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _class_of_texts(known: DataFrame, folder: str) -> DataFrame:
    """``doc_id, digest, class_id`` of every row of ``known`` (``doc_id, text``, no nulls).

    A node is a distinct text, named by the number of one row that has it. Row numbers are given once,
    with the stored signatures, and never again.
    """
    signed = common.stored(band_keys(known).withColumn("row", F.monotonically_increasing_id()), folder, "signed")
    heads = signed.groupBy("digest").agg(F.min("row").alias("node"), F.max("row").alias("last")).where("node < last").select("digest", "node")
    member = common.stored(signed.select("row", "digest").join(heads, "digest").select("row", "node"), folder, "members")
    copies = common.light(common.stored(member.where("row <> node").select("row"), folder, "copies"))
    keys = signed.select("row", "keys").join(copies, "row", "left_anti").withColumnRenamed("row", "node")

    spread = keys.select("node", F.explode("keys").alias("key"))
    leader = F.min_by("node", F.xxhash64("node", F.pmod("key", F.lit(LEADERS))))
    buckets = spread.groupBy("key").agg(leader.alias("leader"), F.min("node").alias("low"), F.max("node").alias("high"))
    buckets = common.stored(buckets.where("low < high").select("key", "leader"), folder, "buckets")
    shared = common.stored(spread.join(buckets, "key").select("key", "leader", "node"), folder, "shared")

    first = common.stored(shared.where("leader <> node").select(*_ordered("leader", "node")).distinct(), folder, "first")
    wanted = common.light(common.stored(first.select(F.explode(F.array("a", "b")).alias("node")).distinct(), folder, "wanted"))
    wanted = signed.join(wanted, signed.row == wanted.node).select("doc_id", "digest", "node")
    wanted = common.light(common.stored(wanted, folder, "asked"), row_bytes=48)
    texts = known.withColumn("digest", digest(F.col("text"))).join(wanted, ["doc_id", "digest"])
    texts = common.stored(texts.select("node", "text").dropDuplicates(["node"]), folder, "texts")
    checked = common.stored(verified(first, texts), folder, "checked")
    links = checked.where(F.col("similarity") >= SIMILAR).select("a", "b")
    label = components(links, folder, "one")

    # Buckets that still hold several classes: pairs by rare windows, and each node with the bucket's plainest.
    mixed = _several(shared.join(label, "node", "left").withColumn("label", F.coalesce("label", "node")))
    mixed = mixed.select("key", "leader", "node", "label", *_ordered("leader", "node")).join(checked, ["a", "b"], "left").select(
        "key", "leader", "node", "label", F.when(F.col("leader") == F.col("node"), 1.0).otherwise(F.col("similarity")).alias("near")
    )
    mixed = common.stored(mixed, folder, "mixed")
    bounds, sharing = _by_rare_windows(mixed, texts, folder)
    # Without a rare window in common, the similarity is at most rest / total.
    bounded = common.stored(mixed.join(bounds, "node").where(F.col("rest") >= (SIMILAR - SLACK) * F.col("total")), folder, "bounded")
    plainest = bounded.groupBy("key").agg(F.min_by(F.struct(*_side("y")), F.struct(F.col("total") / F.col("rest"), "node")).alias("y"))
    alike = most_alike("x", "y") >= SIMILAR - SLACK
    central = bounded.select("key", *_side("x")).join(plainest.select("key", "y.*"), "key").where((F.col("label_x") != F.col("label_y")) & alike)
    known_pairs = checked.select("a", "b")
    central = central.select(*_ordered("node_x", "node_y")).union(sharing).distinct().join(known_pairs, ["a", "b"], "left_anti")
    central = common.stored(central, folder, "central")
    checked2 = common.stored(verified(central, texts), folder, "checked2")
    more = checked2.where(F.col("similarity") >= SIMILAR).select("a", "b")
    label = components(label.select(F.col("node").alias("a"), F.col("label").alias("b")).union(more), folder, "two")

    # Where there are several classes even now: the smaller ones against all others.
    left = _several(bounded.drop("label").join(label, "node", "left").withColumn("label", F.coalesce("label", "node")))
    left = common.stored(left, folder, "left")
    most = left.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("label", "n").alias("main"))
    left = left.join(most, "key")
    outside = left.where("label <> main").select("key", *_side("x"))
    others = left.select("key", "leader", *_side("y"), (F.col("label") == F.col("main")).alias("in_main"))
    second = (
        outside.join(others, "key")
        .where("label_x <> label_y AND node_x <> leader AND node_y <> leader AND (in_main OR node_x < node_y)")
        .where((F.abs(F.col("near_x") - F.col("near_y")) <= 1 - SIMILAR + SLACK) & alike)
        .select(*_ordered("node_x", "node_y")).distinct().join(known_pairs.union(checked2.select("a", "b")), ["a", "b"], "left_anti")
    )
    second = common.stored(second, folder, "second")
    more = common.stored(verified(second, texts), folder, "checked3").where(F.col("similarity") >= SIMILAR).select("a", "b")
    label = components(label.select(F.col("node").alias("a"), F.col("label").alias("b")).union(more), folder, "three")

    # Rows take the label of their text; a text in no group is alone. The class is named by its smallest document.
    place = signed.select("row", "doc_id", "digest").join(member, "row", "left").withColumn("node", F.coalesce("node", "row"))
    found = place.join(label, "node", "left").select("doc_id", "digest", F.coalesce("label", "node").alias("label"))
    found = common.stored(found, folder, "labels")
    least = found.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    return common.stored(found.join(least, "label").select("doc_id", "digest", "class_id"), folder, "classes")


def _rows(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def classes(documents: DataFrame, folder: str) -> DataFrame:
    """``doc_id, class_id`` of every row; the id of a class is its smallest document id.

    Rows with equal texts share a class, the empty text included. A text without a word is near
    nothing else. Rows with a null text are classes of their own, and rows without an id keep a null
    class. Rows that repeat an id are judged each by its own text, so their classes may differ.
    Intermediate tables go to ``folder``, which driver and executors must share.
    """
    rows = _rows(documents)
    known = rows.where("doc_id IS NOT NULL AND text IS NOT NULL")
    rest = rows.where("doc_id IS NULL OR text IS NULL").select("doc_id", F.col("doc_id").alias("class_id"))
    return _class_of_texts(known, folder).select("doc_id", "class_id").union(rest)


def keep_one(documents: DataFrame, folder: str) -> DataFrame:
    """The documents without near copies: of each class, the rows of the smallest id stay.

    Rows without an id or text stay. Rows that repeat an id are judged each by its own text.
    """
    known = _rows(documents).where("doc_id IS NOT NULL AND text IS NOT NULL")
    drop = _class_of_texts(known, folder).where("doc_id <> class_id").select("doc_id", "digest").distinct()
    drop = common.light(common.stored(drop, folder, "drop"), row_bytes=40)
    doc, text = common.fresh(documents, "doc"), common.fresh(documents, "text_digest")
    drop = drop.select(F.col("doc_id").alias(doc), F.col("digest").alias(text))
    same = (F.col("d.doc_id").cast("long") == F.col(f"x.{doc}")) & (digest(F.col("d.text").cast("string")) == F.col(f"x.{text}"))
    return documents.alias("d").join(drop.alias("x"), same, "left_anti")
