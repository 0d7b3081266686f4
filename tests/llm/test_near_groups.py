"""Large groups of near copies: every link is kept, and few pairs are compared."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigie.llm import common, near_dups


def _own(texts):
    value, text, weight = near_dups._weighted(texts)
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    return [(value[a:b], weight[a:b]) for a, b in zip(cut, cut[1:])]


def _labels(n, links):
    label = list(range(n))
    for a, b in links:
        low, high = sorted((label[a], label[b]))
        label = [low if x == high else x for x in label]
    return label


@pytest.mark.parametrize("vocabulary, most", [(5000, 14), (12, 14)])
def test_group_of_near_copies(spark, vocabulary, most):
    """Copies with up to 14 edited words, from a large vocabulary and from one so small that copies share edits."""
    rng = random.Random(7)
    text = [f"w{rng.randrange(300)}" for _ in range(150)]
    copies = []
    for _ in range(300):
        words = list(text)
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(vocabulary)}"
        copies.append(" ".join(words[:len(words) - rng.choice([0, 0, 0, 12])]))
    copies = list(dict.fromkeys(copies))
    own = _own(copies)
    links = [(a, b) for a, b in itertools.combinations(range(len(own)), 2) if near_dups.similarity(own[a], own[b]) >= near_dups.SIMILAR]
    folder = common.shared_folder(spark, "test")
    docs = spark.createDataFrame(list(enumerate(copies)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["class_id"] for r in near_dups.classes(docs, folder).collect()}
    assert [got[i] for i in range(len(copies))] == _labels(len(copies), links)
    compared = spark.read.parquet(f"{folder}/checked*").count()
    if vocabulary == 5000:
        assert compared < 12 * len(copies)  # of 150 a copy


def test_bound_of_texts_without_a_rare_window_in_common(spark):
    """Never below the similarity, with repeated windows and texts of different lengths; exact for an edited copy."""
    rng = random.Random(11)
    rows, plain = [], [f"c{i}" for i in range(100)]
    for n in range(300):
        words = [rng.choice("abcdef") for _ in range(rng.randrange(8, 60))] if n % 2 else list(plain)
        other = list(words[:rng.randrange(6, len(words) + 1)])
        for some, mark in ((words, "x"), (other, "y")):
            for k in range(rng.randrange(4)):
                some[rng.randrange(len(some))] = f"{mark}{k}"
        a, b = _own([" ".join(words), " ".join(other)])
        shared = np.intersect1d(a[0], b[0])
        if len(shared):
            sides = [(float(w.sum()), float(w[np.isin(v, shared)].sum()), float(w.max())) for v, w in (a, b)]
            rows.append((near_dups.similarity(a, b), *sides[0], *sides[1]))
    names = "similarity, total_x, rest_x, heaviest_x, total_y, rest_y, heaviest_y".split(", ")
    found = spark.createDataFrame(rows, [*names]).withColumn("most", near_dups.most_alike("x", "y"))
    assert len(rows) > 250 and found.where(F.col("similarity") > F.col("most") + 1e-9).count() == 0
    edited = spark.createDataFrame([(100.0, 90.0, 1.0, 100.0, 90.0, 1.0)], names[1:])
    assert abs(edited.select(near_dups.most_alike("x", "y")).first()[0] - 90 / 110) < 1e-12
