"""Every stage of the corpus pipeline on odd, repeated and empty rows, and their decisions on made documents."""

import random

import pytest

import corpus_pipeline
from vigie.llm import common, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentences(seed, n):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in ("ba", "lo", "mi", "tra", "ver") for b in ("na", "ri", "so", "tu") for c in ("m", "l", "ren", "d")]
    return " ".join(" ".join(rng.choices(words, k=9)).capitalize() + "." for _ in range(n))


@pytest.fixture(scope="module")
def bench(spark, tmp_path_factory):
    queries.prepare(spark)
    folder = f"file://{tmp_path_factory.mktemp('pipeline')}"
    spark.createDataFrame([(1, sentences(77, 4)), (2, None), (None, "x")], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def through(spark, docs, folder):
    """What each stage returns, each written and read again."""
    out = {}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = common.stored(stage(spark, docs, folder), common.shared_folder(spark, "test"), str(number))
        out[name] = docs
    return out


ODD = [
    (1001, None, None, None, None), (1002, "", "en", "", 0), (1003, "  \n\t", "en", "b", 4), (None, sentences(1, 12), "en", "b", 1),
    (1004, sentences(2, 12), None, None, None), (1005, sentences(3, 12), "en", "b", 1), (1005, sentences(3, 12), "en", "b", 1),
    (1006, sentences(4, 3000), "en", "é", 1), (1007, "x" * 40_000, "en", "é", 1),
]


def test_decisions_take_effect_beside_odd_rows(spark, bench):
    clean = [(i, sentences(100 + i, 14), "en", "abc"[i % 3], 0) for i in range(30)]
    copy = [(40, clean[0][1] + " Ending here.", "en", "a", 0), (41, clean[1][1], "en", "b", 0)]
    leaked = [(50, f"{sentences(200, 8)} {sentences(77, 4)} {sentences(201, 8)}", "en", "a", 0)]
    junk = [(60, "### $$$ %%% " * 40, "en", "a", 0), (61, "too short", "en", "a", 0)]
    docs = spark.createDataFrame([*clean, *copy, *leaked, *junk, *ODD], SCHEMA)
    found = through(spark, docs, bench)
    ids = {name: {r["doc_id"] for r in df.select("doc_id").collect()} for name, df in found.items()}
    every, others = {r[0] for r in clean}, {None, 1004, 1005, 1006}
    assert ids["quality rules"] - {1007} == every | others | {40, 41, 50}
    assert ids["near-dedup"] - {1007} == every | others | {50}
    assert ids["decontamination"] - {1007} == every | others
    sizes = {r["doc_id"]: r["n_chars"] for r in found["quality rules"].collect()}
    assert all(sizes[i] == len(text) for i, text, *_ in clean)
    assert all(found[n].columns == docs.columns for n, _ in corpus_pipeline.STAGES[:-1])
    assert found["token output"].count() == found["mixing"].count() and ids["mixing"] <= ids["decontamination"]


def test_empty_table(spark, bench):
    found = through(spark, spark.createDataFrame([], SCHEMA), bench)
    assert all(df.count() == 0 for df in found.values())
