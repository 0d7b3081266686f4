"""Decontamination: edited, numeric and short items, ids of any kind, and recall against a plain search."""

import random

import pytest

from vigie.llm import common, decontaminate, queries

LONG = "the old harbour master counted every boat that left before dawn and wrote the sum into his blue book"
TWICE = "we saw 12 red cars near the bridge and later on the very same day 12 blue cars left the town again"
NUMBERS = "12 km 30 km 45 km 60 km 75 km 90 km 120 km 150 km"
QUESTION = "Who was the author?"
SUM = "What is 12 * 7?"
TEN = "name all rivers that cross the border of the country"


@pytest.fixture(scope="module")
def held(spark):
    queries.prepare(spark)

    def look(texts, items, **how):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
        bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
        found = decontaminate.contaminated(docs, bench, common.shared_folder(spark, "test"), **how).collect()
        return {(r["doc_id"], r["item_id"]): r["changed"] for r in found}

    return look


def test_edited_copies_are_found(held):
    words = LONG.split()
    texts = [
        " ".join(["so", *words[:9], "small", *words[9:], "and", "more"]),  # a word put in
        " ".join([*words[:9], *words[10:]]),  # and one left out
        f"{LONG[:20]} nothing else",
        TWICE.replace("12 blue", "15 blue"),  # one of two equal numbers changed
        TWICE.replace("12", "15"),
        f"a list: {NUMBERS} was given",
        NUMBERS.replace("45", "46").replace("90", "91"),
    ]
    assert held(texts, [LONG, TWICE, NUMBERS]) == {(0, 0): False, (1, 0): False, (3, 1): True, (4, 1): True, (5, 2): False}


def test_short_items_are_met_whole(held):
    texts = [
        "we ask what is 99 * 3 and go on", "Nobody knew who was the author of that long letter",
        'Then they asked: "who was the author?" and left.', f"A test.\n{SUM}\nAn answer.", f"please {TEN} in order",
        "name all lakes that cross the border of the country", "", "?",
    ]
    assert held(texts, [QUESTION, SUM, TEN, "", "  ", None]) == {(2, 0): False, (3, 1): False, (4, 2): False}


def test_ids_of_any_kind_and_rows_by_their_own_text(spark):
    queries.prepare(spark)
    rows = [("a", LONG, 1), ("a", "clean text here", 2), (None, f"x {LONG} y", 3), (None, None, 4), ("b", "", 5)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, digest int")
    bench = spark.createDataFrame([("q", LONG), (None, "clean text here")], "item_id string, text string")
    folder = lambda: common.shared_folder(spark, "test")
    assert [tuple(r)[:2] for r in decontaminate.contaminated(docs, bench, folder()).collect()] == [("a", "q")]
    kept = decontaminate.without_benchmark(docs, bench, folder())
    assert kept.columns == docs.columns and sorted(r["digest"] for r in kept.collect()) == [2, 4, 5]
    assert decontaminate.without_benchmark(docs, bench.limit(0), folder()).count() == len(rows)


def test_recall_against_a_plain_search(held):
    """Every item in documents with 1 of 25 words changed, left out or put in, and clean documents beside them."""
    rng = random.Random(5)
    words = [a + b + c for a in ("ba", "lo", "mi", "tra", "ver", "qu") for b in ("na", "ri", "so", "tu") for c in ("m", "l", "ren", "d", "x")]
    say = lambda n: rng.choices(words, k=n)
    items = [say(rng.randrange(15, 60)) for _ in range(60)]
    texts, wanted = [], set()
    for number, item in enumerate(items):
        for _ in range(3):
            copy = list(item)
            for _ in range(max(1, len(item) // 25)):
                at = rng.randrange(len(copy))
                copy[at:at + 1] = rng.choice([[rng.choice(words)], [], [copy[at], rng.choice(words)]])
            wanted.add((len(texts), number))
            texts.append(" ".join(say(40) + copy + say(40)))
    clean = [" ".join(say(150)) for _ in range(200)]
    got = set(held(texts + clean, [" ".join(i) for i in items]))
    assert got <= wanted
    assert len(got) >= 0.9 * len(wanted)
    # Unchanged items are found by every plain search of the words, and by this one.
    plain = {(d, i) for d, t in enumerate(texts + clean) for i, item in enumerate(items) if f" {' '.join(item)} " in f" {t} "}
    assert plain <= got
