"""Line templates: the same at every scale, against a plain tree, and bounds that follow a line's length."""

import random
from collections import defaultdict

import pytest

from vigie.llm import common, line_templates as L, queries

CITIES = ("Lyon", "Paris", "Brest", "Nantes", "Lille", "Nice", "Dijon", "Tours")


@pytest.fixture(scope="module")
def dropped(spark):
    queries.prepare(spark)

    def look(texts, **limits):
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
        return {r["doc_id"]: r["n_dropped"] for r in L.without_recurring(docs, common.shared_folder(spark, "test"), **limits).collect()}

    return look


@pytest.mark.parametrize("n", [200, 6000])
def test_a_template_is_one_at_every_scale(dropped, n):
    names = [f"{a}{b}{c}" for a in "abcde" for b in "aeiou" for c in "lmnoprstv"]
    got = dropped([f"Report was filed by {names[i % 225]} from {CITIES[i % 8]} on the site today" for i in range(n)])
    assert set(got.values()) == {1}


def test_long_lines_recur_sooner(dropped):
    rng = random.Random(3)
    say = lambda n: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(n))
    long, middle, short = say(80), say(25), say(8)
    texts = [f"{say(12)}\n{long}" for _ in range(2)] + [f"{say(12)}\n{middle}" for _ in range(3)] + [f"{say(12)}\n{short}" for _ in range(4)]
    got = dropped(texts + [say(80)])
    assert [got[i] for i in range(10)] == [1] * 5 + [0] * 5


def plain(texts):
    """Templates by a tree that holds everything."""
    leaves = defaultdict(lambda: defaultdict(set))
    for number, text in enumerate(texts):
        for line in text.split("\n"):
            words = tuple("<*>" if any(c in "0123456789" for c in w) else w for w in line.split())
            if words:
                leaves[len(words), words[:L.DEPTH]][words].add(number)
    bad = set()
    for (size, _), lines in leaves.items():
        least = next((d for w, d in L.FEWER if size >= w), L.LEAST_DOCUMENTS)
        in_leaf = len(set().union(*lines.values()))
        counts = defaultdict(int)
        for words, docs in lines.items():
            for place in enumerate(words):
                counts[place] += len(docs)
        groups = defaultdict(set)
        for words in lines:
            shape = tuple(w if counts[i, w] >= max(least, L.WORD_SHARE * in_leaf) else None for i, w in enumerate(words))
            constants = sum(w is not None for w in shape)
            groups[shape if len(lines) > 1 and constants >= L.CONSTANT_SHARE * size else (words,)].add(words)
        for members in groups.values():
            if len(set().union(*(lines[w] for w in members))) >= least:
                bad |= members
    found = {}
    for number, text in enumerate(texts):
        masked = [tuple("<*>" if any(c in "0123456789" for c in w) else w for w in line.split()) for line in text.split("\n")]
        found[number] = sum(w in bad for w in masked)
    return found


def test_equal_to_a_plain_tree(spark, sf_dir, dropped):
    texts = [r["text"] for r in queries.documents(spark, sf_dir).where("text IS NOT NULL").collect()]
    texts = [" ".join(t.split("\r")) for t in texts if t.isascii()]
    rng = random.Random(8)
    texts += [f"Seen by {rng.choice(CITIES)} {rng.choice('xyz')} at {i} in the {rng.choice(('old', 'new'))} port {rng.choice(CITIES)}\n{t[:300]}" for i, t in enumerate(texts[:60])]
    want = plain(texts)
    assert dropped(texts) == want and any(want.values())
