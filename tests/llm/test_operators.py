"""The text operators against plain versions and on odd rows."""

import math
import random
import textwrap
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from checks.compare import difference, duck
from vigie.llm import common, decontaminate, grammar_store, licenses, line_templates, mix, near_dups, oracles, preference, quality, queries, token_counts, toxicity

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, words string"
ODD = [
    (1, None, None, None, None, 5, "x"), (2, "", "en", "", 0, None, None), (3, "   \n\t", "en", "b", 5, 1, None),
    (4, "one", None, "b", 3, 1, None), (None, "no id at all here for this row", "en", "b", 1, 1, None),
    (5, "same text in two rows of the table " * 3, "en", None, 1, 1, None), (5, "same text in two rows of the table " * 3, "en", None, 1, 1, None),
    (6, "word " * 30_000, "en", "é", 1, 1, None), (7, "x" * 50_000, "en", "é", 1, 1, None),
]


@pytest.fixture(scope="module")
def odd(spark):
    queries.prepare(spark)
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    queries.prepare(spark)
    return spark.createDataFrame([], SCHEMA)


@pytest.mark.parametrize("name", sorted(oracles.ORACLES))
def test_sql_agrees(spark, sf_dir, name):
    assert difference(queries.QUERIES[name](spark, sf_dir), duck(sf_dir), oracles.ORACLES[name]) is None


def test_mix_of_odd_rows(spark, odd, nothing):
    rows = mix.plan(odd).collect()
    assert len(rows) == len(ODD)
    assert all(r["copies"] * r["size"] <= 2 * r["size"] for r in rows)
    assert mix.emit(mix.plan(odd)).count() == sum(r["copies"] for r in rows)
    assert mix.plan(nothing).count() == 0


def test_quality_of_odd_rows(odd, nothing):
    got = {r["doc_id"]: r for r in quality.measure(odd).collect()}
    assert not got[1]["kept"] and got[1]["clean_text"] is None and got[6]["n_repeat_words"] == 30_000
    assert quality.measure(nothing).count() == 0 and quality.clean(odd).columns == odd.columns


def test_token_counts_equal_the_library_at_every_prefix(odd, nothing):
    path = public_tokenizers.path("word_bpe_49k.json")
    counter = token_counts.PrefixCounter(path)
    encode = lambda t: len(counter.tokenizer.encode(t, add_special_tokens=False).ids)
    texts = ["don't we'll 're r", "x<|endoftext|>y <|startoftext|", "İstanbul ΣΑΣ ſ ﬁ ①日本語123", " \xa0 a\x1cb  ", "'s'll!!", "", "aaaaaaa" * 20]
    for text in texts:
        n, steps = counter.of(text)
        assert n == encode(text)
        plain = counter.tokenizer.normalizer.normalize_str(text)
        counts = token_counts.prefix_counts(steps)
        assert len(counts) == len(plain) + 1
        if "<|" not in text:
            assert counts.tolist() == [encode(plain[:k]) for k in range(len(plain) + 1)]
            assert token_counts.longest_prefix(steps, 2) == max(k for k in range(len(plain) + 1) if encode(plain[:k]) <= 2)
    got = token_counts.token_counts(odd, path).collect()
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == Counter((i, encode(t or "")) for i, t, *_ in ODD)
    assert token_counts.token_counts(nothing, path).count() == 0


def test_store_round_trip(spark, odd, nothing):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    folder = common.shared_folder(spark, "test")
    grammar_store.write_store(odd, path, folder)
    got = grammar_store.read_store(spark, folder, with_ids=True).collect()
    start = 0
    for row, (doc_id, text, *_) in zip(sorted(got, key=lambda r: r["start"]), sorted(ODD, key=lambda r: r[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert (row["doc_id"], row["start"], row["ids"]) == (doc_id, start, ids)
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    empty = common.shared_folder(spark, "test")
    grammar_store.write_store(nothing, path, empty)
    assert grammar_store.read_store(spark, empty).count() == 0


def test_grammar_ranges():
    ids = np.array(random.Random(1).choices(range(6), k=5000), np.uint32)
    seq, lefts, rights, lengths = grammar_store.compress(ids)
    assert len(seq) < len(ids) and (grammar_store.expand(seq, lefts, rights) == ids).all()
    for a, b in ((0, 1), (17, 400), (4990, 5000), (5, 5)):
        assert (grammar_store.expand_range(seq, lefts, rights, lengths, a, b) == ids[a:b]).all()


def _windows(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def test_near_dups_equal_all_pairs(spark, sf_dir):
    docs = queries.documents(spark, sf_dir)
    got = {r["doc_id"]: r["class_id"] for r in near_dups.classes(docs, common.shared_folder(spark, "test")).collect()}
    rows = [(r["doc_id"], _windows(r["text"])) for r in docs.collect()]
    least = {i: i for i, _ in rows}
    links = [(i, j) for k, (i, a) in enumerate(rows) for j, b in rows[:k] if a and b and len(a & b) >= 0.8 * len(a | b)]
    for _ in rows:
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
    assert got == least


def test_near_dups_of_odd_rows(spark, odd, nothing):
    got = near_dups.classes(odd, common.shared_folder(spark, "test")).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == Counter((i, i) for i, *_ in ODD)
    assert near_dups.classes(nothing, common.shared_folder(spark, "test")).count() == 0
    assert near_dups.keep_one(odd, common.shared_folder(spark, "test")).columns == odd.columns


def test_near_dups_of_repeated_ids(spark):
    """An id with two texts is two rows, each with the class of its own text."""
    a, b, c = (" ".join(f"{x}{i * 7 % 41}" for i in range(60)) for x in "abc")
    near = b + " tail"
    docs = spark.createDataFrame([(1, a, 1), (2, a, 2), (2, b, 3), (3, near, 4), (3, near, 5), (4, c, 6), (4, c, 7), (5, None, 8), (None, a, 9)], "doc_id long, text string, doc int")
    got = near_dups.classes(docs, common.shared_folder(spark, "test")).collect()
    assert Counter((r["doc_id"], r["class_id"]) for r in got) == Counter({(1, 1): 1, (2, 1): 1, (2, 2): 1, (3, 2): 2, (4, 4): 2, (5, 5): 1, (None, None): 1})
    kept = near_dups.keep_one(docs.repartition(4), common.shared_folder(spark, "test"))
    assert kept.columns == docs.columns and {r["doc"] for r in kept.collect()} == {1, 3, 6, 7, 8, 9}


def _weights(text):
    counts = Counter(tuple(w[i:i + 5]) for w in [text.lower().split()] for i in range(max(len(w) - 4, 0)))
    return {x: 1 + math.log(n) for x, n in counts.items()}


def _likeness(a, b):
    """Probability Jaccard by its definition."""
    return sum(1 / sum(max(a.get(y, 0) / a[x], b.get(y, 0) / b[x]) for y in a.keys() | b.keys()) for x in a.keys() & b.keys())


def test_similarity_of_weighted_windows_is_that_of_the_definition():
    rng = random.Random(5)
    for _ in range(60):
        words = [rng.choice("abcdef") for _ in range(rng.randrange(6, 60))]
        other = list(words)
        for _ in range(rng.randrange(4)):
            other[rng.randrange(len(other))] = rng.choice("abcxyz")
        value, text, weight = near_dups._weighted([" ".join(words), " ".join(other)])
        cut = np.searchsorted(text, [0, 1, 2])
        sets = [(value[i:j], weight[i:j]) for i, j in zip(cut, cut[1:])]
        assert math.isclose(near_dups.similarity(*sets), _likeness(_weights(" ".join(words)), _weights(" ".join(other))), abs_tol=1e-9)


def test_benchmark_asked_with_other_numbers(spark, odd, nothing):
    item = "In a small town Maria bought 12 apples and 30 pears for 7 dollars on a sunny morning in the old market"
    bench = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "before. " + item + " after"), (2, item.replace("12", "15").replace("Maria", "Clara")),
        (3, item.lower()), (4, "A text on something else altogether that shares no more than a few words with any item"), (5, None),
    ], "doc_id long, text string")
    got = {r["doc_id"]: r["changed"] for r in decontaminate.contaminated(docs, bench, common.shared_folder(spark, "test")).collect()}
    assert got == {1: False, 2: True, 3: False}
    twice = "we saw 12 red cars and then 12 blue cars and after that again 12 green cars on the road"
    wrong = twice.replace("12", "14", 1)  # one value of the item for two of the text
    docs = spark.createDataFrame([(1, wrong), (2, twice.replace("12", "14"))], "doc_id long, text string")
    bench = spark.createDataFrame([(1, twice)], "item_id long, text string")
    got = {r["doc_id"] for r in decontaminate.contaminated(docs, bench, common.shared_folder(spark, "test"), least_share=0.9, least_windows=100).collect()}
    assert got == {2}
    assert decontaminate.without_benchmark(odd, bench, common.shared_folder(spark, "test")).count() == len(ODD)
    assert decontaminate.without_benchmark(nothing, bench, common.shared_folder(spark, "test")).count() == 0


def test_toxicity_folds_and_spares(spark, odd, nothing):
    lexicon = toxicity.Lexicon({"moron": 6.0, "clown": 6.0}, 4.0, -4.0)
    matcher = lexicon.matcher()
    assert all(lexicon.rate(matcher, t) > 0 for t in ("you m0ron", "a сlоwn", "C1OWN!", "morons all"))
    assert all(lexicon.rate(matcher, t) == 0 for t in ("a clown fish swims", "oxymoron", "", "fine words"))
    assert lexicon.rate(matcher, "moron " + "fine words " * 500) < lexicon.rate(matcher, "moron fine words")
    assert toxicity.score(odd, lexicon).count() == len(ODD) and toxicity.score(nothing, lexicon).count() == 0


def test_toxicity_on_held_out_rows(spark):
    docs = spark.createDataFrame([(i, f"word{i % 97} plain text number {i * 7 % 1000} " + ("you moron" if i % 4 == 0 else "my friend")) for i in range(800)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 4 = 0 AS int) AS toxic").where("doc_id < 600")
    lexicon = toxicity.learn(docs, labels, common.shared_folder(spark, "test"))
    got = toxicity.score(docs.where("doc_id >= 600"), lexicon).collect()
    assert all(r["predicted"] == (r["doc_id"] % 4 == 0) for r in got)
    again = toxicity.learn(docs.repartition(5), labels.union(labels).repartition(3), common.shared_folder(spark, "test"))
    assert again == lexicon


def test_learning_from_odd_labels(spark, odd, nothing):
    folder = lambda: common.shared_folder(spark, "test")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (5, 1), (5, 1), (6, 0), (None, 1), (7, None), (99, 1)], "doc_id long, toxic int")
    for docs, marks in ((odd, labels), (odd, labels.where("toxic = 1")), (odd, labels.limit(0)), (nothing, labels)):
        lexicon = toxicity.learn(docs, marks, folder())
        assert lexicon.stems == {} and 0 <= float(lexicon.score(np.zeros(1))[0]) <= 1
        assert toxicity.score(odd, lexicon).count() == len(ODD)


def test_licenses_of_odd_rows(spark, odd, nothing):
    docs = spark.createDataFrame([(1, "text\nReleased under the MIT License.\nmore"), (2, "released   UNDER the mit license"), (3, "the MIT campus")], "doc_id long, text string")
    assert {(r["doc_id"], r["license"], r["notices"]) for r in licenses.scan(docs).collect()} == {(1, "MIT", 1), (2, "MIT", 1)}
    assert licenses.scan(odd).count() == 0 and licenses.scan(nothing).count() == 0


def test_licenses_wrapped_and_embedded(spark, odd):
    mit, gpl = licenses.CLAUSES[0][1], licenses.TEMPLATES[5][1]
    wrap = lambda text, width: "\n".join(textwrap.wrap(" ".join(text.split()), width))
    story = " ".join(f"ship{i} left the harbour of the town{i} in the morning" for i in range(60))
    docs = spark.createDataFrame([
        (1, "This library is released under the MIT License. See the file LICENSE."), (2, f"{story}\n{wrap(mit, 80)}\n{story}"),
        (3, f"Copyright (c) A\n{' '.join(mit.split())}"), (4, f"{wrap(gpl, 70)}\nimport os\n{story}\n{wrap(gpl, 60)}"),
        (5, f"{story} {' '.join(licenses.CLAUSES[2][1].split())} {story}"), (6, story), (7, "Released under the MIT License.\n" * 2 + story),
    ], "doc_id long, text string")
    got = {(r["doc_id"], r["license"], r["notices"]) for r in licenses.scan(docs).collect()}
    assert got == {(1, "MIT", 1), (2, "MIT", 1), (3, "MIT", 1), (4, "GPL-3.0", 2), (5, "ISC", 1), (7, "MIT", 2)}


def test_licenses_only_of_parts_with_a_key_word(spark):
    """Parts without a key word are not cut into words, and every part that is alike has one."""
    rng = random.Random(11)
    parts = []
    for _, text in licenses.TEMPLATES * 4:
        words = text.split()
        for _ in range(rng.randrange(len(words) // 6 + 1)):
            words[rng.randrange(len(words))] = rng.choice(["ship", "of", "the", "İstanbul"])
        parts.append(" ".join(words).upper() if rng.random() < 0.5 else " ".join(words))
    docs = spark.createDataFrame(list(enumerate([*parts, "a plain line of the log", None])), "doc_id long, text string")
    found = licenses.scan(docs)
    assert "Contains(part#" in found._jdf.queryExecution().optimizedPlan().toString()
    got = {r["doc_id"]: r["dice"] for r in found.where("notices > 0").collect()}
    want = {}
    for doc_id, part in enumerate(parts):
        own = set(licenses.bigrams_of(part.replace("İ", "i ")))
        sets = [set(licenses.bigrams_of(text)) for _, text in licenses.TEMPLATES]
        if (best := max(2 * len(own & t) / (len(own) + len(t)) for t in sets)) >= licenses.ALIKE:
            want[doc_id] = best
    assert want and {d: got.get(d) for d in want} == pytest.approx(want)


def test_preference_prefix(spark):
    turns = spark.createDataFrame([
        (0, 0, "user", "hi"), (0, 1, "assistant", "good"), (1, 0, "user", "hi"), (1, 1, "assistant", "bad"), (1, 2, "user", None),
        (2, 0, "user", "alone"), (4, 0, "user", "same"), (5, 0, "user", "same"), (5, 0, "user", "same"), (None, 0, "user", "x"), (6, None, "user", "x"),
    ], "conv_id long, turn long, role string, text string")
    got = preference.format_pairs(turns, preference.neighbours(turns)).collect()
    assert sorted((r["pair_id"], r["part"], -1 if r["turn"] is None else r["turn"], r["learned"]) for r in got) == [
        (0, "chosen", 1, True), (0, "prompt", 0, False), (0, "rejected", 1, True), (0, "rejected", 2, False),
        (2, "chosen", -1, False), (2, "prompt", 0, False), (2, "rejected", -1, False)]
    assert preference.format_pairs(turns.limit(0), preference.neighbours(turns.limit(0))).count() == 0


def _sides(turns):
    """Pairs by plain lists: conversation, what is chosen and what is rejected."""
    talks = {}
    for conv, turn, role, text, *_ in turns:
        if conv is not None and turn is not None:
            talks.setdefault(conv, set()).add((turn, role or "", text or ""))
    last = {c: max(a) for c, t in talks.items() if (a := [x for x in t if x[1].lower() == "assistant"])}
    for c in last:
        if c + 1 in last:
            end = last[c][0]
            yield c, {x for x in talks[c] if x[0] <= end}, {x for x in talks[c] if x[0] < end} | {(end, *last[c + 1][1:])}


def test_preference_with_another_answer(spark, nothing):
    """Against plain lists: long talks, equal answers, talks without an answer, ties, repeated rows, marks in texts, null cells."""
    rng = random.Random(3)
    turns = [(c, t, rng.choice(["user", "assistant", "Assistant", "system", None]), rng.choice(["yes", "no", "", None, "a <|end|> b <|turn|>", "ünï" * 400]), 1, "r")
             for c in range(60) for t in range(rng.randrange(6)) for _ in range(rng.choice([1, 1, 1, 2]))]
    turns += turns[:20] + [(None, 0, "user", "x", 1, "r"), (7, None, "assistant", "x", 1, "r"), *((100, t, "assistant", f"t{t}", 1, "r") for t in range(3000)), (101, 0, "assistant", "t2999", 1, "r")]
    given = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string, pair_id int, rendered string").repartition(7)
    got = preference.format_sides(preference.with_other_answer(given)).collect()
    want = []
    for pair, chosen, rejected in _sides(turns):
        differs = min((x[0] for x in chosen ^ rejected), default=10**9)
        want += [(pair, "prompt", *x) for x in chosen | rejected if x[0] < differs]
        for part, side in (("chosen", chosen), ("rejected", rejected)):
            want += [(pair, part, *x) for x in side if x[0] >= differs] or [(pair, part, None, None, None)]
    plain = lambda t: t.replace("<|turn|>", "<| turn|>").replace("<|end|>", "<| end|>")
    want = Counter((p, part, t, r, "" if t is None else f"<|turn|>{r}\n{plain(x)}<|end|>\n") for p, part, t, r, x in want)
    assert Counter((r["pair_id"], r["part"], r["turn"], r["role"], r["rendered"]) for r in got) == want
    for r in got:
        mask = r["rendered"][r["learn_from"]:r["learn_to"]]
        assert r["learned"] == (r["part"] != "prompt" and (r["role"] or "").lower() == "assistant")
        assert mask == (r["rendered"].split("\n", 1)[1][:-1] if r["learned"] else "")
    assert {r["turn"] for r in got if r["pair_id"] == 100} == {*range(3000), None}
    assert preference.format_sides(preference.with_other_answer(given.limit(0))).count() == 0


def test_registered_preference_pairs_share_prompts(spark, sf_dir):
    parts = Counter(r["part"] for r in queries.QUERIES["op8_preference"](spark, sf_dir).select("part").collect())
    assert min(parts[p] for p in ("prompt", "chosen", "rejected")) > 0


def test_line_templates(spark, odd, nothing):
    docs = spark.createDataFrame(
        [(i, f"own line {chr(97 + i)}{chr(98 + i)} of this text only\nPosted on day {i} by user name{i} at the site\nAll rights are with us") for i in range(6)]
        + [(9, "a single own line with other words")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in line_templates.without_recurring(docs, common.shared_folder(spark, "test"), constant_share=0.9).collect()}
    assert all(got[i]["n_dropped"] == 2 and got[i]["clean_text"].startswith("own line") for i in range(6)) and got[9]["n_dropped"] == 0
    assert line_templates.without_recurring(odd, common.shared_folder(spark, "test")).count() == len(ODD)
    assert odd.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert line_templates.without_recurring(nothing, common.shared_folder(spark, "test")).count() == 0


def test_line_templates_beyond_the_bound(spark, odd, sf_dir, monkeypatch):
    docs = common.read(spark, sf_dir, "documents").unionByName(odd, allowMissingColumns=True)
    few = sorted(map(repr, line_templates.without_recurring(docs, common.shared_folder(spark, "test")).collect()))
    monkeypatch.setattr(common, "small_enough", lambda rows, row_bytes: False)
    many = sorted(map(repr, line_templates.without_recurring(docs, common.shared_folder(spark, "test")).collect()))
    assert few == many
