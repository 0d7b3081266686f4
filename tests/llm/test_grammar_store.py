"""Pair grammars: equal runs, repeated passages, large vocabularies, and ranges read from stored blocks."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from vigie.llm import common, grammar_store as G, queries

RNG = random.Random(4)
PASSAGE = RNG.choices(range(5000), k=500)


@pytest.mark.parametrize("ids, most", [
    ([7] * 10_000, 40), ([7] * 9_999 + [1], 40), ([1, 2] * 10_000, 40), (PASSAGE * 400, 60), ([], 0), ([5], 1), ([5, 5, 5], 3),
    ([x for i in range(400) for x in [i, *PASSAGE]], 1000),
])
def test_what_repeats_becomes_rules(ids, most):
    plain = np.array(ids, np.uint32)
    seq, lefts, rights, lengths = G.compress(plain)
    assert len(seq) <= most
    assert (G.expand(seq, lefts, rights) == plain).all()
    left_pairs = list(zip(seq.tolist(), seq[1:].tolist()))
    assert all(left_pairs.count(p) < 2 * G.LEAST_PAIRS for p in set(left_pairs))
    for _ in range(5):
        a, b = sorted(RNG.choices(range(len(ids) + 1), k=2))
        assert (G.expand_range(seq, lefts, rights, lengths, a, b) == plain[a:b]).all()


def test_vocabularies_of_any_size():
    plain = np.array(RNG.choices([3, 65_536, 70_000, 199_999], k=20_000), np.uint32)
    seq, lefts, rights, lengths = G.compress(plain, 200_000)
    assert len(seq) < len(plain) and (G.expand(seq, lefts, rights, 200_000) == plain).all()
    assert (G.expand_range(seq, lefts, rights, lengths, 777, 9_999, 200_000) == plain[777:9_999]).all()


def test_ranges_of_stored_documents(spark, sf_dir):
    """Each document's ids from its block by expanding its own range, beside those of the whole block."""
    path, folder = public_tokenizers.path("byte_bpe_50k.json"), common.shared_folder(spark, "test")
    G.write_store(queries.documents(spark, sf_dir), path, folder)
    whole = {r["doc_id"]: r["ids"] for r in G.read_store(spark, folder, with_ids=True).collect()}
    for block in spark.read.schema(G.BLOCKS).parquet(folder).collect():
        parts = [np.frombuffer(block[n], "<u4") for n in ("ids", "lefts", "rights", "lengths")]
        for doc_id, start, stop in list(zip(block["doc_ids"], [0, *block["ends"]], block["ends"]))[::7]:
            assert G.expand_range(*parts, start, stop, block["base"]).tolist() == whole[doc_id]


def test_encoder_remembers_little():
    """What a worker remembers of new chunks stays small, with the same ids as the library's."""
    encoder = G.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert encoder.chunks.most <= 100_000
    small = G.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 50)
    for _ in range(40):
        text = " ".join("".join(RNG.choices("abcdeé", k=RNG.randint(1, 9))) for _ in range(60))
        want = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(small.of(text), "<u4").tolist() == want and small.of(text) == encoder.of(text)
    assert len(small.chunks.new) + len(small.chunks.old) < 4 * 120


@pytest.mark.parametrize("ids", [RNG.choices(range(k), k=4000) for k in (1, 2, 3, 6)] + [sorted(RNG.choices(range(40), k=4000))])
def test_pairs_that_become_frequent_are_found(ids):
    """No pair is frequent when compression ends, also beside nonterminals of later rounds."""
    seq, lefts, rights, _ = G.compress(np.array(ids, np.uint32))
    assert (G.expand(seq, lefts, rights) == np.array(ids)).all()
    pairs = list(zip(seq.tolist(), seq[1:].tolist()))
    assert all(pairs.count(p) < 2 * G.LEAST_PAIRS for p in set(pairs))


def test_words_are_solved_once_in_many_texts():
    """Words that come again are encoded once, whatever marks follow them and however many words come once between."""
    encoder, solved = G.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 400), []
    encoder.chunks.solve = lambda new, solve=encoder.chunks.solve: solved.extend(new) or solve(new)
    common_words = ["".join(RNG.choices("abcde", k=7)) for _ in range(100)]
    for step in range(12):
        texts = []
        for _ in range(4):
            once = ["".join(RNG.choices("vwxyz", k=12)) for _ in range(60)]
            texts.append("".join(f" {w}{RNG.choice(['', ',', '.', '!!'])}" for w in [*common_words, *once]))
        want = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert [np.frombuffer(x, "<u4").tolist() for x in encoder.of_many(pa.array(texts))] == [e.ids for e in want]
    assert max(solved.count(f" {w}") for w in common_words) == 1 and not any(w.endswith((",", ".", "!")) for w in solved)
    assert len(encoder.chunks.once) + len(encoder.chunks.once_before) < 4 * 700


def test_texts_of_any_white_space_and_marks():
    """Whole texts cut at blanks have the ids of the library, with white space, special tokens and letters of any kind."""
    encoder = G.Encoder(public_tokenizers.path("byte_bpe_50k.json"), 50)
    parts = [*"    \n\t\r\xa0　\x85\x1caZé'’1½.ª漢", "  ", "'s", "'ll", "!!", "<|endoftext|>", "<|", "|>", "\U0001f600", "é", "the", "\x00", "​"]
    texts = ["", None, " ", "a ", "a  ", " \n", "\n ", "a \n b", "a\n \nb", *("".join(RNG.choices(parts, k=RNG.randint(0, 25))) for _ in range(4000))]
    want = [e.ids for e in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.of_many(pa.array(texts))] == want
    assert list(encoder.of_many(pa.array(texts).slice(9, 50))) == list(encoder.of_many(pa.array(texts)))[9:59]
