"""Secret scan, hard negatives and tokenizer alignment against plain versions and on odd rows."""

import base64
import hashlib
import json
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from vigie.llm import alignment, common, hard_negatives, queries, secrets
from vigie.llm.chunks import kept
from vigie.llm.perfect_hash import PerfectHash

SCHEMA = "doc_id long, text string, lang string, secrets string, pairs string, size long"
ODD = [
    (1, None, None, None, None, 5), (2, "", "en", "", "x", None), (3, "   \n\t", "en", "b", None, 1), (4, "one", None, "b", None, 1),
    (None, "no id at all here for this row", "en", "b", None, 1), (5, "token = abcdefghijklmnop twice", "en", None, None, 1),
    (5, "token = abcdefghijklmnop twice", "en", None, None, 1), (6, "word " * 20_000, "en", "é", None, 1), (7, "x" * 50_000, "en", "é", None, 1),
    (8, "a▁b", "en", None, None, 1), (9, " lead\n\ntwo  gaps odd line\ttab \n end ", "fr", None, None, 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    queries.prepare(spark)
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    queries.prepare(spark)
    return spark.createDataFrame([], SCHEMA)


# --- secrets ----------------------------------------------------------------
def _number(n: int) -> bytes:
    body = n.to_bytes(n.bit_length() // 8 + 1, "big")
    return _tlv(2, body)


def _tlv(tag: int, body: bytes) -> bytes:
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


P, Q = (1 << 521) - 1, (1 << 607) - 1  # two Mersenne primes
RSA = _tlv(0x30, b"".join(_number(n) for n in (0, P * Q, 65537, 3**300, P, Q, 5, 7, 11)))
PKCS8 = _tlv(0x30, _number(0) + _tlv(0x30, _tlv(6, bytes.fromhex("2a864886f70d010101")) + b"\x05\x00") + _tlv(4, RSA))
EC = _tlv(0x30, _number(1) + _tlv(4, bytes(range(32))) + _tlv(0xA0, _tlv(6, bytes.fromhex("2a8648ce3d030107"))))


def _string(body: bytes) -> bytes:
    return len(body).to_bytes(4, "big") + body


OPENSSH = b"openssh-key-v1\0" + _string(b"none") * 2 + _string(b"") + (1).to_bytes(4, "big") + _string(b"public" * 9) + _string(b"private" * 30)


def _url(data: bytes) -> str:
    return base64.urlsafe_b64encode(data).decode().rstrip("=")


def _token(header=None, payload=None, signature=b"s" * 32) -> str:
    return ".".join([_url(json.dumps(header or {"alg": "HS256"}).encode()), _url(json.dumps(payload or {"sub": 1}).encode()), _url(signature)])


def _armoured(data: bytes, name: str = "RSA ") -> str:
    body = base64.encodebytes(data).decode()
    return f"-----BEGIN {name}PRIVATE KEY-----\n{body}-----END {name}PRIVATE KEY-----"


CONFIRMED = [
    (RSA, "rsa"), (PKCS8, "pkcs8"), (EC, "ec"), (OPENSSH, "openssh"),
]


@pytest.mark.parametrize("data,form", CONFIRMED)
def test_keys_are_confirmed_in_every_writing(data, form):
    assert secrets.key_form(data) == (form, len(data))
    for text, kind in ((_armoured(data), "armour"), (base64.b64encode(data).decode(), "key"), (_url(data), "key"), (data.hex(), "hexkey")):
        found = [(secrets.KINDS[k], a, b, f) for a, k, b, f in secrets.spans_of(f"é before {text} after") if k > 2]
        end = 9 + len(text.rstrip("=") if kind == "key" and not data.startswith(b"openssh") else text)
        assert [(k, a, f) for k, a, _, f in found] == [(kind, 9, form)] and abs(found[0][2] - end) <= 2


def test_broken_structure_is_not_reported():
    for data, _ in CONFIRMED:
        cut = data[:-3]
        assert secrets.key_form(cut) is None
        assert not [s for s in secrets.spans_of(f"{_armoured(cut)} {_url(cut)}") if s[1] > 2]
    wrong = bytearray(RSA)
    wrong[40] ^= 1  # the modulus is no longer the product
    assert secrets.key_form(bytes(wrong)) is None
    assert not secrets.spans_of("z" * 300 + " " + "Zm9v" * 100 + " /usr/share/lib/python/site/packages/module/file/name/that/is/long/enough")


def test_nested_lengths_bound_a_key_inside_a_longer_run():
    run = base64.b64encode(EC + b"tail of the run" * 5).decode()
    (start, kind, end, form), = [s for s in secrets.spans_of(run) if s[1] > 2]
    assert (start, secrets.KINDS[kind], form) == (0, "key", "ec") and end == -(-len(EC) * 8 // 6)


def test_signed_tokens():
    good = _token()
    assert [(a, secrets.KINDS[k], b, f) for a, k, b, f in secrets.spans_of(f"x {good} y")] == [(2, "token", 2 + len(good), "HS256")]
    for bad in (_token(signature=b"short"), _token({"typ": "x"}), good.replace(".", ":"), _token({"alg": "none"}, signature=b""), good[:12] + "!" + good[12:]):
        assert not [s for s in secrets.spans_of(bad) if s[1] == 3]
    twice = base64.b64encode(f"export T={good}\n".encode()).decode()
    assert [f for _, k, _, f in secrets.spans_of(twice) if k == 5] == ["nested HS256"]


def _plain_base(text):
    """The three patterns as written, sizes checked afterwards."""
    found = []
    for kind, pattern, size in (
        (0, r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 12),
        (1, r"AKIA[A-Z0-9]+", 18), (2, r"[0-9a-f]+", 16),
    ):
        for m in re.finditer(pattern, text):
            if len(m.group(2 if kind == 0 else 0)) >= size:
                found.append((m.start(), kind, m.end()))
    return sorted(found)


def test_base_spans_equal_the_written_patterns(spark, sf_dir):
    rng = random.Random(3)
    parts = ["token", "Secret", "api_key", "PASSWD", "=", ":", " ", '"', "'", "AKIA", "AKIAB1", "abcdef012345", "0f" * 9, "\n", "é", "ſecret", "x.y-z_", "AKIA" * 5]
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 40))) for _ in range(3000)]
    texts += [r["text"] or "" for r in common.read(spark, sf_dir, "documents").collect()]
    for text in texts:
        assert [s[:3] for s in secrets.spans_of(text) if s[1] < 3] == _plain_base(text)


def test_query_and_odd_rows(spark, sf_dir, odd, nothing):
    got = queries.op11_secrets(spark, sf_dir).collect()
    for row, (doc_id, text) in zip(sorted(got, key=lambda r: r["doc_id"]), sorted((r["doc_id"], r["text"]) for r in common.read(spark, sf_dir, "documents").collect())):
        base = _plain_base(text or "")
        assert row["doc_id"] == doc_id and [row[f"n_{k}"] for k in secrets.BASE] == [sum(s[1] == k for s in base) for k in range(3)]
        listed = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest() and set(listed.split(",")) <= set(row["spans"].split(",")) | {""}
    rows = secrets.scan(odd).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(r[0] for r in ODD)
    assert {r["doc_id"]: len(r["secrets"]) for r in rows}[5] == 1 and secrets.scan(nothing).count() == 0
    covered = {r["doc_id"]: r["text"] for r in secrets.redact(odd).collect()}
    assert covered[5] == "<assign> twice" and covered[1] is None and secrets.redact(odd).columns == odd.columns


# --- hard negatives ---------------------------------------------------------
def _plain_mining(rows, every, n_positives=5, n_negatives=3):
    rows = list({(i, label, tuple(c)) for i, label, c in rows})
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for anchor, label, codes in rows:
        if anchor % every:
            continue
        scored = sorted(((-dot(codes, c), i, own) for i, own, c in rows if i != anchor))
        for negated, positive, _ in [s for s in scored if s[2] == label][:n_positives]:
            score = -negated
            inside = [(-s, i) for s, i, own in scored if own != label and 50 * score <= -100 * s <= 95 * score][:n_negatives]
            out += [(anchor, positive, k + 1, i, score, s) for k, (s, i) in enumerate(inside)]
    return Counter(out)


def _mined(df, every=5):
    found = hard_negatives.mine(df, df["vec_id"] % every == 0, common.shared_folder(df.sparkSession, "test")).collect()
    return Counter(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in found)


@pytest.mark.parametrize("block", [7, 4096])
def test_slots_equal_a_search_of_every_window(spark, monkeypatch, block):
    """Many ties and repeated rows, in one cell and in many."""
    queries.prepare(spark)
    monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ROW_BLOCK", block)
    rng = random.Random(block)
    rows = [(i, rng.randint(0, 2), [rng.randint(-3, 4) for _ in range(3)]) for i in range(120)]
    rows += rows[:10] + [(3, 1, [1, 1, 1]), (5, 0, [2, 2, 2]), (200, 9, [1, 0, 0]), (201, 0, []), (202, 0, [4]), (205, 1, [1, 2, 3, 4])]
    got, want = _mined(spark.createDataFrame(rows, "vec_id long, label long, codes array<long>")), _plain_mining(rows, 5)
    assert got == want and sum(want.values()) > 100


def test_scores_stay_exact():
    rng = np.random.default_rng(1)
    for most in (100, 1 << 30, 1 << 40):
        a, b = rng.integers(-most, most, (4, 16)), rng.integers(-most, most, (6, 16))
        want = [[max(min(sum(x * y for x, y in zip(r.tolist(), s.tolist())), 2**63 - 1), -2**63) for s in b] for r in a]
        assert hard_negatives.exact_scores(a, b).tolist() == want


def test_vectors_that_take_no_part(spark, sf_dir):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, -0.001], 2), (2, [nan, 1.0], 1), (3, [inf, 1.0], 1), (4, None, 1), (5, [1.0, None], 1), (6, [0.5, 1.0], None), (None, [1.0, 1.0], 1), (8, [], 1), (9, [3e38, -3e38], 1)]
    df = spark.createDataFrame([(i, v, k, "x", 1) for i, v, k in rows], "vec_id long, embedding array<float>, label int, codes string, digest int")
    got = {r["vec_id"]: r["codes"] for r in hard_negatives.quantised(df, "embedding").collect()}
    assert got.keys() == {1, 8, 9} and got[1] == [256, -1] and got[8] == []
    _mined(hard_negatives.quantised(df, "embedding"), 1)
    assert _mined(spark.createDataFrame([], "vec_id long, label long, codes array<long>")) == Counter()


# --- alignment --------------------------------------------------------------
PATHS = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]


@pytest.fixture(scope="module")
def plain():
    """Both libraries on whole texts, and every pair of overlapping tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    first, second = Tokenizer.from_file(PATHS[0]), sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    first.encode_special_tokens = True
    letters = {c: b for b, c in enumerate(alignment._byte_letters())}

    def of(text):
        if not text:
            return None
        a, b = first.encode(f" {text}", add_special_tokens=False).ids, second.encode(text)
        bytes_a = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(bytes_a) != f" {text}".encode() or b"".join(bytes_b) != f" {text}".encode():
            return None
        ends_a, ends_b = np.cumsum([len(t) for t in bytes_a]).tolist(), np.cumsum([len(t) for t in bytes_b]).tolist()
        links, j = [], 0
        for i, end in enumerate(ends_a):
            start = end - len(bytes_a[i])
            while ends_b[j] <= start:
                j += 1
            links += [(a[i], b[k]) for k in range(j, len(b)) if ends_b[k] - len(bytes_b[k]) < end]
        common_ends = sorted(set(ends_a) & set(ends_b))
        groups, i, j = [], 0, 0
        for end in common_ends:
            x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(f"{','.join(map(str, a[i:x]))}|{','.join(map(str, b[j:y]))}")
            i, j = x, y
        return a, b, links, groups

    return of


def _plain_measures(texts, plain):
    found = [plain(t) for t in texts]
    count = Counter(pair for f in found if f for pair in set(f[2]))
    most = defaultdict(int)
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    return [
        (len(f[0]), len(f[1]), len(f[3]), len(f[2]), sum(count[p] == most[p[0]] for p in f[2]), sum(count[p] for p in f[2]), hashlib.sha256(";".join(f[3]).encode()).hexdigest())
        if f else (0, 0, 0, 0, 0, 0, "") for f in found
    ]


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("bound", [alignment.TABLE_BYTES, 0])
def test_alignment_equals_whole_texts(spark, sf_dir, odd, plain, monkeypatch, bound):
    """The given documents and odd rows, with counts sent to the tasks and with counts joined, in small shards and branches."""
    monkeypatch.setattr(alignment, "SHARD_PAIRS", 500)
    monkeypatch.setattr(alignment, "BRANCH_ROWS", 20)
    docs = common.read(spark, sf_dir, "documents").limit(60).unionByName(odd.where("length(text) < 40000 OR text IS NULL"), allowMissingColumns=True)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = alignment.align(docs, *PATHS, common.shared_folder(spark, "test"), table_bytes=bound).collect()
    want = _plain_measures([t for _, t in rows], plain)
    assert Counter((r["doc_id"], *(r[n] for n in NAMES)) for r in got) == Counter((i, *m) for (i, _), m in zip(rows, want))


def test_alignment_of_odd_rows(odd, nothing, spark):
    got = alignment.align(odd, *PATHS, common.shared_folder(spark, "test")).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in ODD)
    assert all((r["n_a"], r["groups_sha256"]) == (0, "") for r in got if r["doc_id"] in (1, 2, 8))
    for bound in (alignment.TABLE_BYTES, 0):
        assert alignment.align(nothing, *PATHS, common.shared_folder(spark, "test"), table_bytes=bound).count() == 0


def test_chunks_solved_alone_equal_whole_texts(spark, sf_dir, plain):
    """Random strings of letters, marks, breaks, odd white space and special strings."""
    rng = random.Random(5)
    parts = list("abcdeéßñ中文😀①.,;:'\"$%!-_0123456789") + [" ", "\n", "  ", "\n\n", "\t", " ", " ", "\x1c", "\x85", "​", "'s", "'ll ", "<|endoftext|>", "<s>", "<0x0A>", " the", " Straße", "́", "﻿", "\r\n", "\x00"]
    aligner = kept(alignment.Aligner, *PATHS)
    texts = ["".join(rng.choices(parts, k=rng.randint(1, 25))) for _ in range(4000)]
    texts += [r["text"] for r in common.read(spark, sf_dir, "documents").collect()]
    assert aligner.words_end
    for at in range(0, len(texts), 64):
        some = texts[at:at + 64]
        want = [plain(t) for t in some]
        own = alignment.Aligned(aligner, some)
        assert own.places == [i for i, w in enumerate(want) if w]
        want = [w for w in want if w]
        assert own.a.tolist() == [i for w in want for i in w[0]] and own.b.tolist() == [i for w in want for i in w[1]]
        assert [(p >> 32, p & 0xFFFFFFFF) for p in own.pairs().tolist()] == [p for w in want for p in w[2]]
        assert own.digests() == [hashlib.sha256(";".join(w[3]).encode()).hexdigest() for w in want]


def test_stored_ids_give_the_same_links(spark, sf_dir, odd):
    """The second pass links ids and reads no text."""
    aligner = kept(alignment.Aligner, *PATHS)
    texts = [None, "", *(r["text"] for r in common.read(spark, sf_dir, "documents").limit(80).collect()), "x\ufffdy \n\n z", " ", None]
    own = alignment.Aligned(aligner, texts)
    kinds, rows = [alignment.kind_of(n) for n in (aligner.n_a, aligner.n_b)], [(np.empty(0, "<u2"),) * 2 for _ in texts]
    for place, ids in zip(own.places, own.ids(), strict=True):
        rows[place] = tuple(np.frombuffer(x, k) for x, k in zip(ids, kinds))
    again = alignment.Aligned.of_ids(aligner, rows)
    assert again.places == own.places and (again.pairs() == own.pairs()).all() and again.digests() == own.digests()
    assert all((getattr(again, n) == getattr(own, n)).all() for n in ("links_upto", "a_upto", "b_upto", "group_end"))
    none = alignment.Aligned.of_ids(aligner, [(np.empty(0, "<u2"),) * 2] * 3)
    assert none.places == [] and len(none.pairs()) == 0 and none.digests() == []
    for bound in (alignment.TABLE_BYTES, 0):
        found = alignment.align(odd, *PATHS, common.shared_folder(spark, "test"), table_bytes=bound)
        assert "text" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_every_entry_of_the_byte_vocabulary_encodes_itself():
    """Then merging by rank and by merge list cannot part, whatever surrounds the entry."""
    aligner = kept(alignment.Aligner, *PATHS)
    merges = json.loads(aligner.whole.to_str())["model"]["merges"]
    ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(merges)}
    assert [aligner.whole.token_to_id("".join(m)) for m in ranks] == sorted(aligner.whole.token_to_id("".join(m)) for m in ranks)
    for token in aligner.whole.get_vocab(with_added_tokens=False):
        parts = list(token)
        while len(parts) > 1:
            rank, at = min((ranks.get((parts[i], parts[i + 1]), 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        assert parts == [token] or token == "<|endoftext|>"


def test_perfect_hash_is_minimal_and_verified():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        hashed = PerfectHash.from_bytes(PerfectHash.of(keys).to_bytes())
        assert sorted(hashed.numbers(keys).tolist()) == list(range(len(keys)))
        assert hashed.numbers(rng.integers(0, 99, 50)).max() < max(len(keys), 1)
    with pytest.raises(ValueError):
        PerfectHash.of(np.array([4, 4], np.int64))
    pairs = np.array([1 << 32 | 5, 2 << 32 | 7], np.int64)
    hashed = PerfectHash.of(pairs)
    keys = np.empty(2, np.int64)
    keys[hashed.numbers(pairs)] = pairs
    table = alignment.Table({0: (hashed, keys, np.array([3, 4]), np.array([True, False]))}, 1)
    count, _ = table.look_up(np.array([9 << 32 | 9, *pairs.tolist()]))
    assert count[0] == 0 and sorted(count[1:]) == [3, 4]
