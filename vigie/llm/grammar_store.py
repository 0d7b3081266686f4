"""Token ids in files compressed by pair grammars.

Documents are dealt into shards by ranges of their id and sorted, and every shard writes blocks of
whole documents. A block is a grammar in the manner of Re-Pair: rounds replace the frequent pairs of
neighbouring ids by nonterminals until no pair is frequent. A round takes, from the most frequent pair
down, all pairs whose left ids are no pair's right id and the other way round: such pairs cannot
overlap, so the whole round is one pass over arrays. In a run of equal ids, pairs are taken from left
to right, and an id that is paired with itself is in no other pair of its round. Rules are kept with the length they expand to, so any
range of ids is decoded without touching the rest of its block.

Files are Parquet in the folder given: ``shard, block, before`` (ids of the shard that stand before
the block), ``n_ids``, ``doc_ids`` and ``ends`` (per document, the end of its ids in the block),
and the grammar: ``base``, ``lefts, rights, lengths`` (little-endian 32-bit) and ``ids``. Ids from
``base`` on, the size of the vocabulary, are nonterminals. A shard is written by one task and can be written again.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vigie.llm import common
from vigie.llm.chunks import RememberedIfMet, blank_of, kept

#: Where no vocabulary is given, ids are below this.
BASE = 1 << 16
BLOCK_IDS = 1 << 18
LEAST_PAIRS = 16
#: Chunks met once and chunks met again that a worker remembers, to twice as many of each.
REMEMBERED = 50_000
#: Texts are cut this many bytes at a time, or one if it is larger, and their pieces solved this many at a time.
SLICE_BYTES = 2 << 20
SOLVED_TOGETHER = 10_000
END_ID = 0

BLOCKS = (
    "shard int, block int, before long, n_ids long, doc_ids array<long>, ends array<long>,"
    " base long, lefts binary, rights binary, lengths binary, ids binary"
)


def _places(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys a sorted array without repeats holds, and where.

    A table by hash answers all but the keys of cells that two known ones share.
    """
    bits = max(len(known) - 1, 1).bit_length() + 4
    factor, shift = np.uint64(0x9E3779B97F4A7C15), np.uint64(64 - bits)
    table, own = np.full(1 << bits, -1, np.int32), (known * factor >> shift).view(np.int64)
    table[own] = np.arange(len(known))
    shared = own[table[own] != np.arange(len(known))]
    cell = (keys * factor >> shift).view(np.int64)
    if len(shared):
        table[shared] = -2
    found = table[cell]
    again = np.flatnonzero(found == -2) if len(shared) else shared
    if len(again):
        found[again] = np.minimum(np.searchsorted(known, keys[again]), len(known) - 1)
    at = np.flatnonzero(found >= 0)
    found = found[at]
    right = np.flatnonzero(known[found] == keys[at])
    return at[right], found[right]


def compress(ids: np.ndarray, base: int = BASE, least: int = LEAST_PAIRS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, and left side, right side and expanded length of each rule; plain ids are below ``base``."""
    seq = ids.astype(np.uint32)
    lefts, rights = [np.empty(0, np.uint32)], [np.empty(0, np.uint32)]
    size = np.ones(base, np.uint32)
    # Replacing takes from the counts of pairs of older ids and never adds to them, so a pair that was not frequent
    # is counted again only beside a new nonterminal. ``live`` are the places of all other pairs, and of all equal ones.
    live = np.arange(len(seq) - 1)
    while len(live):
        # Every second pair of a run of equal ids; of other pairs, all.
        left, right = seq[live], seq[live + 1]
        pairs, same = left.astype(np.uint64) << np.uint64(32) | right, left == right
        at = live
        if same.any():
            place = live[same]
            begins = np.concatenate([[True], place[1:] != place[:-1] + 1])  # where the run that a place is in begins
            run = place[np.maximum.accumulate(np.where(begins, np.arange(len(place)), 0))]
            second = (place - run) % 2 == 1
            if second.any():
                counted = np.ones(len(live), bool)
                counted[np.flatnonzero(same)[second]] = False
                counted = np.flatnonzero(counted)
                at, pairs = live[counted], pairs[counted]
        ordered = np.sort(pairs)
        first = np.flatnonzero(np.concatenate([np.ones(min(len(ordered), 1), bool), ordered[1:] != ordered[:-1]]))
        counts = np.diff(np.append(first, len(ordered)))
        often, counts = ordered[first[counts >= least]], counts[counts >= least]
        if not len(often):
            break
        role = np.zeros(len(size), np.int8)  # 1: a pair's left id, 2: a right id, 3: both sides of one pair
        chosen = np.zeros(len(often), bool)
        order = np.argsort(-counts, kind="stable")
        for k, pair in zip(order.tolist(), often[order].tolist()):
            a, b = pair >> 32, pair & 0xFFFFFFFF
            if a == b and role[a] == 0:
                role[a] = 3
                chosen[k] = True
            elif a != b and role[a] < 2 and role[b] in (0, 2):
                role[a], role[b] = 1, 2
                chosen[k] = True
        there, which = _places(often, pairs)
        at, hit = at[there], np.flatnonzero(chosen[which])
        rule = (np.cumsum(chosen) - 1)[which[hit]]
        picked = often[chosen]
        left, right = (picked >> np.uint64(32)).astype(np.uint32), (picked & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        again = np.zeros(len(seq), bool)
        again[live[same]] = again[at] = True
        at = at[hit]
        seq[at] = (len(size) + rule).astype(np.uint32)
        again[at - (at > 0)] = True
        left_over = np.ones(len(seq), bool)
        left_over[at + 1] = False
        left_over = np.flatnonzero(left_over)
        seq, live = seq[left_over], np.flatnonzero(again[left_over[:-1]])
        size = np.concatenate([size, size[left] + size[right]])
        lefts.append(left)
        rights.append(right)
    return seq, np.concatenate(lefts), np.concatenate(rights), size[base:]


def expand(seq: np.ndarray, lefts: np.ndarray, rights: np.ndarray, base: int = BASE) -> np.ndarray:
    """The plain ids of a grammar sequence. Every rule that it uses is expanded once."""
    if not len(seq):
        return seq
    used = np.zeros(base + len(lefts), bool)
    used[seq] = True
    rules = np.flatnonzero(used[base:])
    plain, owner = rules.astype(np.uint32) + np.uint32(base), np.arange(len(rules))
    while (deeper := plain >= base).any():
        at = np.cumsum(deeper) - deeper + np.arange(len(plain))
        out = np.empty(len(plain) + int(deeper.sum()), np.uint32)
        rule = plain[deeper] - np.uint32(base)
        out[at[~deeper]] = plain[~deeper]
        out[at[deeper]] = lefts[rule]
        out[at[deeper] + 1] = rights[rule]
        plain, owner = out, np.repeat(owner, 1 + deeper)
    # Each entry is a run of this: the used rules' ids one after another, then every plain id.
    source = np.concatenate([plain, np.arange(base, dtype=np.uint32)])
    sizes = np.bincount(owner, minlength=len(rules))
    length, start = np.ones(base + len(lefts), np.int64), np.empty(base + len(lefts), np.int64)
    length[base + rules], start[base + rules] = sizes, np.cumsum(sizes) - sizes
    start[:base] = np.arange(len(plain), len(source))
    length, start = length[seq], start[seq]
    ends = np.cumsum(length)
    place = np.repeat(start - ends + length, length)
    place += np.arange(len(place))
    return source[place]


def expand_range(seq: np.ndarray, lefts: np.ndarray, rights: np.ndarray, lengths: np.ndarray, start: int, stop: int, base: int = BASE) -> np.ndarray:
    """Plain ids ``start`` to ``stop`` of a block: only the sequence entries over them are expanded."""
    size = np.concatenate([np.ones(base, np.int64), lengths.astype(np.int64)])[seq]
    ends = np.cumsum(size)
    first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left")
    offset = int(ends[first] - size[first]) if first < len(seq) else 0
    return expand(seq[first:last + 1], lefts, rights, base)[start - offset:stop - offset]


class Encoder:
    """Ids of whole texts as little-endian 32-bit bytes.

    A chunk is a run of white space and what follows it up to the next white space. No token of
    the vocabulary's cutting pattern crosses a chunk's end, so chunks are encoded once and remembered.
    New chunks are laid end to end and encoded in one call; a token stands for a known number of
    bytes, so the ids are cut where the chunks end. Many texts at a time are cut at blanks by Arrow, and
    their distinct pieces looked up once; marks behind a word are parted from it, as the pattern does.
    """

    CHUNK = re.compile(rf"[{blank_of()}]*[^{blank_of()}]+|[{blank_of()}]+")
    #: White space in which a blank is not the last: the cutting pattern may keep that blank with what stands before it.
    _BLANKS = re.sub(r"\\u(....)", r"\\x{\1}", blank_of())
    MIDST = f"[{_BLANKS}] ([{_BLANKS}]|$)"
    JOINABLE = re.compile(rf"[{blank_of()}]+[^{blank_of()}]+")

    #: A word of letters that are old in Unicode, or of digits; no added token may stand in one.
    LETTERS = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u0233"
    WORD = re.compile(rf" ?(?:[{LETTERS}]+|[0-9]+)")
    ENDS = frozenset(re.findall(rf"[{LETTERS}0-9]", "".join(map(chr, range(0x250)))))
    MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.chunks = RememberedIfMet(self._encode, remembered)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        known = self._cuts_as_known()
        #: Marks that the cutting pattern parts from a word before them, and that no added token holds.
        self.marks = "".join(set(self.MARKS).difference(*added)) if known else ""
        self.ends: dict[str, bytes] = {}
        #: For words that are cut already: the same model, which parts them at line breaks.
        self.of_words = Tokenizer(self.tokenizer.model) if known and not any(map(self.WORD.fullmatch, added)) else None
        if self.of_words:
            self.of_words.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.CharDelimiterSplit("\n"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # A byte-level vocabulary writes one character for each byte; added tokens are plain text.
        self.size = max(self.tokenizer.get_vocab(with_added_tokens=True).values(), default=END_ID) + 1
        self.n_bytes = np.zeros(self.size, np.int64)
        for token, number in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.n_bytes[number] = len(token)
        for number, token in self.tokenizer.get_added_tokens_decoder().items():
            self.n_bytes[number] = len(token.content.encode())

    def _cuts_as_known(self) -> bool:
        parts = json.loads(self.tokenizer.to_str())
        cutting = parts["pre_tokenizer"] or {}
        return (
            parts["normalizer"] is None and parts["model"]["type"] == "BPE" and not parts["model"]["dropout"]
            and (cutting.get("type"), cutting.get("add_prefix_space"), cutting.get("use_regex")) == ("ByteLevel", False, True)
        )

    def _one_by_one(self, chunks: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _encode(self, chunks: list[str]) -> list[bytes]:
        if not self.of_words:
            return self._others(chunks)
        words = [c for c in chunks if self.WORD.fullmatch(c)]
        found = dict(zip(words, self._together(words, self.of_words, "\n"), strict=True))
        if len(words) < len(chunks):
            others = [c for c in chunks if c not in found]
            found |= zip(others, self._others(others), strict=True)
        return [found[c] for c in chunks]

    def _others(self, chunks: list[str]) -> list[bytes]:
        # Chunks that open with white space and close without it stay chunks when they are joined.
        joined = [c for c in chunks if self.JOINABLE.fullmatch(c)]
        if len(joined) == len(chunks):
            return self._together(chunks, self.tokenizer)
        # Others may hold several chunks.
        parts = {c: self.CHUNK.findall(c) for c in set(chunks).difference(joined)}
        inside = {p for found in parts.values() for p in found}
        joined = list({*joined, *(p for p in inside if self.JOINABLE.fullmatch(p))})
        found = dict(zip(joined, self._together(joined, self.tokenizer), strict=True))
        rest = list(inside.difference(found))
        found |= zip(rest, self._one_by_one(rest), strict=True)
        found |= {c: b"".join([found[p] for p in own]) for c, own in parts.items()}
        return [found[c] for c in chunks]

    def _together(self, chunks: list[str], tokenizer, between: str = "") -> list[bytes]:
        if not chunks:
            return []
        ids = array("I", tokenizer.encode_batch_fast([between.join(chunks)], add_special_tokens=False)[0].ids).tobytes()
        ends = np.cumsum(self.n_bytes[np.frombuffer(ids, np.uint32)])
        wanted = np.cumsum([len(c) if c.isascii() else len(c.encode()) for c in chunks])
        cut = np.searchsorted(ends, wanted)
        # A chunk's end inside a token, or bytes that no token stands for: take the plain way.
        if not len(ends) or ends[-1] != wanted[-1] or (ends[cut] != wanted).any():
            return self._one_by_one(chunks)
        cuts = [0, *((cut + 1) * 4).tolist()]
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]

    def _distinct(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks; marks at the end of a word are solved apart, so words are met again."""
        stems, ends, behind = [c.rstrip(self.marks) for c in chunks], self.ends, {}
        for i in np.flatnonzero(np.fromiter(map(len, stems), np.int64) < np.fromiter(map(len, chunks), np.int64)).tolist():
            stem = stems[i]
            if stem[-1:] in self.ENDS:
                behind[i] = chunks[i][len(stem):]
            else:
                stems[i] = chunks[i]
        solved = self.chunks.get(stems)
        if len(ends) > SOLVED_TOGETHER:
            ends.clear()
        new = list(set(behind.values()).difference(ends))
        ends.update(zip(new, self._one_by_one(new), strict=True))
        for i, end in behind.items():
            solved[i] += ends[end]
        return solved

    def of(self, text: str) -> bytes:
        return b"".join(self.chunks.get(self.CHUNK.findall(text)))

    def of_many(self, texts: pa.Array) -> Iterator[bytes]:
        """Each text's ids, a slice of texts at a time: cut before every blank, distinct pieces solved once."""
        texts = pc.fill_null(texts, "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE_BYTES, "right")))
            yield from self._slice(texts.slice(at, stop - at))
            at = stop

    def _slice(self, texts: pa.Array) -> Iterator[bytes]:
        # A blank in the midst or at the end of white space may not begin a token.
        hard = pc.match_substring_regex(texts, self.MIDST)
        whole = {i: self.of(texts[i].as_py()) for i in pc.indices_nonzero(hard).to_pylist()}
        cut = pc.split_pattern(pc.if_else(hard, "", texts) if whole else texts, " ")
        bounds = cut.offsets.to_numpy()
        words = cut.values.slice(bounds[0], bounds[-1] - bounds[0])
        bounds = (bounds - bounds[0]).astype(np.int64)
        # The first of a text stands without a blank.
        firsts = words.take(pa.array(bounds[:-1])).to_pylist()
        words = words.dictionary_encode()
        distinct = [" " + w for w in words.dictionary.to_pylist()] + firsts
        which = words.indices.to_numpy().copy()
        which[bounds[:-1]] = np.arange(len(distinct) - len(firsts), len(distinct))
        solved = []
        for k in range(0, len(distinct), SOLVED_TOGETHER):
            solved += self._distinct(distinct[k:k + SOLVED_TOGETHER])
        ids = pa.array(solved, pa.large_binary()).take(pa.array(which))
        ends = np.frombuffer(ids.buffers()[1], np.int64)[bounds]
        data = memoryview(ids.buffers()[2] or b"")
        for i, (a, b) in enumerate(zip(ends.tolist(), ends[1:].tolist())):
            yield whole[i] if i in whole else bytes(data[a:b])


def write_store(documents: DataFrame, path: str, folder: str) -> None:
    """Encode every whole text, append the end id, and write the blocks in ascending order of id.

    Null texts count as empty. Rows without an id come first and rows that share an id are ordered
    by text.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, block, before = kept(Encoder, path), TaskContext.get().partitionId(), 0, 0
        ids: list = []
        ends: list[int] = []
        held: list[bytes] = []
        size = 0
        end_id = np.array([END_ID], "<u4").tobytes()

        def full() -> pa.RecordBatch:
            seq, lefts, rights, lengths = compress(np.frombuffer(b"".join(held), "<u4"), encoder.size)
            columns = [[shard], [block], [before], [size], [ids], [ends], [encoder.size], *([a.astype("<u4").tobytes()] for a in (lefts, rights, lengths, seq))]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), *[pa.binary()] * 4]
            names = [part.split()[0] for part in BLOCKS.split(", ")]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), encoder.of_many(batch.column(1)), strict=True):
                held += [data, end_id]
                size += len(data) // 4 + 1
                ids.append(doc_id)
                ends.append(size)
                if size >= BLOCK_IDS:
                    yield full()
                    block, before, size = block + 1, before + size, 0
                    ids, ends, held = [], [], []
        if ids:
            yield full()

    (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")
        .mapInArrow(work, BLOCKS)
        .write.mode("overwrite").parquet(folder)
    )


def read_store(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """The documents of a store: ``doc_id, start, n_tokens, ids_crc32``, on request with their ``ids``."""
    blocks = spark.read.schema(BLOCKS).parquet(folder)
    schema = "doc_id long, shard int, at long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, before, ids, ends, base, lefts, rights, seq = (
                    batch.column(n)[row].as_py() for n in ("shard", "before", "doc_ids", "ends", "base", "lefts", "rights", "ids"))
                plain = expand(*(np.frombuffer(x, "<u4") for x in (seq, lefts, rights)), base)
                data, starts = memoryview(plain.astype("<u4").tobytes()), [0, *ends[:-1]]
                columns = [
                    pa.array(ids, pa.int64()), pa.array([shard] * len(ids), pa.int32()),
                    pa.array([before + a for a in starts], pa.int64()), pa.array([b - a for a, b in zip(starts, ends)], pa.int64()),
                    pa.array([zlib.crc32(data[4 * a:4 * b]) for a, b in zip(starts, ends)], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array([0, *ends], pa.int32()), pa.array(plain.astype(np.int32))))
                yield pa.record_batch(columns, [part.split()[0] for part in schema.split(", ")])

    # One row per shard: the ids of all shards before it.
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    shards = shards.select("shard", F.coalesce(F.sum("n").over(
        Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shard_start")).checkpoint()
    if common.small_enough(shards.count(), 16):
        shards = F.broadcast(shards)
    return (
        blocks.select("shard", "before", "doc_ids", "ends", "base", "lefts", "rights", "ids").mapInArrow(work, schema)
        .join(shards, "shard")
        .select("doc_id", (F.col("shard_start") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)
    )
