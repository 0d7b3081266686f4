"""Alignment of two tokenizers over the same bytes, with corpus-wide counts of linked id pairs.

Both tokenizers cut the same bytes. Where both end a token a group ends, and two tokens whose byte
ranges overlap are linked. A pair of ids counts the documents in which it is linked.

The texts are encoded once. The first pass aligns every document, stores its ids and figures, and sends on,
per task, how many documents hold each pair. The distinct pairs get a minimal perfect hash per shard (a shard holds
all pairs of its first ids), so that counts need no keys: dense vectors indexed by the hash are filled
branch by branch and summed in a tree. The keys are kept once, by number, and verified at every lookup.
The second pass links the stored ids and looks their pairs up. The shards go to the tasks while
their counted size is under a bound; beyond it the documents' pairs are joined with the counts.

Neither tokenizer joins anything across a single space or line break between two visible characters,
which the loaded vocabularies are checked for. So a text falls into short chunks whose ends are ends of
tokens on both sides; a chunk is encoded once and remembered, in bounded memory, and so are its word
and the signs behind it where no token joins the two. Batches of documents are then aligned as arrays.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.llm import common
from vigie.llm.chunks import Remembered, kept
from vigie.llm.perfect_hash import PerfectHash
from vigie.llm.token_counts import _byte_letters

#: Fixed value: how byte-level vocabularies cut a text into pieces that no token crosses.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space, and characters that some tables count as white space, as the inside of a pattern's set.
ODD = r"\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff"
CUT = re.compile(rf"(?<=[^ \n{ODD}])(?=[ \n][^ \n{ODD}])")
WORD_AND_SIGNS = regex.compile(r"(\n?\p{L}+)([^\p{L}\p{N}\s]+)")
MARK = "▁"
LONG = 256

SHARD_PAIRS = 1 << 18
BRANCH_ROWS = 1 << 22
FAN_IN = 8
TASK_PAIRS = 1 << 22
#: Characters that are aligned at once.
BATCH_CHARS = 1 << 21
#: Links that are looked up at once.
BATCH_LINKS = 1 << 20
#: The shards of all pairs may be broadcast up to this size.
TABLE_BYTES = 128 << 20
PAIR_BYTES = 32
REMEMBERED = 200_000


def chunks(text: str) -> list:
    """The text cut before every single space or line break between visible characters.

    A chunk that starts with a line break stands for itself, any other for a space and itself; the
    text as a whole stands for a space and itself. A first chunk that starts with a line break of
    the text is a tuple, to be told from the others.
    """
    spaced = text.replace("\n", " ")
    # Any other white space is not printable, as are some characters that do no harm.
    if "  " in spaced or spaced[0] == " " or spaced[-1] == " " or not spaced.isprintable():
        first, *others = CUT.split(f" {text}")
        first = first[1:]
        return [(first,) if first[:1] == "\n" else first, *(c[1:] if c[0] == " " else c for c in others)]
    return text.replace("\n", " \n").split(" ")


class Aligner:
    """Both tokenizers, and what they make of chunks: ids as bytes of 32-bit integers."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(byte_path)
        self.whole.encode_special_tokens = True
        letters = {c: b for b, c in enumerate(_byte_letters())}
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        ranks = {bytes(map(letters.__getitem__, t)): i for t, i in vocabulary.items() if all(c in letters for c in t)}
        #: Merges by rank give the same ids as the file's merge list, as every entry is its own encoding; tests check it.
        self.ranked = tiktoken.Encoding("ranked", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.pieces.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(names)]
        if any(re.search(rf"[^{MARK}]{MARK}|\n", p) for p in names):
            raise ValueError("a piece joins across white space")
        plain = [p for i, p in enumerate(names) if not self.pieces.is_byte(i) and not self.pieces.is_control(i) and not self.pieces.is_unknown(i)]
        #: Whether a word may be cut from the signs behind it.
        self.words_end = not any(regex.search(rf"\p{{L}}[^\p{{L}}{MARK}]", p) for p in plain)
        self.n_a, self.n_b = max(ranks.values()) + 1, len(names)
        self.a_size = np.zeros(self.n_a, np.int64)
        for token, i in ranks.items():
            self.a_size[i] = len(token)
        self.b_size = np.array([len(p) for p in self.b_bytes], np.int64)
        self.memory = Remembered(self._chunks, REMEMBERED)
        self.heads = Remembered(self._heads, REMEMBERED * 3 // 2)
        self.tails = Remembered(self._tails, REMEMBERED // 4)
        # Decimal ids with what follows them: first side inside and at the end of a group, then the second side.
        self.written = [f"{i}{sign}" for n, signs in ((self.n_a, ",|"), (self.n_b, ",;")) for sign in signs for i in range(n)]

    def _first(self, text: str) -> list[int]:
        return self.ranked.encode_ordinary(text) if len(text) <= LONG else self.whole.encode(text, add_special_tokens=False).ids

    def _bytes(self, a: list[int], b: list[int], text: str) -> tuple[bytes, bytes] | None:
        """None if the second side's bytes are not the text's; the first side's always are."""
        return (array("i", a).tobytes(), array("i", b).tobytes()) if b"".join([self.b_bytes[i] for i in b]) == text.encode() else None

    def _heads(self, some: list) -> list:
        # The piece model adds a space: it stands for the space in front, and goes away before a line break.
        bare = [c if isinstance(c, str) else c[0] for c in some]
        spaced = [not isinstance(c, str) or c[:1] != "\n" for c in some]
        second = self.pieces.encode(bare, num_threads=1)
        whole = [f" {c}" if space else c for c, space in zip(bare, spaced)]
        return [self._bytes(self._first(c), b if space else b[1:], c) for c, b, space in zip(whole, second, spaced)]

    def _tails(self, some: list[str]) -> list:
        second = self.pieces.encode([f"\n{c}" for c in some], num_threads=1)  # a space and a line break in front
        return [self._bytes(self._first(c), b[2:], c) for c, b in zip(some, second)]

    def _chunks(self, some: list) -> list:
        """Most chunks are a word and signs behind it, which no token of either side joins."""
        cut = [WORD_AND_SIGNS.fullmatch(c) if self.words_end and isinstance(c, str) else None for c in some]
        heads = self.heads.get([m.group(1) if m else c for c, m in zip(some, cut)])
        tails = iter(self.tails.get([m.group(2) for m in cut if m]))
        out = []
        for head, m in zip(heads, cut):
            if m:
                tail = next(tails)
                head = (head[0] + tail[0], head[1] + tail[1]) if head and tail else None
            out.append(head)
        return out

    def solved(self, parts: list) -> list:
        """Ids of chunks; long ones and tuples are not remembered."""
        if max(map(len, parts), default=0) <= LONG and set(map(type, parts)) <= {str}:
            return self.memory.get(parts)
        rare = {i for i, p in enumerate(parts) if len(p) > LONG or isinstance(p, tuple)}
        found = iter(self.memory.get([p for i, p in enumerate(parts) if i not in rare]))
        return [self._heads([p])[0] if i in rare else next(found) for i, p in enumerate(parts)]


class Aligned:
    """The tokens of some texts end to end, their links and groups. Texts without tokens are left out."""

    def __init__(self, aligner: Aligner, texts: list[str | None]):
        parts, edges = [], [0]
        for text in texts:
            if text:
                parts += chunks(text)
            edges.append(len(parts))
        own = aligner.solved(parts)
        bad = {i for i, f in enumerate(own) if f is None} if None in own else ()
        self.places = [p for p, (x, y) in enumerate(zip(edges, edges[1:])) if x < y and not (bad and any(i in bad for i in range(x, y)))]
        if len(self.places) < len(texts):
            own = [f for p in self.places for f in own[edges[p]:edges[p + 1]]]
        ids = (np.frombuffer(b"".join([f[side] for f in own]), "<i4").astype(np.int64) for side in (0, 1))
        self._link(aligner, *ids, np.cumsum([len(texts[p].encode()) + 1 for p in self.places], dtype=np.int64))

    @classmethod
    def of_ids(cls, aligner: Aligner, rows: list[tuple[np.ndarray, np.ndarray]]) -> Aligned:
        """The same from the ids of both sides that :meth:`ids` gave."""
        self = cls.__new__(cls)
        self.places = [p for p, (a, _) in enumerate(rows) if len(a)]
        a, b = (np.concatenate([np.empty(0, np.int64), *(rows[p][side] for p in self.places)]).astype(np.int64) for side in (0, 1))
        upto = np.cumsum([len(rows[p][0]) for p in self.places], dtype=np.int64)
        self._link(aligner, a, b, np.cumsum(aligner.a_size[a])[upto - 1])
        return self

    def ids(self) -> Iterator[tuple[bytes, bytes]]:
        """The ids of each text, as short as the vocabularies allow."""
        sides = [(x.astype(kind_of(n)), upto.tolist()) for x, n, upto in (
            (self.a, self.aligner.n_a, self.a_upto), (self.b, self.aligner.n_b, self.b_upto))]
        return zip(*([x[i:j].tobytes() for i, j in zip(upto, upto[1:])] for x, upto in sides))

    def _link(self, aligner: Aligner, a: np.ndarray, b: np.ndarray, stops: np.ndarray) -> None:
        """Links and groups of ids whose texts stop at the given bytes."""
        self.aligner, self.n, self.a, self.b = aligner, len(stops), a, b
        ends_a, ends_b = np.cumsum(aligner.a_size[self.a]), np.cumsum(aligner.b_size[self.b])
        total = int(stops[-1]) if len(stops) else 0
        in_a, in_b = np.zeros(total + 1, bool), np.zeros(total + 1, bool)
        in_a[ends_a], in_b[ends_b] = True, True
        # Between two neighbouring ends of either side lies exactly one link.
        ends = np.flatnonzero(in_a | in_b)
        self.link_a = np.cumsum(in_a[ends]) - in_a[ends]
        self.link_b = np.cumsum(in_b[ends]) - in_b[ends]
        self.group_end = in_a[ends] & in_b[ends]
        self.links_upto = np.concatenate([[0], np.searchsorted(ends, stops, "right")])
        self.a_upto = np.concatenate([[0], np.searchsorted(ends_a, stops, "right")])
        self.b_upto = np.concatenate([[0], np.searchsorted(ends_b, stops, "right")])

    def sums(self, of_links: np.ndarray) -> np.ndarray:
        """Sums over the links of each text."""
        return np.diff(np.concatenate([[0], np.cumsum(of_links, dtype=np.int64)])[self.links_upto])

    def pairs(self) -> np.ndarray:
        """Of each link, first id << 32 | second id."""
        return self.a[self.link_a] << 32 | self.b[self.link_b]

    def distinct_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The distinct pairs of all texts, and the number of each link's pair among them."""
        code = self.a[self.link_a] * self.aligner.n_b + self.b[self.link_b]
        if self.aligner.n_a * self.aligner.n_b < 1 << 32:
            code = code.astype(np.uint32)  # sorts faster
        code, place = np.unique(code, return_inverse=True)
        code = code.astype(np.int64)
        return code // self.aligner.n_b << 32 | code % self.aligner.n_b, place

    def text_of_link(self) -> np.ndarray:
        return np.repeat(np.arange(self.n), np.diff(self.links_upto))

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text number, pair and number of links for every pair of every text."""
        per_text = self.aligner.n_a * self.aligner.n_b
        key = self.text_of_link() * per_text + self.a[self.link_a] * self.aligner.n_b + self.b[self.link_b]
        key, times = np.unique(key, return_counts=True)
        text, code = np.divmod(key, per_text)
        return text, code // self.aligner.n_b << 32 | code % self.aligner.n_b, times

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups: first ids, a bar, second ids; groups by semicolons."""
        before = np.cumsum(self.group_end) - self.group_end  # groups that ended before a link
        group_a, group_b = np.empty(len(self.a), np.int64), np.empty(len(self.b), np.int64)
        group_a[self.link_a], group_b[self.link_b] = before, before
        n_groups = int(self.group_end.sum())
        upto_a, upto_b = (np.searchsorted(g, np.arange(n_groups + 1)) for g in (group_a, group_b))
        last_a, last_b = np.zeros(len(self.a), bool), np.zeros(len(self.b), bool)
        last_a[upto_a[1:] - 1], last_b[upto_b[1:] - 1] = True, True
        entry = np.empty(len(self.a) + len(self.b), np.int64)
        n_a, n_b = self.aligner.n_a, self.aligner.n_b
        entry[np.arange(len(self.a)) + upto_b[group_a]] = self.a + n_a * last_a
        entry[np.arange(len(self.b)) + upto_a[group_b + 1]] = self.b + n_b * last_b + 2 * n_a
        written, edges = self.aligner.written, (self.a_upto + self.b_upto).tolist()
        entry = entry.tolist()
        return [
            hashlib.sha256("".join(map(written.__getitem__, entry[x:y])).encode()[:-1]).hexdigest() for x, y in zip(edges, edges[1:])
        ]


def kind_of(n_ids: int) -> str:
    """How ids below a number are stored."""
    return "<u2" if n_ids <= 1 << 16 else "<i4"


def pieces_of(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of batches whose texts together have a bounded size, or a single text."""
    for batch in batches:
        start, size, some = 0, 0, []
        for at, value in enumerate(batch.column(column)):
            text = value.as_py()
            length = len(text or "")
            if some and size + length > BATCH_CHARS:
                yield batch.slice(start, at - start), some
                start, size, some = at, 0, []
            some.append(text)
            size += length
        if some:
            yield batch.slice(start), some


class Table:
    """Counts of pairs by shard; of a pair that is not there the count is 0."""

    def __init__(self, shards: dict[int, tuple], n_shards: int):
        self.shards, self.n_shards = shards, n_shards

    def look_up(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count, and whether it is the highest of the pair's first id."""
        count, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        shard = shard_of(pairs, self.n_shards)
        for s in np.unique(shard).tolist():
            if s not in self.shards:
                continue
            hashed, keys, counts, tops = self.shards[s]
            at = np.flatnonzero(shard == s)
            number = hashed.numbers(pairs[at])
            found = number >= 0
            found[found] = keys[number[found]] == pairs[at[found]]  # verified: foreign keys may find a place too
            count[at[found]], best[at[found]] = counts[number[found]], tops[number[found]]
        return count, best


def shard_of(pairs: np.ndarray, n_shards: int) -> np.ndarray:
    """All pairs of a first id are in one shard."""
    return (np.asarray(pairs, np.int64) >> 32) % n_shards


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _added(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and the sums of their numbers."""
    pairs, place = np.unique(np.concatenate([p for p, _ in parts]), return_inverse=True)
    return pairs, np.bincount(place, np.concatenate([n for _, n in parts]), len(pairs)).astype(np.int64)


ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, a binary, b binary, pair long, n long"
)
FIGURES = ("n_a", "n_b", "n_groups", "n_links")


def aligned_documents(documents: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """``ALIGNED``: a row for each document, with its figures and ids, and rows that have a ``pair`` only.

    These say in how many documents of a part of a task a pair is linked; add up ``n`` by pair.
    """
    kinds = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in ALIGNED.split(", ")]

    def counted(pairs: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([*(pa.nulls(len(pairs), k) for k in kinds[:-2]), pa.array(pairs), pa.array(n)], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept(Aligner, byte_path, piece_path)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        for batch, texts in pieces_of(batches, 1):
            own = Aligned(aligner, texts)
            _, pairs, _ = own.distinct()
            parts.append(np.unique(pairs, return_counts=True))
            if sum(len(p) for p, _ in parts) > TASK_PAIRS:
                parts = [_added(parts)]
                if len(parts[0][0]) > TASK_PAIRS // 2:
                    yield counted(*parts.pop())
            figures = [np.diff(own.a_upto), np.diff(own.b_upto), own.sums(own.group_end), np.diff(own.links_upto)]
            columns = [np.zeros(batch.num_rows, np.int64) for _ in figures]
            for column, figure in zip(columns, figures):
                column[own.places] = figure
            rest = [("", b"", b"")] * batch.num_rows
            for place, digest, ids in zip(own.places, own.digests(), own.ids()):
                rest[place] = (digest, *ids)
            lists = [pa.array(c, k) for c, k in zip(zip(*rest), kinds[5:8])]
            yield pa.record_batch([batch.column(0), *map(pa.array, columns), *lists, *(pa.nulls(batch.num_rows, k) for k in kinds[-2:])], names)
        if parts:
            yield counted(*_added(parts))

    return _texts(documents).mapInArrow(work, ALIGNED)


def restored(batches: Iterator[pa.RecordBatch], aligner: Aligner) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    """The rows of documents in :func:`aligned_documents`, ids last, in slices of a bounded number of ids."""
    kinds = kind_of(aligner.n_a), kind_of(aligner.n_b)
    for batch in batches:
        upto = np.cumsum(batch.column("n_links").to_numpy())
        start = 0
        while start < batch.num_rows:
            before = upto[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(upto, before + BATCH_LINKS, "right")))
            part = batch.slice(start, stop - start)
            rows = zip(*([np.frombuffer(v.as_buffer(), kind) if len(v.as_buffer()) else np.empty(0, kind) for v in part.column(c)] for c, kind in zip("ab", kinds)))
            yield part.drop_columns(["a", "b"]), Aligned.of_ids(aligner, list(rows))
            start = stop


def _sum_shape(part: pa.Table) -> np.ndarray:
    """The sum of dense vectors."""
    return np.sum([np.frombuffer(v.as_py(), "<i8") for v in part["counts"]], axis=0, dtype=np.int64)


def count_table(partial: DataFrame, folder: str) -> DataFrame:
    """``shard, n, hash, keys, counts, tops`` from partial counts ``pair, n`` that are stored.

    Keys and counts are arrays of longs by number, ``tops`` marks the highest count of each first id.
    """
    pairs = common.stored(partial.select("pair").distinct(), folder, "pairs")
    rows, n_pairs = partial.count(), pairs.count()
    n_shards = max(1, -(-n_pairs // SHARD_PAIRS))
    branches = max(1, -(-rows // (n_shards * BRANCH_ROWS)))
    shard = F.pmod(F.shiftright("pair", 32), F.lit(n_shards).cast("long")).cast("int")

    def build(part: pa.Table) -> pa.Table:
        keys = part["pair"].to_numpy()
        hashed = PerfectHash.of(keys)
        ordered = np.empty(len(keys), "<i8")
        ordered[hashed.numbers(keys)] = keys
        return pa.table({"shard": pa.array([part["shard"][0].as_py()], pa.int32()), "hash": [hashed.to_bytes()], "keys": [ordered.tobytes()]})

    hashes = common.stored(
        pairs.withColumn("shard", shard).groupBy("shard").applyInArrow(build, "shard int, hash binary, keys binary"), folder, "hashes")

    def leaf(part: pa.Table, own: pa.Table) -> pa.Table:
        hashed = PerfectHash.from_bytes(own["hash"][0].as_py())
        at = hashed.numbers(part["pair"].to_numpy())
        counts = np.zeros(hashed.size, "<i8")
        np.add.at(counts, at, part["n"].to_numpy())
        return pa.table({"shard": own["shard"], "branch": own["branch"], "counts": pa.array([counts.tobytes()], pa.binary())})

    def merge(part: pa.Table) -> pa.Table:
        return pa.table({"shard": part["shard"][:1], "branch": part["branch"][:1], "counts": pa.array([_sum_shape(part).tobytes()], pa.binary())})

    def tops(part: pa.Table, own: pa.Table) -> pa.Table:
        counts, keys = _sum_shape(part), np.frombuffer(own["keys"][0].as_py(), "<i8")
        ids, place = np.unique(keys >> 32, return_inverse=True)
        most = np.zeros(len(ids), np.int64)
        np.maximum.at(most, place, counts)
        return pa.table({
            "shard": own["shard"], "n": pa.array([len(keys)], pa.int64()), "hash": own["hash"], "keys": own["keys"],
            "counts": pa.array([counts.astype("<i8").tobytes()], pa.binary()),
            "tops": pa.array([np.packbits(counts == most[place]).tobytes()], pa.binary()),
        })

    vectors = "shard int, branch int, counts binary"
    branch = F.pmod(F.xxhash64("pair", "n"), F.lit(branches)).cast("int")
    dealt = partial.withColumn("shard", shard).withColumn("branch", branch).groupBy("shard", "branch")
    hashed = hashes.withColumn("branch", F.explode(F.sequence(F.lit(0), F.lit(branches - 1)))).groupBy("shard", "branch")
    summed, level = dealt.cogroup(hashed).applyInArrow(leaf, vectors), 0
    while branches > FAN_IN:
        branches, level = -(-branches // FAN_IN), level + 1
        summed = common.stored(summed, folder, f"sums-{level}").withColumn("branch", (F.col("branch") / FAN_IN).cast("int"))
        summed = summed.groupBy("shard", "branch").applyInArrow(merge, vectors)
    table = summed.groupBy("shard").cogroup(hashes.groupBy("shard")).applyInArrow(
        tops, "shard int, n long, hash binary, keys binary, counts binary, tops binary")
    return common.stored(table.withColumn("n_shards", F.lit(n_shards)), folder, "counts")


def pair_counts(table: DataFrame) -> DataFrame:
    """``pair, n, top`` of a table of counts, one row a pair."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, counts = (np.frombuffer(row[c], "<i8") for c in ("keys", "counts"))
                top = np.unpackbits(np.frombuffer(row["tops"], np.uint8), count=len(keys)).astype(bool)
                yield pa.record_batch([pa.array(keys), pa.array(counts), pa.array(top)], ["pair", "n", "top"])

    return table.select("keys", "counts", "tops").mapInArrow(work, "pair long, n long, top boolean")


def _load(rows: list[tuple], n_shards: int) -> Table:
    shards = {}
    for shard, hashed, keys, counts, tops in rows:
        keys = np.frombuffer(keys, "<i8")
        shards[shard] = (
            PerfectHash.from_bytes(hashed), keys, np.frombuffer(counts, "<i8"),
            np.unpackbits(np.frombuffer(tops, np.uint8), count=len(keys)).astype(bool),
        )
    return Table(shards, n_shards)


MEASURES = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _measured(aligned: DataFrame, byte_path: str, piece_path: str, shared) -> DataFrame:
    names = [c.split()[0] for c in MEASURES.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, table = kept(Aligner, byte_path, piece_path), _load(*shared.value)
        for batch, own in restored(batches, aligner):
            pairs, place = own.distinct_pairs()
            count, best = table.look_up(pairs)
            for name, of_links in (("n_best", best), ("count_sum", count)):
                column = np.zeros(batch.num_rows, np.int64)
                column[own.places] = own.sums(of_links[place])
                batch = batch.append_column(name, pa.array(column))
            yield batch.select(names)

    return aligned.mapInArrow(work, MEASURES)


def _joined(aligned: DataFrame, byte_path: str, piece_path: str, table: DataFrame, folder: str) -> DataFrame:
    """The same by a join of the documents' distinct pairs with the counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept(Aligner, byte_path, piece_path)
        for batch, own in restored(batches, aligner):
            text, pairs, times = own.distinct()
            sizes = np.zeros(batch.num_rows, np.int64)
            sizes[own.places] = np.bincount(text, minlength=own.n)
            edges = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(edges, pa.array(v.astype(np.int64))) for v in (pairs, times)]
            yield pa.record_batch([batch.column("row"), *lists], ["row", "pairs", "times"])

    aligned = common.stored(aligned.withColumn("row", F.monotonically_increasing_id()), folder, "rows")
    links = aligned.select("row", "n_links", "a", "b").mapInArrow(work, "row long, pairs array<long>, times array<long>")
    links = links.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row", "x.*").withColumnRenamed("pairs", "pair")
    sums = links.join(pair_counts(table), "pair").groupBy("row").agg(
        F.sum(F.when(F.col("top"), F.col("times")).otherwise(0)).cast("long").alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    return aligned.join(sums, "row", "left").fillna(0, ["n_best", "count_sum"]).select(*[c.split()[0] for c in MEASURES.split(", ")])


def align(documents: DataFrame, byte_path: str, piece_path: str, folder: str, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Token, group and link figures of every row, as ``MEASURES``.

    Null and empty texts, and texts that a tokenizer does not give back byte for byte, have no tokens:
    zeros and an empty digest, and they count for no pair. Ids may be null or repeat; every row is a
    document of its own. ``table_bytes`` bounds what is broadcast; results do not depend on it.
    """
    rows = common.stored(aligned_documents(documents, byte_path, piece_path), folder, "aligned")
    table = count_table(rows.where("pair IS NOT NULL").select("pair", "n"), folder)
    aligned = rows.where("pair IS NULL").select("doc_id", *FIGURES, "groups_sha256", "a", "b")
    size = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("n_shards"), F.lit(1))).first()
    if size[0] * PAIR_BYTES > table_bytes:
        return _joined(aligned, byte_path, piece_path, table, folder)
    shards = [tuple(r) for r in table.select("shard", "hash", "keys", "counts", "tops").toLocalIterator()]  # counted: at most table_bytes
    return _measured(aligned, byte_path, piece_path, documents.sparkSession.sparkContext.broadcast((shards, size[1])))
