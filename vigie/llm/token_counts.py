"""Token counts at every prefix.

A text falls into chunks at its white space, and no token crosses white space. Inside a chunk, the
tokenizer's own pattern cuts pieces, and a piece is solved by dynamic programming over its
prefixes: the encoding of a prefix ends in the one token that fits the encoding of what stands
before it, where two neighbours fit if the tokenizer leaves them apart when it encodes just the
two. So the count of a prefix is one more than the count of a shorter prefix, and every prefix
of a piece is answered in one pass. A text stores the steps between the counts of neighbouring
prefixes, one byte a character, from which budget and truncation questions are answered without
encoding again.

Every chunk is solved once per task and kept in a bounded memory; texts are never cut.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.llm.chunks import Remembered, blank_of, kept

#: Fixed value: how the vocabulary's library cuts text without white space into pieces.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{L}\p{N}]+")
CHUNK = re.compile(rf"[^{blank_of()}]+")
LIMIT = 2048
NEVER = 1 << 60


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in shown)
    table = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [table[b] for b in range(256)]


def _differences(counts: list[int]) -> bytes:
    """Steps of a row of counts as signed bytes."""
    steps = [b - a for a, b in zip([0, *counts], counts)]
    if max(steps) > 127 or min(steps) < -128:
        raise ValueError("a step between prefixes beyond a byte")
    return bytes([x & 255 for x in steps])


class PrefixCounter:
    """Counts of all prefixes under a BPE vocabulary file with word ends."""

    def __init__(self, path: str, remembered: int = 200_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut = regex.compile("|".join(map(regex.escape, self.special)))
        # Ids from 1, as 0 stands for none.
        self.vocabulary = {token: i + 1 for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        self.names = {i: token for token, i in self.vocabulary.items()}
        self.letters = _byte_letters()
        self.fits: dict[int, bool] = {}
        self.edges: dict[str, tuple | None] = {}
        merges = json.loads(self.tokenizer.to_str())["model"]["merges"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(merges)}
        self.tokens = self._automaton()
        self.pieces = Remembered(lambda new: [self._steps(p) for p in new], remembered)
        self.steps = Remembered(self._chunks, remembered)

    def _automaton(self):
        """Finds the vocabulary's tokens in a word; each knows whether it stands inside and at the end of words."""
        import ahocorasick

        found = ahocorasick.Automaton()
        for token in self.vocabulary:
            bare = token.removesuffix("</w>") or token
            found.add_word(bare, (len(bare), self.vocabulary.get(bare, 0), self.vocabulary.get(f"{bare}</w>", 0)))
        found.make_automaton()
        return found

    def _history(self, token: str) -> tuple | None:
        """How a token grows by the merge list: its leftmost and its rightmost part over time, each
        with the rank of the merge that takes it up. None if its letters give other tokens."""
        if token not in self.edges:
            end = "</w>" if token.endswith("</w>") and token != "</w>" else ""
            parts = list(token.removesuffix(end))
            parts[-1] += end
            left, right = [], []
            while len(parts) > 1:
                rank, at = min((self.ranks.get((parts[i], parts[i + 1]), NEVER), i) for i in range(len(parts) - 1))
                if rank == NEVER:
                    break
                if at == 0:
                    left.append((parts[0], rank))
                if at == len(parts) - 2:
                    right.append((parts[-1], rank))
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            whole = [(token, NEVER)]
            self.edges[token] = (left + whole, right + whole) if parts == [token] else None
        return self.edges[token]

    def _fit(self, first: int, second: int) -> bool:
        """True if the merges leave two neighbouring tokens apart: while both grow, no merge of the
        parts that meet at the seam comes before the merges that take these parts up."""
        if len(self.fits) > 400_000:
            self.fits.clear()
        a, b = self._history(self.names[first]) if first else ((), ()), self._history(self.names[second])
        apart = a is not None and b is not None
        if apart and first:
            i = j = 0
            ends, starts = a[1], b[0]
            while True:
                (end, end_taken), (start, start_taken) = ends[i], starts[j]
                seam = self.ranks.get((end, start), NEVER)
                # Equal merges go from left to right.
                if seam < end_taken and seam <= start_taken and seam != NEVER:
                    apart = False
                    break
                if end_taken == start_taken == NEVER:
                    break
                if end_taken <= start_taken:
                    i += 1
                if start_taken <= end_taken:
                    j += 1
        self.fits[first << 32 | second] = apart
        return apart

    def _piece(self, piece: str) -> list[int]:
        """Token counts of the prefixes of one piece, one for each character."""
        if piece.isascii() and piece.isprintable():
            word, ends = piece, None
        else:
            letters, ends = [], []
            for c in piece:
                letters += [self.letters[b] for b in c.encode()]
                ends.append(len(letters))
            word = "".join(letters)
        n = len(word)
        last, count, closed = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        known, fit = self.fits.get, self._fit
        for at, (size, inner, outer) in self.tokens.iter(word):  # longest first at each end
            i = at + 1
            before = last[i - size]
            if inner and not count[i]:
                fits = known(before << 32 | inner)
                if fits or fits is None and fit(before, inner):
                    last[i], count[i] = inner, count[i - size] + 1
            if outer and not closed[i]:
                fits = known(before << 32 | outer)
                if fits or fits is None and fit(before, outer):
                    closed[i] = count[i - size] + 1
        return closed[1:] if ends is None else [closed[e] for e in ends]

    def _steps(self, piece: str) -> tuple[int, bytes]:
        if len(piece) == 3 and piece[0] == "'" and piece[1].isalpha():  # two pieces until it is whole
            counts = [len(self.tokenizer.encode(piece[:k], add_special_tokens=False).ids) for k in (1, 2, 3)]
        else:
            counts = self._piece(piece)
        return counts[-1], _differences(counts)

    def _chunks(self, chunks: list[str]) -> list[tuple[int, bytes]]:
        """Tokens of chunks and the steps between their prefixes' counts."""
        parts: list[list] = []
        for chunk in chunks:
            own: list = []
            at = 0
            for match in self.cut.finditer(chunk) if "<|" in chunk else ():
                own += [*self._cut(chunk[at:match.start()]), match]
                at = match.end()
            parts.append(own + self._cut(chunk[at:]))
        plain = iter(self.pieces.get([p for own in parts for p in own if isinstance(p, str)]))
        solved = []
        for own in parts:
            found = [next(plain) if isinstance(p, str) else self._special(p.group()) for p in own]
            solved.append(found[0] if len(found) == 1 else (sum(n for n, _ in found), b"".join([s for _, s in found])))
        return solved

    def _cut(self, text: str) -> list[str]:
        return PIECES.findall(text.lower() if text.isascii() else self.tokenizer.normalizer.normalize_str(text))

    def _special(self, text: str) -> tuple[int, bytes]:
        """One token when it is whole, ordinary text before."""
        counts, before = [], 0
        for piece in self._cut(text):
            own = self._piece(piece)
            counts += [before + x for x in own]
            before = counts[-1]
        return 1, _differences([*counts[:-1], 1])

    def of(self, text: str) -> tuple[int, bytes]:
        """Tokens of a text, and the steps of its prefixes: a byte a character of the normalised
        text, in which a run of white space is one character."""
        found = CHUNK.findall(text)
        solved = self.steps.get(found)
        lead = b"\x00" if text and not CHUNK.match(text) else b""
        tail = b"\x00" if found and not CHUNK.match(text[-1]) else b""
        return sum(n for n, _ in solved), lead + b"\x00".join([s for _, s in solved]) + tail


def prefix_counts(steps: bytes) -> np.ndarray:
    """Token count of every prefix, the empty one first."""
    return np.concatenate([[0], np.cumsum(np.frombuffer(steps, np.int8), dtype=np.int64)])


def longest_prefix(steps: bytes, budget: int) -> int:
    """Characters of the longest prefix that takes at most ``budget`` tokens."""
    return int(np.flatnonzero(prefix_counts(steps) <= budget)[-1])


def prefix_tables(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, steps`` of every whole text; null counts as empty.

    Ids may be null or repeat: every row gives a row. ``steps`` answers prefix questions through
    :func:`prefix_counts` and :func:`longest_prefix`.
    """
    schema = "doc_id long, n_bytes long, n_tokens long, steps binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = kept(PrefixCounter, path)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for at in range(0, batch.num_rows, 256):
                some = [t or "" for t in texts.slice(at, 256).to_pylist()]
                solved = [counter.of(t) for t in some]
                yield pa.record_batch([
                    ids.slice(at, 256), pa.array([len(t.encode()) for t in some], pa.int64()),
                    pa.array([n for n, _ in solved], pa.int64()), pa.array([s for _, s in solved], pa.binary()),
                ], ["doc_id", "n_bytes", "n_tokens", "steps"])

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, schema)


def token_counts(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Exact counts of every whole text and whether they exceed a limit."""
    return prefix_tables(documents, path).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
