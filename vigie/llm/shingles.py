"""Hashes of words and of word windows for whole batches of texts, by arrays."""

from __future__ import annotations

import numpy as np

_rng = np.random.default_rng(20)
BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
PLACES = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
PIECE = 1 << 21

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """A well spread one-to-one map of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every word of the texts, case folded, and the first word's place of each text.

    Words are runs of anything but ASCII white space. The texts are laid end to end and hashed in
    one pass: the hash of a word is a difference of running sums of its bytes' values.
    """
    data = [t.lower().encode("utf-8", "surrogatepass") for t in texts]
    hashes, counts = [], np.zeros(len(texts) + 1, np.int64)
    some: list[int] = []
    size = 0
    for i, d in enumerate([*data, None]):
        if d is None or size + len(d) > PIECE and some:
            if some:
                found, owner = _hash_bytes(b"\n".join([data[k] for k in some]), np.array([len(data[k]) + 1 for k in some]))
                hashes.append(found)
                counts[np.array(some) + 1] = np.bincount(owner, minlength=len(some))
            some, size = [], 0
        if d is not None:
            some.append(i)
            size += len(d) + 1
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), np.cumsum(counts)


def _hash_bytes(data: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    buffer = np.frombuffer(data, np.uint8)
    inside = np.concatenate([[False], ~BLANK[buffer], [False]])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edge[0::2], edge[1::2]
    sums = np.empty(len(buffer) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(BYTE_VALUES[buffer] * _powers(BASE, max(len(buffer), 1))[:len(buffer)], dtype=np.uint64, out=sums[1:])
    back = _powers(INVERSE, len(buffer) + 1)
    words = (sums[ends] - sums[starts]) * back[starts]
    return mix64(words), np.searchsorted(np.cumsum(sizes), starts, "right")


def windows(words: np.ndarray, starts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of every window of ``width`` words; a shorter text is one window."""
    sizes = np.diff(starts)
    text = np.repeat(np.arange(len(sizes)), np.maximum(sizes - width + 1, 0))
    first = np.flatnonzero(np.arange(len(words)) + width <= np.repeat(starts[1:], sizes))
    value = np.zeros(len(first), np.uint64)
    for k in range(width):
        value += words[first + k] * PLACES[k]
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    small = np.array([np.sum(words[starts[i]:starts[i + 1]] * PLACES[:sizes[i]], dtype=np.uint64) for i in short], np.uint64)
    if len(short):
        text, value = np.concatenate([text, short]), np.concatenate([value, small])
    return mix64(value), text


def weighted(value: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct windows of each text: hash, text number, weight 1 + ln(count), by text.

    At most 65 536 texts. Windows are told apart by 48 bits within a text.
    """
    key = np.sort((text.astype(np.uint64) << np.uint64(48)) | (value >> np.uint64(16)))
    if not len(key):
        return key, text[:0], np.empty(0)
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    count = np.diff(np.append(new, len(key)))
    key = key[new]
    return key & np.uint64((1 << 48) - 1), (key >> np.uint64(48)).astype(np.int64), 1 + np.log(count)
