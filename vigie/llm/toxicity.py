"""Toxicity by a weighted lexicon.

Texts are folded: lower case, look-alike letters of other scripts to Latin, digits and signs inside
words to the letters they stand for. An Aho-Corasick automaton finds the lexicon's stems at word
starts in one pass; stems inside an exception phrase do not count. The sum of the weights of the
distinct stems found, divided by a slowly growing function of the length, goes through a logistic
curve to give the score.

Stems and weights come from labelled texts: stems that stand in many toxic texts and hardly in
others. Learning reads a bounded sample of the labelled rows, of which copies count once; scoring
reads every whole text.
"""

from __future__ import annotations

import json
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.llm import common, shingles

#: At most about so many labelled rows are read for learning, chosen by a hash of their id.
SAMPLE_ROWS = 40_000
LEAST_TEXTS = 5
LEAST_WEIGHT = 2.5
STEM_LENGTHS = range(4, 11)

#: Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅰ": "i", "ⅼ": "l", "ｏ": "o",
}
#: Signs that stand for letters inside words; a 1 may be an i or an l.
SIGNS = {"0": "o", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i"}
#: Harmless phrases around words that are often meant as insults.
EXCEPTIONS = (
    "clown fish", "clownfish", "trash can", "trash bin", "sore loser", "idiot proof", "stupid question", "scum line",
    "weltschmerz",
)
_FOREIGN = regex.compile(r"[ıɑɡͰ-ϿЀ-ԯⅠ-ⅿ＀-￯​-‏­⁠﻿]")
#: A run of letters and signs that has both; looked for at the start of runs only, so long runs cost one pass.
_DISGUISED = regex.compile(r"(?<![\p{L}0-9@$!])(?:\p{L}++[0-9@$!]|[0-9@$!]++\p{L})[\p{L}0-9@$!]*+")
_WORD = regex.compile(r"[\p{L}\p{M}]+")
_TABLE = str.maketrans(
    LOOK_ALIKES
    | {chr(0xFF01 + k): chr(0x21 + k).lower() for k in range(94)}
    | dict.fromkeys("​‌‍‎‏­⁠﻿", "")
)
_PLAIN = str.maketrans(SIGNS)


def fold(text: str) -> str:
    """The text in lower case and Latin letters, with the readings of disguised words at its end."""
    text = text.lower()
    if not text.isascii() and _FOREIGN.search(text):
        text = text.translate(_TABLE)
    read = []
    for word in dict.fromkeys(_DISGUISED.findall(text)):
        bare = word.rstrip("!").translate(_PLAIN)
        read += [bare.replace("1", "i"), bare.replace("1", "l")] if "1" in bare else [bare]
    return f"{text}\n{' '.join(read)}" if read else text


@dataclass
class Lexicon:
    """Stems with weights, and the curve from rate to score."""

    stems: dict[str, float] = field(default_factory=dict)
    slope: float = 4.0
    offset: float = -4.0
    exceptions: tuple[str, ...] = EXCEPTIONS

    def matcher(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for stem, weight in self.stems.items():
            found.add_word(stem, (stem, weight))
        for phrase in self.exceptions:
            if phrase not in self.stems:
                found.add_word(phrase, (phrase, None))
        if len(found):
            found.make_automaton()
        return found

    def rate(self, matcher, text: str) -> float:
        """Weight of the distinct stems of a text over its damped length."""
        if not len(matcher) or not text:
            return 0.0
        folded = fold(text)
        stems: list[tuple[int, str, float]] = []
        spared: list[tuple[int, int]] = []
        for end, (stem, weight) in matcher.iter(folded):
            start = end - len(stem) + 1
            if start and folded[start - 1].isalpha():
                continue
            if weight is None:
                if end + 1 == len(folded) or not folded[end + 1].isalpha():
                    spared.append((start, end))
            else:
                stems.append((start, stem, weight))
        hit = {stem: weight for start, stem, weight in stems if not any(a <= start <= b for a, b in spared)}
        return sum(hit.values()) / damped(len(folded)) if hit else 0.0

    def score(self, rate: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * rate + self.offset)))


def damped(length: int) -> float:
    """Grows by one with every doubling of the length beyond about a paragraph."""
    return 1 + math.log2(1 + length / 500)


def _stems(word: str) -> list[str]:
    return [word[:n] for n in STEM_LENGTHS if n <= len(word)]


def _counts(texts: DataFrame) -> DataFrame:
    """``stem, n``: texts that have a word with the stem."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count: Counter = Counter()
            for text in batch.column(0):
                words = set(_WORD.findall(fold(text.as_py())))
                count.update({s for w in words for s in _stems(w)})
            yield pa.record_batch([pa.array(list(count), pa.string()), pa.array(list(count.values()), pa.int64())], ["stem", "n"])

    return texts.select("text").mapInArrow(work, "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))


def _keys(rows: DataFrame) -> DataFrame:
    """The rows with ``copy_key``: most near copies of a text share its smallest window hash."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value, text = shingles.windows(*shingles.word_hashes(batch.column(0).to_pylist()), 5)
            least = np.full(batch.num_rows, np.iinfo(np.uint64).max, np.uint64)
            np.minimum.at(least, text, value)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(least.view(np.int64))], ["text", "toxic", "copy_key"])

    return rows.select("text", "toxic").mapInArrow(work, "text string, toxic int, copy_key long")


def telling_stems(toxic: DataFrame, clean: DataFrame, n_toxic: int, n_clean: int) -> DataFrame:
    """``stem, n, m, weight`` of the stems that tell toxic texts (in ``n`` of them) from clean ones (``m``).

    The weight is the log of the ratio of the two shares of texts, each with half a text added.
    """
    both = toxic.where(F.col("n") >= LEAST_TEXTS).join(clean.withColumnRenamed("n", "m"), "stem", "left").fillna(0, ["m"])
    ratio = F.log((F.col("n") + 0.5) / (n_toxic + 1)) - F.log((F.col("m") + 0.5) / (n_clean + 1))
    return both.withColumn("weight", ratio).where((F.col("weight") >= LEAST_WEIGHT) & (F.col("m") * 4 <= F.col("n")))


def choose_stems(toxic: dict[str, int], weight: dict[str, float]) -> dict[str, float]:
    """Of telling stems that begin alike, the shortest, grown by the letters that nearly all of its
    toxic texts agree on."""
    longer: dict[str, list[str]] = {}
    for s in sorted(toxic):
        longer.setdefault(s[:-1], []).append(s)
    chosen: dict[str, float] = {}
    roots: set[str] = set()
    for stem in sorted(toxic, key=lambda s: (len(s), s)):
        if any(stem[:n] in roots for n in range(1, len(stem))):
            continue
        grown = stem
        while more := [s for s in longer.get(grown, ()) if toxic[s] >= 0.95 * toxic[stem]]:
            grown = more[0]
        chosen[grown] = weight[grown]
        roots.add(stem)
    return chosen


def fit_curve(rate: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, kept finite by a small penalty on the slope."""
    x = np.stack([rate, np.ones_like(rate)], axis=1)
    w = np.array([1.0, -2.0])
    penalty = np.diag([1e-3 * len(rate), 1e-6]) / 100
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(2), x.T @ (p - label) + penalty @ w)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def learn(documents: DataFrame, labels: DataFrame, folder: str, sample_rows: int = SAMPLE_ROWS) -> Lexicon:
    """A lexicon from ``doc_id, text`` and ``doc_id, toxic``; rows without id, text or label are left out.

    The labelled ids are sampled first, by a hash, and sent to the texts while they are few, so that no
    other text moves. Near copies of one label count once. Ids that repeat stand for each of their rows
    and labels. All stems of the sample are weighed where they are counted; only telling ones, and one
    rate and label a sampled row, come to the driver. With texts of one class only the lexicon stays
    empty and every score is the share of that class's prior.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.where("doc_id IS NOT NULL AND toxic IS NOT NULL").distinct()
    share = min(1.0, sample_rows / max(marked.count(), 1))
    chosen = marked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    chosen = common.light(common.stored(chosen, folder, "chosen"))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    rows = _keys(texts.join(chosen, "doc_id").select("text", "toxic"))
    rows = rows.groupBy("copy_key", "toxic").agg(F.min("text").alias("text"))
    rows = common.stored(rows.select("text", "toxic"), folder, "labelled")
    sizes = {r[0]: r[1] for r in rows.groupBy((F.col("toxic") > 0).cast("int")).count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    lexicon = Lexicon()
    if not n_toxic or not n_clean:
        lexicon.slope, lexicon.offset = 1.0, math.log((n_toxic + 0.5) / (n_clean + 0.5)) if n_toxic + n_clean else -1.0
        return lexicon
    found = telling_stems(_counts(rows.where("toxic > 0")), _counts(rows.where("toxic <= 0")), n_toxic, n_clean).collect()
    lexicon.stems = choose_stems({r["stem"]: r["n"] for r in found}, {r["stem"]: r["weight"] for r in found})
    rates = _rates(rows.select(F.lit(0).cast("long").alias("doc_id"), "text", "toxic"), lexicon).select("rate", "toxic").collect()
    lexicon.slope, lexicon.offset = fit_curve(np.array([r[0] for r in rates]), np.array([float(r[1] > 0) for r in rates]))
    return lexicon


def _rates(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, toxic, rate`` of rows ``doc_id, text, toxic``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = lexicon.matcher()
        for batch in batches:
            rate = [lexicon.rate(matcher, t.as_py() or "") for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), batch.column(2), pa.array(rate, pa.float64())], ["doc_id", "toxic", "rate"])

    return rows.select("doc_id", "text", "toxic").mapInArrow(work, "doc_id long, toxic int, rate double")


def score(documents: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, rate, score, predicted`` of every row; null and empty texts have rate 0.

    Only the text is read. Ids may be null or repeat: every row gives a row.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.lit(0).alias("toxic"))
    curve = 1 / (1 + F.exp(-(F.lit(lexicon.slope) * F.col("rate") + F.lit(lexicon.offset))))
    return _rates(rows, lexicon).select("doc_id", "rate", curve.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def as_json(lexicon: Lexicon) -> str:
    return json.dumps({"stems": lexicon.stems, "slope": lexicon.slope, "offset": lexicon.offset, "exceptions": lexicon.exceptions}, ensure_ascii=False)
