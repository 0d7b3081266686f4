"""Benchmark decontamination by templates.

Benchmark items and documents are written as templates: numbers, names and units become typed
placeholders. Windows of template words are hashed and joined; windows on neighbouring diagonals
(place in the document less place in the item) belong to one copy of the item, so a copy may have
words put in or left out. Its slots must be filled consistently: one value of the item stands for
one value of the document, the one that most windows say, and windows that say otherwise do not
count. So a question asked again with other numbers or names is found, and a text that only has the
same form is not. Names are told by a capital inside a sentence; as a copy may lose its capitals,
windows whose names stay words in lower case are joined too.

A window that is mostly slots has too few words to tell a copy by its form: it must be met word for
word, its fillings included. So must a short item as a whole; the shortest, which occur inside
ordinary sentences, must also begin and end where a sentence or line does.

Documents keep only windows whose hash some item has. That set is sent to the tasks while its
counted size is small; beyond that every window goes into the join.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigie.llm import common, shingles
from vigie.llm.chunks import kept

WIDTH = 8
LEAST_WINDOWS = 6
LEAST_SHARE = 0.5
LEAST_COVER = 0.9
#: Items with fewer words must be met whole and word for word.
LEAST_WORDS = 13

#: Words that are units when they follow a number.
UNITS = frozenset(
    "% percent mm cm m km in ft yd mi inch inches foot feet yard yards mile miles mg g kg t lb lbs oz gram grams"
    " pound pounds ton tons ml cl l liter liters litre litres gallon gallons s sec second seconds min minute"
    " minutes h hr hour hours day days week weeks month months year years cent cents dollar dollars euro euros"
    " usd eur gbp degree degrees mph kmh watt watts volt volts".split()
)
EDGES = "\"'`()[]{}<>.,;:!?…«»“”‘’*_"
WHITE = "\t\n\x0b\x0c\r "
BLANK = re.compile(r"[\t-\r ]+")
NUMBER = regex.compile(r"[+\-±]?[$€£]?\d[\d.,:/]*%?")
BARE, NUM, UNIT, NAME = 0, 1, 2, 3
LITERAL, WHOLE = 1_000, 2_000
SLOT_HASH = shingles.mix64(np.arange(101, 105, dtype=np.uint64))

class Words:
    """What the template needs to know of each word form: its hash and its kind, kept once per task."""

    NUMBER, UNIT, NAME, ENDS = 1, 2, 4, 8

    def __init__(self, most: int = 200_000):
        self.most = most
        self.place: dict[str, int] = {}
        self.hash = np.empty(0, np.uint64)
        self.flags = np.empty(0, np.uint8)

    def of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Hash and flags of each word."""
        if len(self.place) > self.most:
            self.place, self.hash, self.flags = {}, self.hash[:0], self.flags[:0]
        place = self.place
        new = list(set(words).difference(place))
        if new:
            bare = [w.strip(EDGES) or w for w in new]
            # Cores hold no ASCII white space, so each is one word.
            hashes, _ = shingles.word_hashes(bare)
            flags = np.fromiter(map(self._flags, new, bare), np.uint8, len(new))
            place.update(zip(new, range(len(self.hash), len(self.hash) + len(new))))
            self.hash, self.flags = np.concatenate([self.hash, hashes]), np.concatenate([self.flags, flags])
        at = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
        return self.hash[at], self.flags[at]

    def _flags(self, word: str, core: str) -> int:
        number = core[:1] in "+-±$€£0123456789" and NUMBER.fullmatch(core) is not None
        return (
            self.NUMBER * number + self.UNIT * (core.lower() in UNITS)
            + self.NAME * (core[:1].isupper() and not core.isupper())
            + self.ENDS * (word.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", ":", "…"))
        )


class Batch:
    """The words of some texts as templates: with names as words, and with names as slots."""

    def __init__(self, texts: list[str], known: Words):
        self.words: list[str] = []
        opens, sizes = [], []
        for text in texts:
            before = len(self.words)
            for line in text.split("\n"):
                own = BLANK.split(line.strip(WHITE)) if line.strip(WHITE) else ()
                if own:
                    opens.append(len(self.words))
                    self.words += own
            sizes.append(len(self.words) - before)
        self.text = np.repeat(np.arange(len(texts)), sizes)
        self.first = np.concatenate([[0], np.cumsum(sizes)])
        hashes, flags = known.of(self.words)
        number = flags & Words.NUMBER > 0
        follows = np.concatenate([[False], number[:-1]])[:len(number)]
        start = np.concatenate([[True], flags[:-1] & Words.ENDS > 0])[:len(flags)]
        start[opens] = True
        self.start, self.end = start, np.concatenate([start[1:], [True]])[:len(start)]
        self.kinds = np.where(number, NUM, np.where((flags & Words.UNIT > 0) & follows, UNIT, BARE)).astype(np.int8)
        self.named = np.where((self.kinds == BARE) & (flags & Words.NAME > 0) & ~start, NAME, self.kinds).astype(np.int8)
        self.word_hash = hashes
        self.plain_hash = np.where(self.kinds > 0, SLOT_HASH[self.kinds], hashes)
        self.named_hash = np.where(self.named > 0, SLOT_HASH[self.named], hashes)
        self.literal = np.zeros(len(number), np.int8)

    def _inside(self, width: int) -> np.ndarray:
        """Places where a window of one text begins."""
        n = max(len(self.words) - width + 1, 0)
        return np.flatnonzero(self.text[:n] == self.text[width - 1:][:n])

    def windows(self, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Hashes, places and slot kinds of all windows, again of those that hold a name, and word for
        word of those that are mostly slots."""
        inside = self._inside(width)
        for kinds, hashes in ((self.kinds, self.plain_hash), (self.named, self.named_hash)):
            at = inside
            if kinds is self.named:
                names = np.concatenate([[0], np.cumsum(kinds == NAME)])
                at = at[names[at + width] > names[at]]
            slots = np.concatenate([[0], np.cumsum(kinds > 0)])
            formed = (slots[at + width] - slots[at]) * 2 <= width
            if kinds is self.kinds and not formed.all():
                yield self._hashed(self.word_hash, at[~formed], width, LITERAL), at[~formed], self.literal
            yield self._hashed(hashes, at[formed], width, 0), at[formed], kinds

    def whole(self, width: int, bounded: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same word for word, of every window; ``bounded`` ones lie between ends of sentences or lines."""
        at = self._inside(width)
        if bounded:
            at = at[self.start[at] & self.end[at + width - 1]]
        return self._hashed(self.word_hash, at, width, WHOLE), at, self.literal

    def _hashed(self, hashes: np.ndarray, at: np.ndarray, width: int, kind: int) -> np.ndarray:
        n = max(len(self.words) - width + 1, 0)
        value = np.full(n if len(at) * 4 > n else len(at), width + kind, np.uint64)
        for k in range(width):  # most places: by slices, then pick
            value += (hashes[k:k + n] if len(at) * 4 > n else hashes[at + k]) * shingles.PLACES[k]
        return shingles.mix64(value[at] if len(at) * 4 > n else value).view(np.int64)


def _slots(words: list[str], kinds: np.ndarray, at: int, width: int) -> list[str]:
    return [f"{kinds[i]}{words[i].strip(EDGES).lower()}" for i in range(at, at + width) if kinds[i]]


def _window_rows(texts: DataFrame, width: int, whole: list[int], wanted) -> DataFrame:
    """Windows ``hash, at, slots`` of every text beside its id: those of ``width`` if it is not 0, and
    runs of as many words as ``whole`` says; with ``wanted``, only windows of these hashes."""
    names = [texts.columns[0], "hash", "at", "slots"]
    schema = T.StructType([texts.schema[0], *T.StructType.fromDDL("hash long, at int, slots array<string>")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = kept(Words)
        for batch in batches:
            for start in range(0, batch.num_rows, 64):
                some = Batch(batch.column(1).slice(start, 64).to_pylist(), known)
                owner, hashes, places, slots = [], [], [], []
                found = itertools.chain(some.windows(width) if width else (), (some.whole(w, w < WIDTH) for w in whole))
                for value, at, kinds in found:
                    if wanted is not None:
                        spot = np.searchsorted(wanted.value, value)
                        spot[spot == len(wanted.value)] = 0
                        hit = wanted.value[spot] == value
                        value, at = value[hit], at[hit]
                    text = some.text[at]
                    owner += (text + start).tolist()
                    hashes += value.tolist()
                    places += (at - some.first[text]).tolist()
                    slots += [[]] * len(at) if kinds is some.literal else [_slots(some.words, kinds, a, width) for a in at.tolist()]
                if owner:
                    columns = [pa.array(hashes, pa.int64()), pa.array(places, pa.int32()), pa.array(slots, pa.list_(pa.string()))]
                    yield pa.record_batch([batch.column(0).take(pa.array(owner)), *columns], names)

    return texts.mapInArrow(work, schema)


def contaminated(
    documents: DataFrame, benchmark: DataFrame, folder: str, width: int = WIDTH, least_windows: int = LEAST_WINDOWS,
    least_share: float = LEAST_SHARE, least_cover: float = LEAST_COVER, least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``doc_id, item_id, windows, share, changed`` of documents that hold a benchmark item.

    An item counts as held if one copy of it in the document has ``least_windows`` of its windows, or
    ``least_share`` of them, with consistent slots, or if its windows there cover ``least_cover`` of its
    words. Items of fewer than ``least_words`` words are one window and must be there word for word, and
    under eight words also from the beginning to the end of a sentence or line; capitals and signs
    around a word do not matter. ``changed`` says that slots of the windows that count are filled
    otherwise. Ids may have any type. Items without words, texts without words and rows without an id
    have no result. Rows that repeat an id are looked at together.
    """
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    size = common.word_count(F.col("text")).cast("int")
    short = items.where((size > 0) & (size < least_words))
    whole = sorted(r[0] for r in short.select(size.alias("w")).distinct().collect())  # fewer than `least_words` numbers
    bench = _window_rows(items.where(size >= max(least_words, width)), width, [], None)
    for w in whole:
        bench = bench.union(_window_rows(short.where(size == w), 0, [w], None).where("at = 0"))
    bench = bench.withColumnsRenamed({"at": "item_at", "slots": "item_slots"})
    bench = common.stored(bench.distinct(), folder, "benchmark")
    hashes = common.stored(bench.select("hash").distinct(), folder, "hashes")
    small = common.small_enough(hashes.count(), 8)
    wanted = None
    if small:  # counted above: at most a few MB
        values = np.sort(np.array([r[0] for r in hashes.toLocalIterator()], np.int64))
        wanted = documents.sparkSession.sparkContext.broadcast(values if len(values) else np.zeros(1, np.int64))
    texts = documents.select("doc_id", F.col("text").cast("string").alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    hits = _window_rows(texts, width, whole, wanted).distinct()

    totals = bench.groupBy("item_id").agg(F.countDistinct("item_at").alias("item_windows"), (F.max("item_at") + width).alias("item_words"))
    matched = hits.join(common.light(bench, 256), "hash").where(F.size("slots") == F.size("item_slots"))
    # One copy: diagonals that follow each other within a window's width.
    line = Window.partitionBy("doc_id", "item_id").orderBy("diagonal")
    so_far = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    matched = (
        matched.withColumn("diagonal", F.col("at") - F.col("item_at"))
        .withColumn("apart", (F.col("diagonal") - F.lag("diagonal").over(line) > width).cast("int"))
        .withColumn("copy", F.coalesce(F.sum("apart").over(so_far), F.lit(0)))
        .select("doc_id", "item_id", "copy", "item_at", F.arrays_zip(F.col("item_slots").alias("i"), F.col("slots").alias("d")).alias("fills"))
    )
    matched = common.stored(matched, folder, "matched")
    copy = ["doc_id", "item_id", "copy"]
    said = matched.select(*copy, F.explode("fills").alias("fill")).groupBy(*copy, "fill").agg(F.count("*").alias("n"))
    order = F.struct("n", F.col("fill.i") == F.col("fill.d"), "fill.d")
    chosen = said.groupBy(*copy, "fill.i").agg(F.max_by("fill", order).alias("fill")).groupBy(*copy).agg(F.collect_list("fill").alias("chosen"))
    counting = matched.join(chosen, copy, "left").where("size(array_except(fills, coalesce(chosen, array()))) = 0")
    copies = counting.groupBy(*copy).agg(
        F.array_sort(F.collect_set("item_at")).alias("places"),  # no more than the item has
        F.max(F.exists("fills", lambda f: f["i"] != f["d"])).alias("changed"),
    ).withColumn("windows", F.size("places").cast("long"))
    # The last place has none after it; `least` alone would make a whole window of that null.
    steps = F.zip_with(F.slice("places", 2, F.size("places")), F.col("places"), lambda b, a: F.when(b.isNotNull(), F.least(b - a, F.lit(width))))
    covered = width + F.aggregate(steps, F.lit(0), lambda total, step: total + F.coalesce(step, F.lit(0)))
    judged = (
        copies.join(F.broadcast(totals) if small else totals, "item_id")
        .where(
            (F.col("windows") >= least_windows) | (F.col("windows") >= least_share * F.col("item_windows"))
            | (covered >= least_cover * F.col("item_words")))
        .select("doc_id", "item_id", "windows", (F.col("windows") / F.col("item_windows")).alias("share"), "changed")
    )
    return judged.groupBy("doc_id", "item_id").agg(
        F.max("windows").alias("windows"), F.max("share").alias("share"), F.min("changed").alias("changed"))


def without_benchmark(documents: DataFrame, benchmark: DataFrame, folder: str) -> DataFrame:
    """The documents that hold no benchmark item, each row by its own text; rows with a null text stay."""
    text, by_text = F.col("text").cast("string"), common.fresh(documents, "digest")
    keyed = documents.select(F.md5(text.cast("binary")).alias("doc_id"), text.alias("text"))
    found = contaminated(keyed, benchmark, folder).select(F.col("doc_id").alias(by_text)).distinct()
    found = common.light(common.stored(found, folder, "contaminated"), 48)
    return documents.withColumn(by_text, F.md5(text.cast("binary"))).join(found, by_text, "left_anti").select(*documents.columns)
