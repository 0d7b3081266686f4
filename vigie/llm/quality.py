"""Quality rules, line first.

Every line is judged by punctuation, navigation and boilerplate rules, failing lines are removed,
and a document that loses too much of its text, or that fails the base rules on its words, is
rejected. All of it is column expressions; a document never leaves its row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigie.llm import common

#: Phrases of page furniture, lower case.
BOILERPLATE = (
    "accept all cookies", "all rights reserved", "click here to", "cookie policy", "enable javascript",
    "log in to", "privacy policy", "read more", "share this", "sign up for", "skip to content",
    "subscribe to", "terms of service", "use of cookies",
)
#: Separators between the entries of a menu.
SEPARATORS = r"(?<![^\x20\x09-\x0D])[|>»•·/]+(?![^\x20\x09-\x0D])"
MARKS = r"[!?.,;:]{2,}(?![^\x20\x09-\x0D])"
SAME_AGAIN = r"(?<![^\x20\x09-\x0D])([^\x20\x09-\x0D]+)(?=[\x20\x09-\x0D]+\1(?![^\x20\x09-\x0D]))"
SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class LineRules:
    """Limits of the line rules and of the final verdict."""

    symbols_per_word: float = 0.2   # symbol characters a word, more is noise
    marks_per_word: float = 0.5     # words that end in two marks or more, such as "SALE!!"
    separators_per_word: float = 0.2  # menu separators a word, more is navigation
    menu_words: int = 4             # from so many words on, a line can be a menu
    repeats_per_word: float = 0.5   # words equal to the word before, more is stuffing
    boilerplate_words: int = 30     # phrases of page furniture count in lines up to this length
    kept_share: float = 0.7         # least share of a document's word characters that must stay
    least_words: int = 50
    repeated_percent: int = 50      # most words in repeated windows, in percent


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def line_fails(line: Column, rules: LineRules = LineRules()) -> Column:
    """True if a line that has words breaks a rule."""
    n = F.greatest(_count(line, common.WORD), F.lit(1))
    lower = F.lower(line)
    furniture = F.lit(False)
    for phrase in BOILERPLATE:
        furniture = furniture | F.contains(lower, F.lit(phrase))
    return (
        (_count(line, SYMBOLS) > n * rules.symbols_per_word)
        | (_count(line, MARKS) > n * rules.marks_per_word)
        | ((n >= rules.menu_words) & (_count(line, SEPARATORS) > n * rules.separators_per_word))
        | (_count(line, SAME_AGAIN) > n * rules.repeats_per_word)
        | ((n <= rules.boilerplate_words) & furniture)
    )


def _has_word(line: Column) -> Column:
    return F.rlike(line, F.lit(r"[^\x20\x09-\x0D]"))


def _characters(text: Column) -> Column:
    """Code points in words."""
    return F.char_length(F.regexp_replace(text, common.GAP, ""))


def measure(documents: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Every document with its base figures, ``base_failed``, ``clean_text``, ``kept_share`` and ``kept``.

    Figures: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``. Null texts count as
    empty; documents without a word fail. ``clean_text`` holds the lines that pass, in order, with
    the wordless lines between them (null for a null text). Columns of these names are replaced.
    """
    made = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "clean_text", "kept_share", "kept"]
    base = documents.drop(*made)
    col = {n: common.fresh(base, f"q_{n}") for n in ("words", "lines", "ids", "worded", "runs", "order", "hits")}
    text = F.coalesce(F.col("text"), F.lit(""))
    split = base.withColumns({
        col["words"]: common.words(F.col("text")),
        col["lines"]: F.split(text, "\n"),
        "n_symbols": _count(text, SYMBOLS).cast("long"),
        "word_chars": _characters(text).cast("long"),
    })
    w = F.col(col["words"])
    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
    counted = split.withColumns({
        "n_words": F.size(w).cast("long"),
        col["runs"]: F.when(F.size(w) >= 4, windows).otherwise(F.array().cast("array<bigint>")),
        col["worded"]: F.filter(F.col(col["lines"]), _has_word),
    }).drop(col["words"])
    runs = F.col(col["runs"])
    # Most texts repeat few windows: sort plain hashes, and look for places only where there are repeats.
    sorted_runs = counted.withColumns({
        col["order"]: F.sort_array(runs),
        "n_dup_lines": (F.size(col["worded"]) - F.size(F.array_distinct(col["worded"]))).cast("long"),
    }).drop(col["worded"])
    order = F.col(col["order"])
    twice = sorted_runs.withColumn(
        col["ids"], F.array_distinct(F.filter(order, lambda x, i: (i > 0) & (x == F.get(order, i - 1))))
    ).drop(col["order"])
    ids = F.col(col["ids"])
    few = F.filter(F.transform(runs, lambda x, i: F.when(F.array_contains(ids, x), i)), lambda i: i.isNotNull())
    pairs = F.array_sort(F.transform(runs, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    placed = twice.withColumn(col["order"], F.when(F.size(ids) > 64, pairs))
    order = F.col(col["order"])
    equal = lambda p, j: (F.get(order, j)["x"] == p["x"])
    many = F.sort_array(F.transform(
        F.filter(order, lambda p, j: ((j > 0) & equal(p, j - 1)) | F.coalesce(equal(p, j + 1), F.lit(False))), lambda p: p["i"]
    ))
    hits = placed.withColumn(
        col["hits"], F.when(F.size(ids) == 0, F.array().cast("array<int>")).when(F.size(ids) <= 64, few).otherwise(many)
    ).drop(col["order"], col["ids"], col["runs"])
    at = F.col(col["hits"])
    covered = F.aggregate(
        at, F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(3), i - s["last"])).alias("n")),
        lambda s: s["n"],
    )
    lines = F.col(col["lines"])
    judged = hits.withColumns({
        "n_repeat_words": covered,
        "clean_text": F.when(F.col("text").isNotNull(), F.array_join(
            F.filter(lines, lambda x: ~_has_word(x) | ~line_fails(x, rules)), "\n")),
    }).drop(col["hits"], col["lines"])
    failed = (F.col("n_words") < rules.least_words) | (100 * F.col("n_repeat_words") > rules.repeated_percent * F.col("n_words"))
    share = F.when(F.col("word_chars") > 0, _characters(F.coalesce("clean_text", F.lit(""))) / F.col("word_chars")).otherwise(0.0)
    return (
        judged.withColumns({"base_failed": failed, "kept_share": share})
        .withColumn("kept", ~F.col("base_failed") & (F.col("kept_share") >= rules.kept_share))
    )


def clean(documents: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents that are kept, their text without the lines that fail; same columns."""
    judged = common.where_made(measure(documents, rules), F.col("kept"))
    return judged.withColumn("text", F.col("clean_text")).select(*documents.columns)
