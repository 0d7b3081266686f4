"""Line dedup by log templates.

Lines are parsed into a tree of fixed depth: number of words, then the leading words, in which
anything with a digit is a variable. The lines of a leaf share a template where they agree: at each
place, a word stays if it stands there in a share of the leaf's documents, and becomes a variable
otherwise, so a template is the same in a hundred documents and in a million. A line with too few
words left is its own template. Templates that recur in enough documents are boilerplate, and their
lines are dropped everywhere; the longer a line, the fewer documents are enough.

Leaves are counted, never gathered: equal lines become one row with its number of documents before
words are looked at, words are counted by leaf and place, and a leaf's constants go to its distinct
lines as one list. Texts are parsed once into a table of digests, again for the words of leaves that
hold several lines, and when lines are dropped.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vigie.llm import common

DEPTH = 3
LEAST_DOCUMENTS = 5
#: From so many words on, a line needs no more documents than these.
FEWER = ((50, 2), (20, 3))
WORD_SHARE = 0.1
CONSTANT_SHARE = 0.6
VARIABLE = b"<*>"
DIGIT = re.compile(rb"[0-9]")
TEXTS_AT_ONCE = 256
LINES = "doc_id long, text_key binary, place int, leaf long, mark binary, size int"


def masked(line: bytes) -> list[bytes]:
    """The line's words, those with a digit as variables; ``bytes.split`` cuts at ASCII white space alone."""
    words = line.split()
    if DIGIT.search(line):
        words = [VARIABLE if DIGIT.search(w) else w for w in words]
    return words


def digest(data: bytes) -> bytes:
    return hashlib.md5(data, usedforsecurity=False).digest()


def _leaf(words: list[bytes], depth: int) -> int:
    head = b"%d\n%b" % (len(words), b"\n".join(words[:depth]))
    return int.from_bytes(hashlib.blake2b(head, digest_size=8).digest(), "little", signed=True)


def _parsed(documents: DataFrame, depth: int) -> DataFrame:
    """A row for each line with a word: its text's digest, its leaf, and the digest and number of its masked words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in LINES.split(", ")]
        kinds = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.int32()]
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(at, TEXTS_AT_ONCE)
                rows = []
                for doc_id, text in zip(some.column(0).to_pylist(), some.column(1)):
                    data = text.as_py()
                    key = digest(data)
                    for place, line in enumerate(data.split(b"\n")):
                        words = masked(line)
                        if words:
                            rows.append((doc_id, key, place, _leaf(words, depth), digest(b" ".join(words)), len(words)))
                columns = zip(*rows) if rows else [[]] * len(names)
                yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    texts = documents.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(work, LINES)


def _lines_of(documents: DataFrame, leaves: DataFrame, depth: int) -> DataFrame:
    """The distinct lines ``leaf, mark, line`` (masked) of the given leaves; their number is counted first."""
    few = common.small_enough(leaves.count(), 8)
    wanted = documents.sparkSession.sparkContext.broadcast(frozenset(r[0] for r in leaves.toLocalIterator())) if few else None

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                found = {}
                for text in batch.column(0).slice(at, TEXTS_AT_ONCE):
                    for line in text.as_py().split(b"\n"):
                        words = masked(line)
                        if words:
                            leaf = _leaf(words, depth)
                            if wanted is None or leaf in wanted.value:
                                found[leaf, b" ".join(words)] = None
                leaf, line = zip(*found) if found else ((), ())
                columns = [pa.array(leaf, pa.int64()), pa.array(map(digest, line), pa.binary()), pa.array([x.decode() for x in line], pa.string())]
                yield pa.record_batch(columns, ["leaf", "mark", "line"])

    texts = documents.where("text IS NOT NULL AND doc_id IS NOT NULL").select(F.col("text").cast("binary").alias("text"))
    lines = texts.mapInArrow(work, "leaf long, mark binary, line string")
    return (lines if few else lines.join(leaves, "leaf", "left_semi")).dropDuplicates(["leaf", "mark"])


def recurring(
    documents: DataFrame, folder: str, depth: int = DEPTH, least_documents: int = LEAST_DOCUMENTS, constant_share: float = CONSTANT_SHARE,
    word_share: float = WORD_SHARE, fewer: tuple[tuple[int, int], ...] = FEWER,
) -> DataFrame:
    """``leaf, mark, template, documents``: lines (by the digest of their masked words) that are to go.

    A line goes if its template is in ``least_documents``, or in those that ``fewer`` asks of its number
    of words. A word is a constant of its place if as many documents, and ``word_share`` of the leaf's,
    have it there. Only rows with an id count as documents; a document counts once, however often it has
    a line. Lines without a word are never templates.
    """
    least = F.lit(least_documents)
    for words, documents_of in sorted(fewer):
        least = F.when(F.col("size") >= words, min(documents_of, least_documents)).otherwise(least)
    lines = common.stored(_parsed(documents, depth), folder, "parsed").where("doc_id IS NOT NULL")

    # Leaves with enough documents, then their distinct lines.
    busy = lines.select("leaf", "size", "doc_id").distinct().groupBy("leaf", "size").agg(F.count("*").alias("in_leaf"))
    busy = busy.select("leaf", "in_leaf", least.alias("least")).where("in_leaf >= least")
    busy = common.light(common.stored(busy, folder, "busy"), 24)
    seen = common.stored(lines.select("leaf", "mark", "doc_id").join(busy, "leaf", "left_semi").distinct(), folder, "seen")
    marks = seen.groupBy("leaf", "mark").agg(F.count("*").alias("n")).join(busy, "leaf")
    several = marks.groupBy("leaf").agg(F.count("*").alias("kinds")).where("kinds > 1").select("leaf")
    several = common.stored(several, folder, "several")
    texts = _lines_of(documents, several, depth)
    several = common.light(several)
    literal = marks.join(several, "leaf", "left_anti").where("n >= least").select(
        "leaf", "mark", F.col("mark").alias("template"), F.col("n").alias("documents"))

    # Where a leaf has several lines, a word stays if enough of its documents have it there.
    texts = texts.join(marks, ["leaf", "mark"]).select("leaf", "mark", "n", F.split("line", " ").alias("words"))
    texts = common.stored(texts, folder, "texts")
    codes = F.transform("words", lambda word, place: F.xxhash64(place, word))
    counts = texts.select("leaf", "n", F.explode(codes).alias("code")).groupBy("leaf", "code").agg(F.sum("n").alias("n"))
    counts = counts.join(busy, "leaf").where((F.col("n") >= F.col("least")) & (F.col("n") >= word_share * F.col("in_leaf")))
    # Each word needs its share of the leaf, so a place of a line has few of them.
    constants = counts.groupBy("leaf").agg(F.collect_list("code").alias("constants"))
    own = F.array_intersect(codes, F.coalesce("constants", F.array().cast("array<long>")))
    held = texts.join(constants, "leaf", "left").select("leaf", "mark", F.size("words").alias("size"), own.alias("own"))
    pattern = F.unhex(F.md5(F.concat_ws(" ", F.col("own").cast("array<string>"), F.col("size").cast("string")).cast("binary")))
    template = F.when(F.size("own") >= F.col("size") * constant_share, pattern).otherwise(F.col("mark"))
    templates = common.stored(held.select("leaf", "mark", template.alias("template")), folder, "templates")
    counted = (
        seen.join(several, "leaf", "left_semi").join(templates, ["leaf", "mark"])
        .select("leaf", "template", "doc_id").distinct()
        .groupBy("leaf", "template").agg(F.count("*").alias("documents")).join(busy, "leaf").where("documents >= least")
        .select("leaf", "template", "documents")
    )
    general = templates.join(counted, ["leaf", "template"]).select("leaf", "mark", "template", "documents")
    return common.stored(literal.union(general), folder, "recurring")


def _dropped(documents: DataFrame, bad: frozenset) -> DataFrame:
    """The result where the recurring lines are few enough to be in every worker: texts stay where they are."""
    known = documents.sparkSession.sparkContext.broadcast(bad)
    text = documents.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gone = known.value
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(at, TEXTS_AT_ONCE)
                n_lines, n_dropped, clean = [], [], []
                for value in some.column(text).cast(pa.binary()):
                    data = value.as_py()
                    seen, left = 0, []
                    lines = [] if data is None else data.split(b"\n")
                    for line in lines:
                        words = masked(line)
                        seen += bool(words)
                        if not words or digest(b" ".join(words)) not in gone:
                            left.append(line)
                    n_lines.append(seen)
                    n_dropped.append(len(lines) - len(left))
                    clean.append(None if data is None else b"\n".join(left).decode())
                more = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(clean, pa.string())]
                yield pa.record_batch([*some.columns, *more], [*some.schema.names, "n_lines", "n_dropped", "clean_text"])

    more = StructType().add("n_lines", "long").add("n_dropped", "long").add("clean_text", "string")
    schema = StructType([*documents.schema.fields, *more.fields])
    return documents.mapInArrow(work, schema)


def without_recurring(documents: DataFrame, folder: str, depth: int = DEPTH, **limits) -> DataFrame:
    """Every document with ``n_lines`` (with a word), ``n_dropped`` and ``clean_text``.

    A line goes or stays by its content alone, so rows that share a text are treated alike, with or
    without an id. Null texts stay null. Columns of these names are replaced.
    """
    documents = documents.drop("n_lines", "n_dropped", "clean_text")
    bad = common.stored(recurring(documents, folder, depth, **limits).select("mark").distinct(), folder, "bad")
    if common.small_enough(bad.count(), 16):  # counted: at most 8 MB of digests
        return _dropped(documents, frozenset(bytes(r[0]) for r in bad.toLocalIterator()))
    names = {n: common.fresh(documents, n) for n in ("text_key", "gone")}
    lines = documents.sparkSession.read.schema(LINES).parquet(f"{folder}/parsed")
    gone = lines.join(bad, "mark", "left_semi").groupBy(F.col("text_key").alias(names["text_key"])).agg(
        F.sort_array(F.collect_set("place")).alias(names["gone"]))
    split = F.split("text", "\n")
    none = F.array().cast("array<int>")
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.coalesce(F.col(names["gone"]), none))
    return (
        documents.withColumn(names["text_key"], F.unhex(F.md5(F.col("text").cast("binary")))).join(gone, names["text_key"], "left")
        .withColumns({
            "n_lines": F.coalesce(F.size(F.filter(split, lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))), F.lit(0)).cast("long"),
            "n_dropped": F.coalesce(F.size(names["gone"]), F.lit(0)).cast("long"),
            "clean_text": F.array_join(F.transform(left, lambda i: F.get(split, i)), "\n"),
        })
        .drop(*names.values())
    )
