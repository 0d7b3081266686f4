"""Streams that keep results current.

Inputs are file streams. Every micro-batch writes a small additive partial result into
its own ``batch_id`` partition, replacing that partition if the batch is retried, so a
restart neither loses nor doubles anything. A new checkpoint would number its batches anew and
replace old partials, so it is refused over an output that has some. Readers add the partials up. A batch costs
what it brings, not what was stored before; ``compact`` folds old partials together.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from vigie.functions import temporal as T
from vigie.functions.measures import ROWS, named, total
from vigie.operators.counters import COUNTERS, counter_terms, persons_by_case, with_outcome_code
from vigie.operators.rollup import ALERT, SUMS, grouped


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream a Parquet file or folder. The path goes in as a glob, which admits both."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    head, _, tail = path.rstrip("/").rpartition("/")
    return reader.parquet(f"{head}/[{tail[0]}]{tail[1:]}")


def _write_partial(partial: DataFrame, out: str, batch_id: int) -> None:
    partial.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; listing it starts no job."""
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def run_partials(stream: DataFrame, reduce_batch: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Reduce each micro-batch and store it as that batch's partial result."""
    if _exists(stream.sparkSession, out) and not _exists(stream.sparkSession, f"{checkpoint}/metadata"):
        raise ValueError(f"{out} holds results of another checkpoint than {checkpoint}; give each its own output")

    def store(batch: DataFrame, batch_id: int) -> None:
        _write_partial(reduce_batch(batch), out, batch_id)

    return (
        stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


# --- audit counts -----------------------------------------------------------
AUDIT_KEYS = ["jour", "table_name", "operation_type"]


def run_audit_counts(log: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Entries per calendar day, table and action, whenever they arrive.

    Counts add up, so a batch stores its own and no state or watermark is needed: an entry of any
    age counts.
    """

    def reduce_batch(batch: DataFrame) -> DataFrame:
        return grouped(batch, {"jour": "cast(`timestamp` AS date)", "table_name": "table_name", "operation_type": "operation_type"}, f"{ROWS} AS entrees")

    return run_partials(log, reduce_batch, out, checkpoint)


def read_audit_counts(spark: SparkSession, out: str) -> DataFrame:
    return grouped(spark.read.parquet(out), AUDIT_KEYS, *named(entrees=total("entrees")))


# --- case counters ----------------------------------------------------------
def run_counters(persons: DataFrame, out: str, checkpoint: str, spelling: str) -> StreamingQuery:
    """Keep per-case counters current from arriving person rows."""

    def reduce_batch(batch: DataFrame) -> DataFrame:
        return persons_by_case(batch, spelling)

    return run_partials(persons, reduce_batch, out, checkpoint)


def read_counters(spark: SparkSession, out: str) -> DataFrame:
    return grouped(spark.read.parquet(out), ["operation_id"], *named(**{c: total(c) for c in COUNTERS}))


# --- monthly figures --------------------------------------------------------
#: Cases are followed in blocks of neighbouring numbers, so that one call serves many of them.
BLOCK_BITS = 8
_SLOTS = 1 << BLOCK_BITS
#: The cases of a block as the stream knows them: per case its place in the block, whether it was delivered,
#: the version and month of its newest delivery, and the sums of its people; compressed 64-bit numbers.
_STATE = "cases binary"
#: What a batch changes in a month; sums are in the order of the counters.
_CHANGE = "month int, n long, sums array<long>"
_EVENT = ["block", "operation_id", "version", "month", *COUNTERS]
_EVENT_ROWS = ", ".join(f"{c} long" for c in _EVENT)
_IN_BLOCK = f"shiftright(operation_id, {BLOCK_BITS}) AS block"
_NO_MONTH, _NO_CASE = -1, -2


def _case_events(cases: DataFrame, version: str) -> DataFrame:
    month = f"coalesce(cast({T.month_index(T.day(ALERT))} AS bigint), {_NO_MONTH}L) AS month"
    return cases.where("operation_id IS NOT NULL").selectExpr(
        _IN_BLOCK, "operation_id", f"coalesce(cast({version} AS bigint), 0L) AS version", month, *[f"0L AS {c}" for c in COUNTERS])


def _sums_by(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys and the column sums of their rows."""
    order = np.argsort(keys, kind="stable")
    found, starts = np.unique(keys[order], return_index=True)
    return found, np.add.reduceat(values[order], starts, axis=0) if len(found) else values[:0]


def _people_events(persons: DataFrame, spelling: str, sign: str) -> DataFrame:
    """Rows of one case within a batch of rows become one row, before they meet in a task."""
    coded = with_outcome_code(persons.where("operation_id IS NOT NULL"), spelling)
    terms = [f"cast(coalesce(({sign}) * ({term}), 0) AS bigint) AS {c}" for c, term in counter_terms().items()]
    rows = coded.selectExpr("cast(operation_id AS bigint) AS operation_id", *terms)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            ids, sums = _sums_by(columns[0], np.column_stack(columns[1:]))
            fixed = [ids >> BLOCK_BITS, ids, np.zeros_like(ids), np.full_like(ids, _NO_CASE)]
            yield pa.record_batch([pa.array(c) for c in (*fixed, *sums.T)], _EVENT)

    return rows.mapInArrow(fold, _EVENT_ROWS)


def _follow_block(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The changes that new events make: the old shares of their cases out of their old months, the new shares
    into the new ones."""
    fixed = 4  # place, delivered, version, month
    cases = np.zeros((_SLOTS, fixed + len(COUNTERS)), np.int64)
    known = np.zeros(_SLOTS, bool)
    if state.exists:
        stored = np.frombuffer(zlib.decompress(state.get[0]), np.int64).reshape(-1, cases.shape[1])
        cases[stored[:, 0]], known[stored[:, 0]] = stored, True
    before, touched = cases.copy(), np.zeros(_SLOTS, bool)
    newest = np.empty((0, 3), np.int64)  # place, version, month
    for frame in frames:
        events = frame[_EVENT].to_numpy(np.int64)
        place = events[:, 1] & (_SLOTS - 1)
        touched[place] = True
        found, sums = _sums_by(place, events[:, fixed:])
        cases[found, fixed:] += sums
        own = events[:, 3] != _NO_CASE
        newest = np.concatenate([newest, np.column_stack([place, events[:, 2:fixed]])[own]])
        newest = newest[np.lexsort((newest[:, 2], newest[:, 1], newest[:, 0]))]
        newest = newest[np.append(newest[1:, 0] != newest[:-1, 0], True)[:len(newest)]]  # the last of each place
    taken = newest[(cases[newest[:, 0], 1] == 0) | (newest[:, 1] >= cases[newest[:, 0], 2])]
    cases[taken[:, 0], 1], cases[taken[:, 0], 2:fixed] = 1, taken[:, 1:]
    known |= touched
    cases[:, 0] = np.arange(_SLOTS)
    state.update((zlib.compress(cases[known].tobytes(), 1),))
    months, shares = [], []
    for factor, table in ((-1, before), (1, cases)):
        counted = table[touched & (table[:, 1] == 1) & (table[:, 3] != _NO_MONTH)]
        months.append(counted[:, 3])
        shares.append(factor * counted[:, [1, *range(fixed, counted.shape[1])]])
    months, shares = _sums_by(np.concatenate(months), np.concatenate(shares))
    moved = shares.any(axis=1)
    if moved.any():
        yield pd.DataFrame({"month": months[moved].astype(np.int32), "n": shares[moved, 0], "sums": list(shares[moved, 1:])})


def run_monthly(
    cases: DataFrame, persons: DataFrame, out: str, checkpoint: str, spelling: str, version: str = "0L", sign: str = "1",
) -> StreamingQuery:
    """Keep monthly sums current from arriving cases and people, in whatever order they arrive.

    People who come before their case wait in its state; people who come later count in its month at
    once. A case that is delivered again moves with its people to the month of its newest ``version``
    (of equal versions, the later batch's, in one batch the later month); without a date it is in no
    month. ``sign`` is an expression over a person row: -1 takes back a row that was delivered before.
    A batch reads and writes the state of the blocks of its cases, and stores one row a month it changes.
    """
    events = _case_events(cases, version).unionByName(_people_events(persons, spelling, sign))
    changes = events.groupBy("block").applyInPandasWithState(_follow_block, _CHANGE, _STATE, "append", GroupStateTimeout.NoTimeout)

    def reduce_batch(batch: DataFrame) -> DataFrame:
        return grouped(batch, ["month"], *named(n=total("n"), **{s: total(f"sums[{COUNTERS.index(c)}]") for s, c in SUMS.items()}))

    return run_partials(changes, reduce_batch, out, checkpoint)


def _monthly_partials(spark: SparkSession, out: str) -> DataFrame:
    return grouped(spark.read.parquet(out), ["month"], *named(**{x: total(x) for x in ("n", *SUMS)}))


def read_monthly(spark: SparkSession, out: str) -> DataFrame:
    """Sums per month under the short names that the rates are computed from; months without a case are absent."""
    year, month = "(month - 1) div 12", "(month - 1) % 12 + 1"
    return _monthly_partials(spark, out).where("n > 0").selectExpr(
        f"make_date(cast({year} AS int), cast({month} AS int), 1) AS periode", f"cast({year} AS bigint) AS annee",
        f"cast({month} AS bigint) AS mois", "n", *SUMS)


def compact_monthly(spark: SparkSession, out: str, target: str) -> None:
    """:func:`compact` for monthly sums."""
    compact(spark, _monthly_partials, out, target)


def compact(spark: SparkSession, read: Callable[[SparkSession, str], DataFrame], out: str, target: str) -> None:
    """Fold all partials of a stopped stream into one, written to a new folder."""
    read(spark, out).write.mode("overwrite").parquet(f"{target}/batch_id=-1")
