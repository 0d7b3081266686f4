"""Several tables replaced together, and versions that readers hold on to.

A version says where each table is. It is one small file in a folder of its own, ``manifests/number=n``,
and written last: until then, and after a failure, readers see the version before. The tables themselves
are written to new folders and never changed, so a reader that opened a version keeps it whatever comes
after. Tables that a commit does not name stay where they are. Of two commits at the same time the
second fails and may be tried again on the new state.

The newest number is taken from the listing of the folder, so opening a version reads one file.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

ROWS = "name string, folder string, commit string"
NUMBER = re.compile(r"/number=(\d+)/")


class CommitConflict(RuntimeError):
    """Another commit took the number first."""


@dataclass(frozen=True)
class Version:
    number: int
    places: dict[str, str]


def _manifests(root: str) -> str:
    return f"{root}/manifests"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions, the oldest first; none before the first commit. No job runs."""
    try:
        files = spark.read.schema(f"{ROWS}, number long").parquet(_manifests(root)).inputFiles()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted({int(found.group(1)) for f in files if (found := NUMBER.search(f))})


def current(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """A version, the newest if none is named; version 0 has no tables."""
    known = numbers(spark, root)
    if number is not None and number not in known:
        raise ValueError(f"{root} has no version {number}; it has {known}")
    if not known:
        return Version(0, {})
    number = known[-1] if number is None else number
    rows = spark.read.schema(ROWS).parquet(f"{_manifests(root)}/number={number}").collect()  # one row a table
    first = min(r["commit"] for r in rows)  # two commits that met: the same one wins for everybody
    return Version(number, {r["name"]: r["folder"] for r in rows if r["commit"] == first and r["name"] is not None})


def commit(spark: SparkSession, root: str, places: dict[str, str], before: Version) -> Version:
    """Make ``places`` the version after ``before``; fails if another one is there already."""
    mine, number = uuid.uuid4().hex, before.number + 1
    rows = [(None, None, mine), *((name, folder, mine) for name, folder in sorted(places.items()))]  # a version without tables is one too
    try:
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("errorifexists").parquet(f"{_manifests(root)}/number={number}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_ALREADY_EXISTS":
            raise
        raise CommitConflict(f"version {number} of {root} is there already") from error
    found = current(spark, root, number)
    if found.places != dict(places):
        raise CommitConflict(f"version {number} of {root} went to another commit")
    return found


def replace(tables: dict[str, DataFrame], root: str, drop: tuple[str, ...] = (), side_by_side: int = 1) -> Version:
    """Write tables in the given order to new folders, then switch to them all at once.

    ``drop`` names tables that the new version does without. A failure on the way leaves the version
    as it was; what was written is no version's and goes with :func:`clean_up`.
    """
    spark = next(iter(tables.values())).sparkSession
    before, folder = current(spark, root), f"{root}/data/{uuid.uuid4().hex}"

    def write(name: str) -> None:
        tables[name].write.mode("errorifexists").parquet(f"{folder}/{name}")

    if side_by_side > 1:
        with ThreadPoolExecutor(max_workers=side_by_side) as pool:
            list(pool.map(write, tables))
    else:
        for name in tables:
            write(name)
    gone = (*tables, *drop)  # a replaced table leaves its deltas behind
    kept = {n: p for n, p in before.places.items() if n.split("/")[0] not in gone}
    return commit(spark, root, kept | {n: f"{folder}/{n}" for n in tables}, before)


def roll_back(spark: SparkSession, root: str, number: int) -> Version:
    """The tables of an older version as a new one; what came between stays readable by number."""
    return commit(spark, root, current(spark, root, number).places, current(spark, root))


def written(spark: SparkSession, folder: str) -> DataFrame | None:
    """The table in a folder; none if it has no file, as bucketed tables without rows have none."""
    try:
        return spark.read.parquet(folder)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None


def clean_up(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Empty the folders of tables that only versions older than the newest ``keep`` point to.

    Readers of these versions must be gone. The versions themselves stay listed: asked for, their
    tables have no rows any more, and a second clean-up finds nothing to do. Returns the folders.
    """
    known = numbers(spark, root)
    keep = max(keep, 1)  # what readers open next stays
    held = {f for n in known[-keep:] for f in current(spark, root, n).places.values()}
    gone = sorted({f for n in known[:len(known) - keep] for f in current(spark, root, n).places.values()} - held)
    emptied = []
    for folder in gone:
        table = written(spark, folder)
        if table is not None and not table.isEmpty():
            spark.createDataFrame([], table.schema).write.mode("overwrite").parquet(folder)
            emptied.append(folder)
    return emptied
