"""A log stored by day, whose old days go without any kept row being written again.

A version (see ``versions``) names a folder for every day of every append. Retention takes the days that
are wholly too old out of the version; a day that is too old in part keeps its files and is read from
the bound on, which its name in the version says. Entries without an instant are kept for ever.
"""

from __future__ import annotations

import uuid
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.operators.changes import retention_note
from vigie.sources import versions

LOG, INSTANT = "audit_log", "timestamp"
_DAY, _FROM, _NONE = "/day=", "/from=", "none"


def _parts(version: versions.Version, name: str) -> list[tuple[str, str, str, str]]:
    """Place, day, bound (or an empty text) and folder of every part."""
    found = []
    for place, folder in sorted(version.places.items()):
        if place.startswith(name + _DAY):
            day, _, bound = place[len(name + _DAY):].partition(_FROM)
            found.append((place, day.split("/")[0], bound, folder))
    return found


def _written(entries: DataFrame, root: str, name: str) -> dict[str, str]:
    """Write entries by day; the places of their parts."""
    mark = uuid.uuid4().hex
    at = f"{root}/data/{mark}/{name}"
    by_day = entries.withColumn("day", F.to_date(F.col(INSTANT)))
    # A day of many entries is split, days of few share a task.
    by_day.hint("rebalance", "day").write.partitionBy("day").mode("errorifexists").parquet(at)
    days = entries.sparkSession.read.schema(by_day.schema).parquet(at).select("day").distinct().collect()  # no more than days
    return {
        f"{name}{_DAY}{r['day'] or _NONE}/{mark}": f"{at}/day={r['day'] or '__HIVE_DEFAULT_PARTITION__'}" for r in days}


def append(entries: DataFrame, root: str, name: str = LOG) -> versions.Version:
    """Add entries; of an empty append nothing is left."""
    before = versions.current(entries.sparkSession, root)
    places = {} if entries.isEmpty() else _written(entries, root, name)
    return versions.commit(entries.sparkSession, root, before.places | places, before) if places else before


def _rows(spark: SparkSession, parts: list[tuple[str, str, str, str]]) -> DataFrame:
    tables = []
    for bound in sorted({p[2] for p in parts}):  # the days that a retention ended in
        table = spark.read.parquet(*[p[3] for p in parts if p[2] == bound])
        tables.append(table.where(F.col(INSTANT) >= F.lit(bound).cast("timestamp_ntz")) if bound else table)
    return reduce(DataFrame.unionByName, tables)


def read(spark: SparkSession, root: str, name: str = LOG, since: date | None = None, version: int | None = None) -> DataFrame:
    """The log as a version has it; ``since`` opens the days from that one on."""
    parts = _parts(versions.current(spark, root, version), name)
    if not parts:
        raise ValueError(f"{root} has no {name}")
    wanted = [p for p in parts if since is None or (p[1] != _NONE and p[1] >= since.isoformat())]
    return _rows(spark, wanted) if wanted else _rows(spark, parts[:1]).limit(0)


def retain(spark: SparkSession, root: str, anchor: datetime, days: int = 90, name: str = LOG) -> versions.Version:
    """Take out entries older than ``days`` before ``anchor`` and add one entry that says how many.

    Where nothing is too old, the version stays. Whole days are counted from their files' footers.
    """
    before = versions.current(spark, root)
    edge, parts = anchor - timedelta(days=days), _parts(before, name)
    dated = [p for p in parts if p[1] != _NONE]
    whole = [p for p in dated if p[1] < edge.date().isoformat()]
    cut = [p for p in dated if p[1] == edge.date().isoformat()]
    bound = edge.isoformat(" ")
    early = _rows(spark, cut).where(F.col(INSTANT) < F.lit(bound).cast("timestamp_ntz")).count() if cut else 0
    gone = early + (_rows(spark, whole).count() if whole else 0)
    if not gone:
        return before
    places = {p: f for p, f in before.places.items() if p not in {x[0] for x in whole}}
    if early:
        for place, _, old, folder in cut:
            del places[place]
            places[f"{place.partition(_FROM)[0]}{_FROM}{max(old, bound)}"] = folder
    note = retention_note(spark.range(1).select(F.lit(gone).cast("long").alias("n")), days, anchor.isoformat(" "))
    columns = _rows(spark, parts[:1]).columns
    return versions.commit(spark, root, places | _written(note.select(*columns), root, name), before)
