"""Stored figures that follow changes without being computed anew.

Counts, sums and value counts are additive: what a case brought can be taken back. A figure is stored
as such sums by group, dealt by hash of the group into parts, and a version says where each part is.
When cases change, only they are read, as they were and as they are; the difference of their shares is
added to the groups it touches, and only the parts of these groups are written again. Medians, least
and largest values come from counts per value, which are additive too.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.functions.measures import ROWS, named, total
from vigie.operators.counters import attach_counters, attach_counters_to_few
from vigie.operators.quantiles import middle_values
from vigie.operators.rollup import ALERT, BY_MONTH, BY_YEAR, DURATION, END, SUMS, grouped, hours
from vigie.plans import views as V
from vigie.sources import versions
from vigie.sources.dataset import RescueData

PARTS = 32
COLUMNS = ("operation_id", "cross", ALERT, END)


@dataclass(frozen=True)
class Figure:
    """Groups of cases, and the whole-number measures that are added up in them beside the count."""

    keys: dict[str, str]
    where: str = "true"
    measures: dict[str, str] = field(default_factory=lambda: dict(SUMS))


FIGURES = {
    "mois": Figure(BY_MONTH, f"{ALERT} IS NOT NULL"),
    "annees": Figure(BY_YEAR, f"{ALERT} IS NOT NULL"),
    "centres": Figure({"cross": "cross"}, f"{ALERT} IS NOT NULL"),
    "durees": Figure({"cross": "cross", "secondes": DURATION}, f"cross IS NOT NULL AND {DURATION} IS NOT NULL", {}),
}


def shares(figure: Figure, cases: DataFrame, sign: int = 1) -> DataFrame:
    """What cases with counters add to each group, or take from it."""
    sums = {short: f"{sign} * {total(counter)}" for short, counter in figure.measures.items()}
    return grouped(cases.where(figure.where), figure.keys, *named(n=f"{sign} * {ROWS}", **sums))


def _added(figure: Figure, parts: list[DataFrame]) -> DataFrame:
    names = ["n", *figure.measures]
    return grouped(reduce(DataFrame.unionByName, parts), list(figure.keys), *named(**{c: total(c) for c in names}))


def _dealt(figure: Figure, groups: DataFrame) -> DataFrame:
    return groups.withColumn("part", F.pmod(F.xxhash64(*figure.keys), F.lit(PARTS)).cast("int"))


def _write(groups: DataFrame, folder: str) -> dict[int, str]:
    """Write dealt groups; returns the folders of the parts that have any (at most ``PARTS``)."""
    groups.repartition("part").write.mode("errorifexists").partitionBy("part").parquet(folder)
    spark, schema = groups.sparkSession, groups.schema
    found = spark.read.schema(schema).parquet(folder).select("part").distinct().collect()
    return {r["part"]: f"{folder}/part={r['part']}" for r in found}


def _places(name: str, parts: dict[int, str]) -> dict[str, str]:
    return {f"{name}/{part}": folder for part, folder in parts.items()}


def store(data: RescueData, root: str) -> versions.Version:
    """Compute all figures from all cases."""
    before, folder = versions.current(data.spark, root), f"{root}/data/{uuid.uuid4().hex}"
    facts, places = _kept(attach_counters(data, data.cases(*COLUMNS)), f"{folder}/facts"), {}
    for name, figure in FIGURES.items():
        places |= _places(name, _write(_dealt(figure, shares(figure, facts)), f"{folder}/{name}"))
    return versions.commit(data.spark, root, places, before)


def _known(spark: SparkSession, name: str, version: versions.Version, parts: set[int] | None = None) -> DataFrame | None:
    folders = [f for n, f in sorted(version.places.items()) if n.split("/")[0] == name and (parts is None or int(n.split("/")[1]) in parts)]
    return spark.read.parquet(*folders) if folders else None


def _kept(rows: DataFrame, folder: str) -> DataFrame:
    rows.write.mode("errorifexists").parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def changed_cases(data: RescueData, ids: DataFrame) -> DataFrame:
    """The named cases as ``data`` has them; people are cut to these cases before they are summed."""
    return attach_counters_to_few(data, data.cases(*COLUMNS).join(ids.select("operation_id"), "operation_id", "left_semi"))


def apply_changes(old: RescueData, new: RescueData, ids: DataFrame, root: str) -> tuple[versions.Version, dict[str, list[int]]]:
    """Bring the figures from ``old`` to ``new``, which differ in the cases ``ids`` at most.

    ``ids`` names cases that were added, removed or changed, themselves or in their people, for
    instance the records of a snapshot comparison. Returns the version and the parts written by
    figure. Naming an unchanged case changes nothing; without changes the version stays.
    """
    spark = new.spark
    before, folder = versions.current(spark, root), f"{root}/data/{uuid.uuid4().hex}"
    ids.select("operation_id").distinct().write.mode("errorifexists").parquet(f"{folder}/ids")
    ids = spark.read.schema("operation_id long").parquet(f"{folder}/ids")
    taken, brought = (_kept(changed_cases(data, ids), f"{folder}/{name}") for data, name in ((old, "taken"), (new, "brought")))
    places, written = dict(before.places), {}
    for name, figure in FIGURES.items():
        delta = _added(figure, [shares(figure, taken, -1), shares(figure, brought)])
        delta = delta.where(" OR ".join(f"{c} <> 0" for c in ("n", *figure.measures)))
        touched = _write(_dealt(figure, delta), f"{folder}/changes/{name}")
        written[name] = sorted(touched)
        if not touched:
            continue
        stored = _known(spark, name, before, set(touched))
        changes = spark.read.parquet(*touched.values())
        groups = _added(figure, [changes] if stored is None else [stored, changes]).where("n <> 0")
        fresh = _write(_dealt(figure, groups), f"{folder}/{name}")
        places = {n: f for n, f in places.items() if n not in _places(name, touched)} | _places(name, fresh)
    if places == before.places:
        return before, written
    return versions.commit(spark, root, places, before), written


def read(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """The groups of a figure."""
    found = _known(spark, name, versions.current(spark, root, version))
    if found is None:
        raise ValueError(f"{root} holds no groups of {name}")
    return found


def monthly_safety(spark: SparkSession, root: str) -> DataFrame:
    return V.monthly_rates(read(spark, root, "mois"))


def centre_durations(spark: SparkSession, root: str) -> DataFrame:
    """Mean, median, least and largest duration by centre, from the counts of each duration."""
    counts = read(spark, root, "durees")
    ends = grouped(counts, ["cross"], *named(
        k="cast(sum(n) AS bigint)", s="sum(cast(secondes AS decimal(38,0)) * n)", lo_s="min(secondes)", hi_s="max(secondes)"))
    middle = middle_values(counts, ["cross"], "secondes", times="n")
    return ends.join(middle, "cross").selectExpr(*named(
        cross_name="cross", duree_moyenne_heures=hours("s", "k"), duree_mediane_heures=hours("(lo + hi)", "2"),
        duree_min_heures=hours("lo_s"), duree_max_heures=hours("hi_s")))
