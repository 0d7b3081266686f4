"""Data handles: what a report needs from the source tables, column by column.

Reports ask a handle for exactly the columns they use. A handle over finished tables
just projects; a handle that derives the tables from other data joins only the inputs
that the asked-for columns need, so an unused dimension never causes a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigie.functions.outcomes import FOLDED
from vigie.sources import deltas, versions

CASES, VESSELS, PERSONS, AUDIT = "operations", "flotteurs", "resultats_humain", "audit_log"
CASE_FACTS, CATEGORY_FACTS, VESSEL_FACTS = "case_facts", "category_facts", "vessel_facts"


class RescueData:
    """Access to the four business tables.

    ``stored`` may hold facts that were computed before: cases that already carry their
    counters, person rows reduced by case and category, and vessel rows reduced by case and
    description. Reports then skip the join and the reduction they would otherwise start with.
    """

    def __init__(self, spark: SparkSession, spelling: str = FOLDED):
        self.spark = spark
        self.spelling = spelling
        self.stored: dict[str, DataFrame] = {}

    def table(self, name: str, *columns: str) -> DataFrame:
        raise NotImplementedError

    def cases(self, *columns: str) -> DataFrame:
        return self.table(CASES, *columns)

    def vessels(self, *columns: str) -> DataFrame:
        return self.table(VESSELS, *columns)

    def persons(self, *columns: str) -> DataFrame:
        return self.table(PERSONS, *columns)

    def audit(self, *columns: str) -> DataFrame:
        return self.table(AUDIT, *columns)


class FrameData(RescueData):
    """Handle over DataFrames that already have the business columns."""

    def __init__(self, spark: SparkSession, frames: dict[str, DataFrame], spelling: str = FOLDED):
        super().__init__(spark, spelling)
        self.frames = frames

    def table(self, name: str, *columns: str) -> DataFrame:
        frame = self.frames[name]
        return frame.select(*columns) if columns else frame


class StoredFacts(RescueData):
    """Another handle with stored facts in front of it."""

    def __init__(self, source: RescueData, stored: dict[str, DataFrame]):
        super().__init__(source.spark, source.spelling)
        self.source = source
        self.stored = stored

    def table(self, name: str, *columns: str) -> DataFrame:
        facts = self.stored.get(CASE_FACTS) if name == CASES else None
        if facts is None:
            return self.source.table(name, *columns)
        counters = [c for c in facts.columns if c.startswith("nombre_")]
        return facts.select(*columns, *counters) if columns else facts


class CatalogData(RescueData):
    """Handle over catalog tables, optionally inside one database; a table is opened when it is asked for."""

    def __init__(self, spark: SparkSession, database: str | None = None, spelling: str = FOLDED):
        super().__init__(spark, spelling)
        self.prefix = f"{database}." if database else ""

    def table(self, name: str, *columns: str) -> DataFrame:
        frame = self.spark.table(self.prefix + name)
        return frame.select(*columns) if columns else frame


class FolderData(RescueData):
    """Handle over a folder of tables: one Parquet folder each, or the tables of a version.

    The version is chosen when the first table is opened, the newest unless one is named, and kept:
    later commits do not show. A table that no version names is the folder of its name.
    """

    def __init__(self, spark: SparkSession, root: str, spelling: str = FOLDED, version: int | None = None):
        super().__init__(spark, spelling)
        self.root = root
        self.version = version
        self.opened: dict[str, DataFrame] = {}
        self.pinned: versions.Version | None = None

    def table(self, name: str, *columns: str) -> DataFrame:
        if self.pinned is None:
            self.pinned = versions.current(self.spark, self.root, self.version)
        if name not in self.opened:
            held = name in self.pinned.places
            self.opened[name] = deltas.merged(self.spark, self.pinned, name) if held else self.spark.read.parquet(f"{self.root}/{name}")
        frame = self.opened[name]
        return frame.select(*columns) if columns else frame
