"""Tables stored in their reading order, and pages that open the files they show.

A table is cut into ranges of its order, one folder each, and a small index says for every range its
rows, how many rows come before it, and its last place. A page by number opens the ranges
that its rows lie in; a page after a cursor begins at the cursor's range and opens further ones until
it is full. So the ten thousandth page costs what the first does, and no task keeps the rows that are
skipped.

The order is an instant, the newest first and unknown ones in front, then a key, a number
that is unique. Table and index are switched as one version (see ``versions``).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie.operators.paging import largest, smallest
from vigie.sources import versions

RANGE, INDEX, SCHEMA = "range_number", "/index", "/schema"


@dataclass(frozen=True)
class Cursor:
    """The place of a page's last row."""

    instant: datetime | None
    key: int


def save(df: DataFrame, root: str, name: str, instant: str, key: str, ranges: int) -> versions.Version:
    """Store a table in ``ranges`` ranges of its order and switch to it.

    Equal instants are told apart by the key, so one instant that holds a third of all rows is still
    cut into ranges. Rows without a key are refused.
    """
    spark, at = df.sparkSession, f"{root}/data/{uuid.uuid4().hex}"
    before, order = versions.current(spark, root), [largest(instant), smallest(key)]
    cut = df.repartitionByRange(ranges, *order).withColumn(RANGE, F.spark_partition_id())
    cut.sortWithinPartitions(RANGE, *order).write.partitionBy(RANGE).mode("errorifexists").parquet(f"{at}/{name}")
    stored = spark.read.schema(cut.schema).parquet(f"{at}/{name}")
    if not stored.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"{name}: rows without {key}")
    place = F.struct(F.col(instant).alias("instant"), F.col(key).alias("key"))
    last = F.min_by(place, F.struct(F.col(instant).isNull(), F.col(instant), -F.col(key))).alias("last")
    facts = stored.groupBy(RANGE).agg(F.count("*").alias("rows"), last)
    # One row a range: few enough to be put in order by one task.
    facts.selectExpr("*", f"sum(rows) OVER (ORDER BY {RANGE}) - rows AS before").coalesce(1).write.mode("errorifexists").parquet(f"{at}/index")
    spark.createDataFrame([], cut.schema).write.mode("errorifexists").parquet(f"{at}/schema")  # an empty table has no ranges
    places = {name: f"{at}/{name}", name + INDEX: f"{at}/index", name + SCHEMA: f"{at}/schema"}
    return versions.commit(spark, root, before.places | places, before)


@dataclass(frozen=True)
class Ordered:
    """A stored table of one version, opened for paging."""

    rows: DataFrame
    index: DataFrame
    instant: str
    key: str

    @property
    def order(self) -> list[Column]:
        return [largest(self.instant), smallest(self.key)]

    def _between(self, low: int, high: int) -> DataFrame:
        return self.rows.where(F.col(RANGE).between(low, high))

    def page(self, skip: int, limit: int) -> DataFrame:
        """Rows ``skip`` to ``skip + limit`` of the order; none beyond its end."""
        hit = self.index.where((F.col("before") < skip + limit) & (F.col("before") + F.col("rows") > skip))
        low, high, before = hit.agg(F.min(RANGE), F.max(RANGE), F.min("before")).first()
        if low is None:
            return self.rows.drop(RANGE).limit(0)
        return self._between(low, high).orderBy(*self.order).offset(skip - before).limit(limit).drop(RANGE)

    def count(self) -> int:
        """All rows of the table, from its index."""
        return self.index.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]

    def after(self, cursor: Cursor | None, limit: int, where: Column | str = "true") -> DataFrame:
        """The next ``limit`` rows after a cursor that meet a condition; the first ones without a cursor.

        Ranges are opened one, two, four, ... at a time from the cursor's on, until there are enough
        such rows or the table ends, so a common condition opens few files and a rare one reads on.
        """
        later, low, last = F.lit(True), 0, self.index.agg(F.max(RANGE)).first()[0]
        if last is None or limit < 1:
            return self.rows.drop(RANGE).limit(0)
        if cursor is not None:
            later = self._later(F.col(self.instant), F.col(self.key), cursor)
            low = self.index.where(self._later(F.col("last.instant"), F.col("last.key"), cursor)).agg(F.min(RANGE)).first()[0]
            if low is None:
                return self.rows.drop(RANGE).limit(0)
        wanted = later & (F.expr(where) if isinstance(where, str) else where)
        high, width, missing = low - 1, 1, limit
        while missing > 0 and high < last:
            start, high, width = high + 1, min(high + width, last), 2 * width
            missing -= self._between(start, high).where(wanted).limit(missing).count()
        return self._between(low, high).where(wanted).orderBy(*self.order).limit(limit).drop(RANGE)

    @staticmethod
    def _later(instant: Column, key: Column, cursor: Cursor) -> Column:
        """Whether a place comes after the cursor: unknown instants first, then newest first, then by key."""
        if cursor.instant is None:
            return instant.isNotNull() | (key > cursor.key)
        at = F.lit(cursor.instant).cast("timestamp_ntz")
        return (instant < at) | ((instant == at) & (key > cursor.key))


def opened(spark: SparkSession, root: str, name: str, instant: str, key: str, version: int | None = None) -> Ordered:
    """The table as a version has it, the newest if none is named."""
    places = versions.current(spark, root, version).places
    rows = spark.read.schema(spark.read.parquet(places[name + SCHEMA]).schema).parquet(places[name])
    return Ordered(rows, spark.read.parquet(places[name + INDEX]), instant, key)


def cursor_of(page: DataFrame, instant: str, key: str) -> Cursor | None:
    """The cursor that leads on from a page; none after an empty page."""
    row = page.orderBy(F.expr(f"`{instant}` IS NOT NULL").desc(), F.col(instant).asc_nulls_last(), F.col(key).desc()).first()
    return None if row is None else Cursor(row[instant], row[key])
