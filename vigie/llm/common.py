"""What several operators share: words, shared folders, guarded broadcasts."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed value: a word is a run of anything but blank, tab and the line breaks.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"

#: Rows of at most this many bytes together may be broadcast.
BROADCAST_BYTES = 8 << 20
SHIPPED: dict[str, str] = {}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ship(spark: SparkSession) -> None:
    """Let the workers import this package, wherever the driver was started; once per application."""
    context = spark.sparkContext
    if SHIPPED.get("application") != context.applicationId:
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        folder = tempfile.mkdtemp(prefix="vigie-code-")
        context.addPyFile(shutil.make_archive(f"{folder}/vigie-code", "zip", os.path.dirname(root), os.path.basename(root)))
        SHIPPED["application"] = context.applicationId


def word_count(text: Column) -> Column:
    """Number of words as a long; null and wordless texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def words(text: Column) -> Column:
    """The words of a text in order; null has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder in the place that the cluster shares through ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table to the shared folder and read it: a cut of lineage that survives lost executors."""
    spark, path, schema = df.sparkSession, f"{folder}/{name}", df.schema
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(schema).parquet(path)


def small_enough(rows: int, row_bytes: int) -> bool:
    return rows * row_bytes <= BROADCAST_BYTES


def light(df: DataFrame, row_bytes: int = 16) -> DataFrame:
    """A stored table, marked for broadcast if its counted rows are few enough."""
    return F.broadcast(df) if small_enough(df.count(), row_bytes) else df


def where_made(df: DataFrame, condition: Column) -> DataFrame:
    """Filter by columns that cost much to make.

    A plain filter is moved below the projections that make its columns, and their expressions are
    then written out and computed once more for each mention. A row number that the filter looks
    at keeps it in its place.
    """
    row = fresh(df, "row_number")
    return df.withColumn(row, F.monotonically_increasing_id()).where(condition & (F.col(row) >= 0)).drop(row)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
