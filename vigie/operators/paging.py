"""Ordering with stated NULL places, top-k and pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def largest(name: str) -> Column:
    """Descending with NULLs first, the order of the source database."""
    return F.col(name).desc_nulls_first()


def smallest(name: str) -> Column:
    """Ascending with NULLs last."""
    return F.col(name).asc_nulls_last()


def top(df: DataFrame, limit: int | None, *order: Column) -> DataFrame:
    """Sorted rows, or the first ``limit`` of them by a bounded heap per task."""
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)


def page(df: DataFrame, skip: int, limit: int, *order: Column) -> DataFrame:
    """One page. Give a unique last sort column, or pages may overlap."""
    return (df.orderBy(*order) if order else df).offset(skip).limit(limit)
