"""Optional filters.

A filter that is not asked for adds nothing to the plan, so what remains is a plain
comparison on a stored column that reaches the Parquet scan.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigie import labels as L

ALERT = "date_heure_reception_alerte"


def _instant(value: date | datetime | str) -> Column:
    return F.lit(str(value)).cast("timestamp_ntz")


def equals(df: DataFrame, **wanted) -> DataFrame:
    for name, value in wanted.items():
        if value is not None:
            df = df.where(F.col(name) == F.lit(value))
    return df


def between_dates(df: DataFrame, start=None, end=None, column: str = ALERT) -> DataFrame:
    """Inclusive bounds. A bound without a time is midnight, so the last day counts only at 00:00."""
    if start is not None:
        df = df.where(F.col(column) >= _instant(start))
    if end is not None:
        df = df.where(F.col(column) <= _instant(end))
    return df


def of_centre(df: DataFrame, centre: str | None = None, active: bool = False, column: str = "cross") -> DataFrame:
    """A named centre wins over the active-only switch."""
    if centre and centre not in L.NO_FILTER:
        return df.where(F.col(column) == centre)
    return df.where(F.col(column).isin(L.ACTIVE_CENTRES)) if active else df


def of_type(df: DataFrame, kind: str | None = None) -> DataFrame:
    if not kind or kind in L.NO_FILTER:
        return df
    return df.where(F.col("type_operation") == kind)


def with_victims(df: DataFrame, wanted: bool | None) -> DataFrame:
    """None keeps all cases, True those with a death or a missing person, False the others."""
    if wanted is None:
        return df
    some = (F.coalesce("nombre_decedes", F.lit(0)) > 0) | (F.coalesce("nombre_disparus", F.lit(0)) > 0)
    return df.where(some if wanted else ~some)


def at_least_people(df: DataFrame, least: int | None) -> DataFrame:
    return df if least is None else df.where(F.coalesce("nombre_impliques", F.lit(0)) >= least)


def in_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    if low is not None:
        df = df.where(F.col(column) >= low)
    if high is not None:
        df = df.where(F.col(column) <= high)
    return df


def in_box(df: DataFrame, lat_min=None, lat_max=None, lon_min=None, lon_max=None) -> DataFrame:
    return in_range(in_range(df, "latitude", lat_min, lat_max), "longitude", lon_min, lon_max)


def in_map_zone(df: DataFrame, zone: str) -> DataFrame:
    box = L.MAP_ZONES[zone]
    return df if box is None else in_box(df, *box)


def valid_position(lat: str = "latitude", lon: str = "longitude") -> Column:
    return F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180)


def contains_text(df: DataFrame, column: str, text: str | None) -> DataFrame:
    """Case-insensitive containment."""
    return df if text is None else df.where(F.col(column).ilike(f"%{text}%"))


def in_category_groups(df: DataFrame, groups: list[str], column: str = "categorie_personne") -> DataFrame:
    """Person categories of the chosen map groups; choosing none gives no rows."""
    wanted = sorted({category for group in groups for category in L.MAP_CATEGORY_GROUPS[group]})
    return df.where(F.col(column).isin(wanted)) if wanted else df.limit(0)


def official_population(column: str = "categorie_personne") -> Column:
    """False or NULL for the categories left out of ministry figures, NULL for an unknown one."""
    return ~F.col(column).isin(L.NON_OFFICIAL_CATEGORIES)


def since_years(df: DataFrame, years: int, anchor: date | str, column: str = ALERT) -> DataFrame:
    """Rows of the last ``years`` years before ``anchor``; 0 keeps everything."""
    if years <= 0:
        return df
    floor = F.add_months(F.lit(str(anchor)).cast("date"), -12 * years)
    return df.where(F.col(column) >= floor.cast("timestamp_ntz"))
