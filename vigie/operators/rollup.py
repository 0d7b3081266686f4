"""Grouped sums of the case counters: the common core of the indicator reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie import labels as L
from vigie.functions import temporal as T
from vigie.functions.measures import ROWS, gravity, half_up, named, percent, total
from vigie.operators.counters import attach_counters
from vigie.sources.dataset import RescueData

# short name of each counter's sum
SUMS = {
    "ss": "nombre_saines_sauves",
    "pec": "nombre_prises_en_compte",
    "dec": "nombre_decedes",
    "dis": "nombre_disparus",
    "ble": "nombre_blesses",
    "sec": "nombre_secourues",
    "ass": "nombre_assistees",
    "ret": "nombre_retrouvees",
    "tas": "nombre_tirees_affaire_seule",
    "imp": "nombre_impliques",
    "fau": "nombre_fausses_alertes",
}

ALERT, END = "date_heure_reception_alerte", "date_heure_fin_operation"

# measures over the short names
RESCUE_RATE = percent("ss", "pec")
DEATH_RATE = percent("dec", "pec")
SEVERITY = gravity("dec", "dis", "ble", "pec")
PEOPLE_PER_CASE = half_up("imp", "n", 2)
VICTIMS = "(dec + dis)"
DURATION = T.seconds_between(ALERT, END)
BY_MONTH = {
    "periode": T.month_start(ALERT),
    "annee": T.year_number(ALERT),
    "mois": T.month_number(ALERT),
}
BY_YEAR = {"annee": T.year_number(ALERT)}


def active_only(cases: DataFrame, active: bool) -> DataFrame:
    """Keep the centres in service; the list is a constant, so this is a scan filter."""
    return cases.where(F.col("cross").isin(L.ACTIVE_CENTRES)) if active else cases


def year_range(year: int) -> str:
    """A year as bounds on the stored instant, which Parquet can skip by."""
    return f"{ALERT} >= timestamp_ntz '{int(year)}-01-01 00:00:00' AND {ALERT} < timestamp_ntz '{int(year) + 1}-01-01 00:00:00'"


def dated_cases(
    data: RescueData, *columns: str, active: bool = False, dated: bool = True, year: int | None = None
) -> DataFrame:
    needs_date = [ALERT] if dated or year is not None else []
    wanted = dict.fromkeys(["operation_id", *columns, *(["cross"] if active else []), *needs_date])
    cases = active_only(data.cases(*wanted), active)
    if year is not None:
        return cases.where(year_range(year))
    return cases.where(f"{ALERT} IS NOT NULL") if dated else cases


def grouped(df: DataFrame, keys: dict[str, str] | list[str], *aggregates: str) -> DataFrame:
    """Group by plain columns or by named expressions."""
    pairs = keys.items() if isinstance(keys, dict) else [(k, f"`{k}`") for k in keys]
    return df.groupBy(*[F.expr(e).alias(k) for k, e in pairs]).agg(*map(F.expr, aggregates))


def roll_up(
    data: RescueData, cases: DataFrame, keys: dict[str, str] | list[str], **extra: str
) -> DataFrame:
    """Group cases: row count ``n``, the counter sums and any extra aggregate.

    Every sum is offered; Catalyst prunes the ones a report does not select, down to
    the columns read from the person table.
    """
    sums = {short: total(counter) for short, counter in SUMS.items()}
    return grouped(attach_counters(data, cases), keys, *named(n=ROWS, **sums, **extra))


def hours(seconds: str, divisor: str = "1", places: int = 2) -> str:
    """Seconds over ``divisor`` as rounded hours."""
    return half_up(seconds, f"({divisor}) * 3600", places, wide=True)
