"""Time-series operators on already aggregated frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie import labels as L
from vigie.functions.measures import half_up, percent, round_away
from vigie.functions.temporal import month_index


def previous(value: str, order: str) -> str:
    return f"lag({value}) OVER (ORDER BY {order})"


def change_percent(value: str, order: str) -> str:
    before = previous(value, order)
    return percent(f"({value} - {before})", before)


class TrailingYear:
    """Mean and deviation of a monthly figure over the twelve calendar months before.

    The frame is a range over the month number, so a month without data is absent
    rather than zero, and a single sorted pass replaces a self join. Sums stay exact
    integers; the deviation is taken from them once, at the end.
    """

    def __init__(self, value: str, tag: str, by: str = "", period: str = "periode"):
        self.value, self.tag = value, tag
        part = f"PARTITION BY {by} " if by else ""
        self.frame = (
            f"OVER ({part}ORDER BY {month_index(period)} RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING)"
        )

    def windows(self) -> list[str]:
        """The window sums this figure needs, to be selected first."""
        wide = f"cast({self.value} AS decimal(18,0))"
        return [
            f"count({self.value}) {self.frame} AS k_{self.tag}",
            f"sum({self.value}) {self.frame} AS s_{self.tag}",
            f"sum(cast({wide} * {wide} AS decimal(38,0))) {self.frame} AS q_{self.tag}",
        ]

    def mean(self) -> str:
        return half_up(f"s_{self.tag}", f"k_{self.tag}", 2)

    def gap(self) -> str:
        t = self.tag
        return half_up(f"({self.value} * k_{t} - s_{t})", f"k_{t}", 2)

    def score(self) -> str:
        """Distance from the mean in sample deviations; NULL below two months or without spread."""
        t = self.tag
        sums = f"cast(s_{t} AS decimal(38,0))"
        spread = f"cast(k_{t} * q_{t} - {sums} * {sums} AS double)"
        k = f"cast(k_{t} AS double)"
        return (
            f"CASE WHEN k_{t} > 1 AND {spread} > 0 THEN"
            f" cast({self.value} * k_{t} - s_{t} AS double) / sqrt({spread} * {k} / ({k} - 1D)) END"
        )


def trailing_sums_by_join(months: DataFrame, values: list[str], period: str = "periode") -> DataFrame:
    """The same twelve-month sums as an equality join instead of a window.

    Every month offers itself to the twelve that follow it, so the range condition
    becomes an equality on the month and the work stays linear.
    """
    later = months.select(
        F.explode(F.expr(f"transform(sequence(1, 12), i -> add_months({period}, i))")).alias(period), *values
    )
    sums = [F.expr(f"cast(sum({v}) AS bigint)").alias(f"s_{v}") for v in values]
    past = later.groupBy(period).agg(F.expr("cast(count(1) AS bigint)").alias("mois_connus"), *sums)
    return months.join(past, period, "left").fillna(0, subset=["mois_connus"])


def alert_level(score: str) -> str:
    """Only high values alert; an unknown score is calm."""
    branches = " ".join(f"WHEN {score} > {floor} THEN '{level}'" for level, floor in L.ALERT_LEVELS)
    return f"CASE {branches} ELSE '{L.CALM}' END"


def rounded_score(score: str) -> str:
    return round_away(score, 2)


def share_of_total(groups: DataFrame, value: str, name: str) -> DataFrame:
    """Add ``value`` as a percentage of its total over all groups.

    ``groups`` is a finished grouping by labels: its rows are as few as the label
    combinations, so one task adds them up. Reading the source a second time for the
    total would cost far more.
    """
    share = percent(value, f"sum({value}) OVER ()")
    return groups.selectExpr(*[f"`{x}`" for x in groups.columns], f"{share} AS {name}")


def fill_bins(binned: DataFrame, period: str, step: str, values: list[str]) -> DataFrame:
    """Every bin between the first and the last, with 0 where nothing happened."""
    edges = binned.agg(F.min(period).alias("a"), F.max(period).alias("b"))
    bins = edges.select(F.explode(F.expr(f"sequence(a, b, interval {step})")).alias(period))
    return bins.join(binned, period, "left").fillna(0, subset=values)
