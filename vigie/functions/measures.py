"""Numeric measures with exact, engine-independent rounding, as SQL expression text.

Reports select long lists of measures, so measures are composed as SQL text and handed
to Spark in one call per list. Rates are published with two or three decimals, rounded
half away from zero. A rate is a quotient of integer sums, so it is rounded in integer
arithmetic and only the finished value becomes a double: no tie is ever decided by a
binary fraction.
"""

from __future__ import annotations


def half_up(num: str, den: str, places: int, scale: int = 1, wide: bool = False) -> str:
    """``num * scale / den`` rounded half away from zero; NULL unless ``den`` is positive.

    ``wide`` computes in 38 digits, for sums of seconds or micro-degrees; counts of people
    and cases fit the plain form, which fails rather than wraps if they ever did not.
    """
    kind = "decimal(38,0)" if wide else "bigint"
    n, d = f"cast({num} AS {kind})", f"cast({den} AS {kind})"
    rounded = f"((abs({n}) * {2 * scale * 10**places} + {d}) div ({d} * 2))"
    signed = f"CASE WHEN {n} < 0 THEN -{rounded} ELSE {rounded} END"
    return f"(CASE WHEN {d} > 0 THEN cast({signed} AS double) / {10**places}D END)"


def percent(num: str, den: str, places: int = 2) -> str:
    return half_up(num, den, places, scale=100)


def gravity(dead: str, missing: str, injured: str, handled: str) -> str:
    """Severity index: three points a death, two a missing person, one an injury."""
    return half_up(f"{dead} * 3 + {missing} * 2 + {injured}", handled, 3)


def round_even(value: str, places: int) -> str:
    """Rounding of a double to the even neighbour, as array libraries do it."""
    return f"(rint(({value}) * {10**places}D) / {10**places}D)"


def round_away(value: str, places: int) -> str:
    """Rounding of a double half away from zero."""
    v = f"({value})"
    return f"(signum({v}) * cast(floor(abs({v}) * {10**places}D + 0.5D) AS double) / {10**places}D + 0.0D)"


def fixed_point(value: str, places: int) -> str:
    """A decimal or double as a whole number of 10^-places units, so sums are exact."""
    return f"cast(round(cast({value} AS double) * {10**places}D, 0) AS bigint)"


def wide_sum(value: str) -> str:
    """Exact sum of large whole numbers over any number of rows.

    Millions and remainders are added apart as plain integers, which is fast and cannot
    overflow; only the finished sums meet in 38 digits.
    """
    return f"(cast(sum({value} div 1000000) AS decimal(38,0)) * 1000000 + sum({value} % 1000000))"


def total(value: str) -> str:
    return f"cast(coalesce(sum({value}), 0) AS bigint)"


def total_if(condition: str, value: str) -> str:
    return total(f"CASE WHEN {condition} THEN {value} ELSE 0 END")


ROWS = "cast(count(1) AS bigint)"


def named(**columns: str) -> list[str]:
    """``expression AS name`` for each keyword."""
    return [f"{expression} AS {name}" for name, expression in columns.items()]
