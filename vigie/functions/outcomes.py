"""Predicates on the outcome label of a person row, as SQL expression text.

Two source systems spell outcomes with and without acute accents. ``folded`` accepts
both spellings everywhere. ``literal`` keeps the older behaviour in which per-case
counters know only the accented spelling and per-category reports only the plain one.
"""

from __future__ import annotations

from vigie import labels as L

FOLDED, LITERAL = "folded", "literal"


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def any_of(values: list[str]) -> str:
    return "(" + ", ".join(map(quoted, values)) + ")"


def outcome_in(column: str, wanted: list[str], mode: str, plain: bool = False) -> str:
    """Membership test; ``plain`` picks the unaccented list in literal mode."""
    if mode == FOLDED:
        return f"{column} IN {any_of(sorted({s for label in wanted for s in L.spellings(label)}))}"
    return f"{column} IN {any_of([L.plain(w) if plain else w for w in wanted])}"


def outcome_starts(column: str, prefix: str, mode: str) -> str:
    options = L.spellings(prefix) if mode == FOLDED else [L.plain(prefix)]
    return "(" + " OR ".join(f"startswith({column}, {quoted(o)})" for o in options) + ")"
