"""Per-case outcome counters and the pre-aggregated facts built on them.

Person and vessel rows are always reduced by case before they meet the case table:
the partial aggregate runs map-side, so a case holding a large share of all rows is
collapsed before the shuffle, and the join is one row to one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie import labels as L
from vigie.functions.measures import ROWS, named, total, total_if
from vigie.functions.outcomes import outcome_in, outcome_starts
from vigie.sources.dataset import CATEGORY_FACTS, VESSEL_FACTS, RescueData

COUNTERS = [
    "nombre_saines_sauves",
    "nombre_prises_en_compte",
    "nombre_decedes",
    "nombre_disparus",
    "nombre_blesses",
    "nombre_secourues",
    "nombre_assistees",
    "nombre_retrouvees",
    "nombre_tirees_affaire_seule",
    "nombre_impliques",
    "nombre_fausses_alertes",
]


# each known outcome by a small number, so its text is compared once per row
_CODES = {
    L.RESCUED: 1, L.ASSISTED: 2, L.FOUND: 3, L.MISSING: 4, L.DEAD: 5, L.DEAD_ACCIDENT: 6,
    L.DEAD_NATURAL: 7, L.SELF_RESCUED: 8, L.FALSE_ALARM: 9,
}


def _codes(*wanted: str) -> str:
    return ", ".join(str(_CODES[w]) for w in wanted)


def with_outcome_code(persons: DataFrame, spelling: str, plain: bool = False) -> DataFrame:
    """Add ``code``, the number of the outcome, 0 for any other text."""
    branches = " ".join(
        f"WHEN {outcome_in('resultat_humain', [label], spelling, plain)} THEN {code}"
        for label, code in _CODES.items()
    )
    return persons.withColumn("code", F.expr(f"CASE {branches} ELSE 0 END"))


def counter_terms() -> dict[str, str]:
    """What one coded person row adds to each of the eleven counters."""

    def people(*wanted: str) -> str:
        return f"CASE WHEN code IN ({_codes(*wanted)}) THEN nombre ELSE 0 END"

    terms = [
        people(*L.SAFE),
        people(*L.OFFICIAL),
        people(*L.DEATHS),
        people(L.MISSING),
        "dont_nombre_blesse",
        people(L.RESCUED),
        people(L.ASSISTED),
        people(L.FOUND),
        people(L.SELF_RESCUED),
        "nombre",
        people(L.FALSE_ALARM),
    ]
    return dict(zip(COUNTERS, terms))


def counter_sums() -> list[str]:
    """Aggregates turning coded person rows into the eleven counters."""
    return named(**{counter: total(term) for counter, term in counter_terms().items()})


def persons_by_case(persons: DataFrame, spelling: str) -> DataFrame:
    coded = with_outcome_code(persons, spelling)
    return coded.groupBy("operation_id").agg(*map(F.expr, counter_sums()))


def attach_counters(data: RescueData, cases: DataFrame) -> DataFrame:
    """``cases`` with the eleven counters, 0 where a case has no person row."""
    if set(COUNTERS) <= set(cases.columns):
        return cases
    persons = data.persons("operation_id", "resultat_humain", "nombre", "dont_nombre_blesse")
    return _fill(cases, cases.join(persons_by_case(persons, data.spelling), "operation_id", "left"))


def attach_counters_to_few(data: RescueData, few: DataFrame) -> DataFrame:
    """Counters for a short list of cases, such as a page.

    Person rows are cut to these cases before they are summed, so neither the person
    table nor the case table is shuffled whole. The list is planned twice and must be
    the same both times: give it a unique order.
    """
    if set(COUNTERS) <= set(few.columns):
        return few
    persons = data.persons("operation_id", "resultat_humain", "nombre", "dont_nombre_blesse")
    mine = persons.join(few.select("operation_id"), "operation_id", "left_semi")
    return _fill(few, few.join(persons_by_case(mine, data.spelling), "operation_id", "left"))


def _fill(cases: DataFrame, joined: DataFrame) -> DataFrame:
    filled = [f"coalesce({name}, 0L) AS {name}" for name in COUNTERS]
    return joined.selectExpr(*[f"`{name}`" for name in cases.columns], *filled)


def case_counters(data: RescueData) -> DataFrame:
    """One row per case: the counters every indicator is derived from."""
    return attach_counters(data, data.cases("operation_id")).select("operation_id", *COUNTERS)


def persons_by_case_category(data: RescueData) -> DataFrame:
    """Person rows reduced to one row per case and person category."""
    persons = data.persons(
        "operation_id", "categorie_personne", "resultat_humain", "nombre", "dont_nombre_blesse"
    )
    coded = with_outcome_code(persons, data.spelling, plain=True)
    return coded.groupBy("operation_id", "categorie_personne").agg(
        *map(F.expr, category_sums(data.spelling))
    )


def category_cases(data: RescueData, *columns: str, where: str = "true") -> DataFrame:
    """One row per case and person category, with case columns, for the cases of ``where``.

    Stored facts already carry the case columns and are only scanned.
    """
    wanted = dict.fromkeys(["operation_id", *columns])
    if CATEGORY_FACTS in data.stored:
        return data.stored[CATEGORY_FACTS].where(where)
    cases = data.cases(*wanted).where(where).select(*wanted)
    return persons_by_case_category(data).join(cases, "operation_id")


def category_sums(spelling: str) -> list[str]:
    """Deaths go by the beginning of the outcome here, so longer texts count too."""

    def people(*wanted: str) -> str:
        return total_if(f"code IN ({_codes(*wanted)})", "nombre")

    return named(
        person_rows=ROWS,
        personnes="cast(sum(nombre) AS bigint)",
        blesses=total("dont_nombre_blesse"),
        ss=people(*L.SAFE),
        pec=people(*L.OFFICIAL),
        dec=total_if(
            f"code IN ({_codes(*L.DEATHS)}) OR (code = 0 AND {outcome_starts('resultat_humain', L.DEAD, spelling)})",
            "nombre",
        ),
        dis=people(L.MISSING),
    )


def vessels_by_case(data: RescueData, keys: list[str]) -> DataFrame:
    """Vessel rows reduced to one row per case and vessel description, with their number.

    Stored facts are folded further if they tell more descriptions apart.
    """
    if VESSEL_FACTS in data.stored:
        facts = data.stored[VESSEL_FACTS]
        return facts.groupBy("operation_id", *keys).agg(F.expr(total("vessels")).alias("vessels"))
    vessels = data.vessels("operation_id", *keys)
    return vessels.groupBy("operation_id", *keys).agg(F.expr(ROWS).alias("vessels"))
