"""Parameterised reports over the base tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie import labels as L
from vigie.functions import temporal as T
from vigie.functions.measures import ROWS, named, percent, total
from vigie.operators import filters
from vigie.operators.counters import attach_counters, attach_counters_to_few, case_counters
from vigie.operators.paging import largest, page, smallest, top
from vigie.operators.rollup import ALERT, BY_YEAR, active_only, dated_cases, grouped, roll_up
from vigie.operators.series import share_of_total
from vigie.sources import ordered
from vigie.sources.dataset import RescueData

_TOLL = {
    "total_decedes": "nombre_decedes", "total_disparus": "nombre_disparus",
    "total_blesses": "nombre_blesses", "total_saines_sauves": "nombre_saines_sauves",
    "total_secourues": "nombre_secourues", "total_assistees": "nombre_assistees",
    "total_retrouvees": "nombre_retrouvees", "total_impliques": "nombre_impliques",
    "total_prises_en_compte": "nombre_prises_en_compte",
}
_CENTRE = {"cross": f"coalesce(cross, '{L.UNKNOWN_CENTRE}')"}


def _cases(data: RescueData, *columns: str, start=None, end=None, active: bool = False, dated: bool = False) -> DataFrame:
    bounded = start is not None or end is not None
    cases = dated_cases(data, *([ALERT] if bounded else []), *columns, active=active, dated=dated)
    return filters.between_dates(cases, start, end)


# --- headline ---------------------------------------------------------------
def key_figures(data: RescueData, active: bool = False) -> DataFrame:
    cases = _cases(data, "cross", "departement", active=active, dated=True)
    groups = roll_up(data, cases, ["cross", "departement"], first=f"min({ALERT})", last=f"max({ALERT})")
    return groups.agg(*map(F.expr, named(
        total_operations=total("n"), nb_cross="cast(count(DISTINCT cross) AS bigint)",
        nb_departements="cast(count(DISTINCT departement) AS bigint)", total_personnes=total("imp"),
        premiere_operation="min(first)", derniere_operation="max(last)",
    )))


def centre_count(data: RescueData, active: bool = True) -> DataFrame:
    cases = active_only(data.cases("cross"), active)
    return cases.agg(F.expr("cast(count(DISTINCT cross) AS bigint)").alias("nb_cross"))


def period_figures(data: RescueData, start=None, end=None, active: bool = False) -> DataFrame:
    groups = roll_up(data, _cases(data, "cross", start=start, end=end, active=active), ["cross"])
    return groups.agg(*map(F.expr, named(
        total_operations=total("n"), total_personnes=total("imp"),
        nb_cross="cast(count(DISTINCT cross) AS bigint)",
    )))


# --- by dimension -----------------------------------------------------------
def by_centre(data: RescueData, active: bool = False) -> DataFrame:
    groups = roll_up(data, _cases(data, "cross", active=active), _CENTRE)
    return groups.selectExpr("cross", *named(total_operations="n", total_personnes="imp")).orderBy(
        largest("total_operations"), "cross"
    )


def by_kind(data: RescueData, active: bool = False) -> DataFrame:
    cases = _cases(data, "type_operation", active=active)
    groups = grouped(cases, {"type_operation": "coalesce(type_operation, 'Autre')"}, f"{ROWS} AS total")
    return share_of_total(groups, "total", "pourcentage").orderBy(largest("total"), "type_operation")


def by_department(data: RescueData, limit: int | None = None) -> DataFrame:
    cases = _cases(data, "departement").where("departement IS NOT NULL")
    groups = roll_up(data, cases, ["departement"])
    listed = groups.selectExpr("departement", *named(total_operations="n", total_personnes="imp"))
    return top(listed, limit, largest("total_operations"), smallest("departement"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Known values of a column in order; none for a column that does not exist."""
    if column not in df.columns:
        return df.sparkSession.createDataFrame([], f"`{column}` string")
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def centre_names(data: RescueData) -> DataFrame:
    return distinct_values(data.cases("cross"), "cross")


def kind_names(data: RescueData) -> DataFrame:
    return distinct_values(data.cases("type_operation"), "type_operation")


# --- over time --------------------------------------------------------------
def timeline(data: RescueData, granularity: str = "month", start=None, end=None, active: bool = False) -> DataFrame:
    cases = _cases(data, start=start, end=end, active=active, dated=True)
    groups = roll_up(data, cases, {"periode": f"cast({T.period_start(ALERT, granularity)} AS timestamp_ntz)"})
    return groups.selectExpr("periode", *named(total_operations="n", total_personnes="imp")).orderBy("periode")


def month_comparison(data: RescueData) -> DataFrame:
    keys = {"annee": T.year_number(ALERT), "mois": T.month_number(ALERT)}
    return grouped(dated_cases(data), keys, f"{ROWS} AS total_operations").orderBy("annee", "mois")


def per_year(data: RescueData, active: bool = False) -> DataFrame:
    years = roll_up(data, dated_cases(data, active=active), BY_YEAR)
    return years.selectExpr("annee", *named(total_operations="n", total_personnes="imp")).orderBy(
        largest("annee")
    )


# --- human toll -------------------------------------------------------------
def _toll(counted: DataFrame) -> DataFrame:
    return counted.agg(*map(F.expr, named(**{k: total(v) for k, v in _TOLL.items()})))


def toll(data: RescueData) -> DataFrame:
    return _toll(case_counters(data))


def toll_by_centre(data: RescueData, start=None, end=None, active: bool = False) -> DataFrame:
    groups = roll_up(data, _cases(data, "cross", start=start, end=end, active=active), _CENTRE)
    listed = groups.selectExpr("cross", *named(decedes="dec", disparus="dis", blesses="ble", saines_sauves="ss"))
    return listed.orderBy(largest("saines_sauves"), "cross")


def toll_of_period(data: RescueData, start=None, end=None, active: bool = False) -> DataFrame:
    return _toll(attach_counters(data, _cases(data, start=start, end=end, active=active)))


def outcome_table(data: RescueData) -> DataFrame:
    """Labels go on after grouping, so a missing value and its literal label stay apart."""
    groups = grouped(
        data.persons("resultat_humain", "categorie_personne", "nombre"),
        ["resultat_humain", "categorie_personne"], f"{total('nombre')} AS total",
    )
    return groups.selectExpr(
        "coalesce(resultat_humain, 'Inconnu') AS resultat",
        "coalesce(categorie_personne, 'Autre') AS categorie", "total",
    ).orderBy(largest("total"), "resultat", "categorie")


# --- vessels ----------------------------------------------------------------
def vessel_kinds(data: RescueData, limit: int | None = None) -> DataFrame:
    keys = {k: f"coalesce({k}, 'Non renseigné')" for k in ("type_flotteur", "categorie_flotteur")}
    groups = grouped(data.vessels("type_flotteur", "categorie_flotteur"), keys, f"{ROWS} AS total")
    return top(groups, limit, largest("total"), *map(smallest, keys))


def vessel_flags(data: RescueData, limit: int | None = None) -> DataFrame:
    """Shares are of all vessels, not of the listed flags."""
    groups = grouped(data.vessels("pavillon"), {"pavillon": "coalesce(pavillon, 'Inconnu')"}, f"{ROWS} AS total")
    return top(share_of_total(groups, "total", "pourcentage"), limit, largest("total"), smallest("pavillon"))


# --- case lists -------------------------------------------------------------
def largest_cases(data: RescueData, limit: int = 10) -> DataFrame:
    """Cases with most people; ranks are put on the few rows that were kept."""
    cases = attach_counters(data, data.cases("operation_id", ALERT, "type_operation", "cross"))
    kept = top(
        cases.where("nombre_impliques > 0").select(
            "operation_id", ALERT, "type_operation", "cross", "nombre_impliques", "nombre_saines_sauves"
        ),
        limit, largest("nombre_impliques"), smallest("operation_id"),
    )
    place = "row_number() OVER (ORDER BY nombre_impliques DESC, operation_id)"
    return kept.selectExpr("*", f"cast({place} AS bigint) AS rang")


def cases_with_victims(data: RescueData, limit: int | None = None) -> DataFrame:
    cases = attach_counters(data, data.cases("operation_id", ALERT, "type_operation", "cross", "departement"))
    listed = cases.where("nombre_decedes > 0 OR nombre_disparus > 0").selectExpr(
        "operation_id", ALERT, "type_operation", "cross", "departement", "nombre_decedes",
        "nombre_disparus", "nombre_decedes + nombre_disparus AS total_victimes",
    )
    return top(listed, limit, largest("total_victimes"), largest(ALERT), smallest("operation_id"))


def search_cases(
    data: RescueData, centre=None, kind=None, department=None, start=None, end=None,
    least_people=None, victims=None, limit: int = 100, offset: int = 0,
) -> DataFrame:
    found = filters.equals(
        _cases(data, ALERT, "type_operation", "cross", "departement", start=start, end=end),
        cross=centre, type_operation=kind, departement=department,
    )
    shown = [
        "operation_id", ALERT, "type_operation", "cross", "departement", "nombre_impliques",
        "nombre_saines_sauves", "nombre_decedes", "nombre_disparus",
    ]
    order = [largest(ALERT), smallest("operation_id")]
    if least_people is None and victims is None:  # the page is known before the counters are
        return attach_counters_to_few(data, page(found, offset, limit, *order)).select(*shown).orderBy(*order)
    counted = filters.with_victims(filters.at_least_people(attach_counters(data, found), least_people), victims)
    return page(counted.select(*shown), offset, limit, *order)


def next_cases(data: RescueData, stored: ordered.Ordered, after: ordered.Cursor | None = None, limit: int = 100, centre=None, kind=None, department=None) -> DataFrame:
    """The search page that follows a cursor, from cases in ordered storage; only its cases' people are summed."""
    chosen = {"cross": centre, "type_operation": kind, "departement": department}
    wanted = reduce(lambda a, b: a & b, [F.col(c) == v for c, v in chosen.items() if v], F.lit(True))
    few = stored.after(after, limit, wanted).select("operation_id", ALERT, "type_operation", "cross", "departement")
    return attach_counters_to_few(data, few).select(
        *few.columns, "nombre_impliques", "nombre_saines_sauves", "nombre_decedes", "nombre_disparus"
    ).orderBy(largest(ALERT), smallest("operation_id"))


def case_extract(data: RescueData, centre=None, start=None, end=None, limit: int | None = None) -> DataFrame:
    """All cases with their counters, or the newest ``limit`` of them."""
    columns = ["operation_id", ALERT, "type_operation", "sous_type_operation", "cross", "departement", "latitude", "longitude"]
    found = filters.equals(_cases(data, *columns[1:], start=start, end=end), cross=centre)
    order = [largest(ALERT), smallest("operation_id")]
    counted = attach_counters(data, found) if limit is None else attach_counters_to_few(data, top(found, limit, *order))
    return counted.select(
        *columns, "nombre_impliques", "nombre_saines_sauves", "nombre_decedes", "nombre_disparus", "nombre_blesses"
    ).orderBy(*order)


def listed_cases(data: RescueData, centre=None, department=None, kind=None, start=None, end=None) -> DataFrame:
    """The predicate shared by a case list and its total count."""
    cases = data.cases("operation_id", ALERT, "type_operation", "cross", "departement")
    return filters.equals(
        filters.between_dates(cases, start, end), cross=centre, departement=department, type_operation=kind
    )


def case_page_with_count(data: RescueData, skip: int = 0, limit: int = 100, **wanted) -> DataFrame:
    """One page of cases, each row carrying the count of all matching cases."""
    matching = listed_cases(data, **wanted)
    count = matching.agg(F.expr(ROWS).alias("total")).scalar()
    return page(matching, skip, limit, largest(ALERT), smallest("operation_id")).withColumn("total", count)


def cases_with_children(data: RescueData, where: str | None = None) -> DataFrame:
    """Cases with their vessels and person outcomes, one row per child, childless cases once.

    Children stay rows instead of lists: one case may own a large share of all children,
    and an inner join lets Spark split it over tasks. Childless cases are added apart.
    """
    cases = data.cases("operation_id", "type_operation", "cross")
    if where:
        cases = cases.where(where)
    vessels = data.vessels("operation_id", "numero_ordre", "pavillon", "resultat_flotteur").selectExpr(
        "operation_id", "'flotteur' AS relation", "numero_ordre AS rang", "pavillon AS libelle",
        "resultat_flotteur AS resultat", "cast(NULL AS bigint) AS nombre",
    )
    persons = data.persons("operation_id", "categorie_personne", "resultat_humain", "nombre").selectExpr(
        "operation_id", "'resultat' AS relation", "cast(NULL AS bigint) AS rang", "categorie_personne AS libelle",
        "resultat_humain AS resultat", "nombre",
    )
    children = vessels.unionByName(persons)
    owners = children.groupBy("operation_id").agg(F.expr(ROWS).alias("children")).select("operation_id")
    childless = cases.join(owners, "operation_id", "left_anti")
    return children.join(cases, "operation_id").unionByName(childless, allowMissingColumns=True)


def children_of(children: DataFrame, operation_id: int) -> DataFrame:
    return children.where(F.col("operation_id") == operation_id)


def persons_by_outcome(data: RescueData, outcome: str) -> DataFrame:
    return data.persons().where(F.col("resultat_humain") == outcome)


# --- generic tables ---------------------------------------------------------
def table_page(df: DataFrame, skip: int = 0, limit: int = 100, order_by: str | None = None, unique: str | None = None) -> DataFrame:
    """A page in descending order of one column; unknown columns mean no order."""
    order = [largest(order_by)] if order_by in df.columns else []
    if unique and unique != order_by:
        order.append(smallest(unique))
    return page(df, skip, limit, *order)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.expr(ROWS).alias("total"))


# --- audit ------------------------------------------------------------------
def audit_entries(data: RescueData, table=None, action=None, user=None, since=None, limit: int | None = None) -> DataFrame:
    found = filters.equals(data.audit(), table_name=table, operation_type=action)
    found = filters.between_dates(filters.contains_text(found, "user_id", user), since, column="timestamp")
    return top(found, limit, largest("timestamp"), smallest("id"))


def audit_summary(data: RescueData) -> DataFrame:
    """Totals over the log. Users and tables are grouped first, then counted."""
    log = data.audit("table_name", "user_id", "operation_type", "timestamp")
    pairs = grouped(
        log, ["table_name", "user_id"],
        *named(
            n=ROWS, ins="count_if(operation_type = 'INSERT')", upd="count_if(operation_type = 'UPDATE')",
            del_="count_if(operation_type = 'DELETE')", first="min(timestamp)", last="max(timestamp)",
        ),
    )
    return pairs.agg(*map(F.expr, named(
        total_entries=total("n"), tables_tracked="cast(count(DISTINCT table_name) AS bigint)",
        users_active="cast(count(DISTINCT user_id) AS bigint)", total_inserts=total("ins"),
        total_updates=total("upd"), total_deletes=total("del_"),
        first_entry="min(first)", last_entry="max(last)",
    )))


def audited_tables(data: RescueData) -> DataFrame:
    return distinct_values(data.audit("table_name"), "table_name")
