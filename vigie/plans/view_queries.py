"""Questions answered from the indicator reports: filters, tops and second-level sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie import labels as L
from vigie.functions.measures import fixed_point, gravity, half_up, named, percent
from vigie.functions.outcomes import any_of
from vigie.operators import filters
from vigie.operators.paging import largest, smallest, top
from vigie.operators.rollup import grouped
from vigie.operators.series import share_of_total
from vigie.plans import views as V
from vigie.sources.dataset import RescueData


def _sum(column: str) -> str:
    return f"cast(sum({column}) AS bigint)"


def _mean_of(column: str, places: int, digits: int) -> str:
    """Unweighted mean of rounded group values, exact in units of their last digit."""
    return half_up(f"sum({fixed_point(column, places)})", f"count({column}) * {10**places}", digits)


def _ties(report: DataFrame) -> list:
    """Every column in turn, so that groups of equal size have one order."""
    return [smallest(c) for c in report.columns]


# --- safety -----------------------------------------------------------------
def _months(data: RescueData, active: bool, year: int | None = None) -> DataFrame:
    return V.monthly_safety(data, active=active, injuries_over_handled=True, year=year)


def latest_months(data: RescueData, year=None, month=None, limit: int | None = None, active: bool = False) -> DataFrame:
    return top(filters.equals(_months(data, active, year), mois=month), limit, largest("periode"))


def safety_total(data: RescueData, start=None, end=None, active: bool = False) -> DataFrame:
    """One row over the months whose first day lies within the bounds."""
    months = _months(data, active)
    if start is not None:
        months = months.where(F.col("periode") >= F.lit(str(start)).cast("date"))
    if end is not None:
        months = months.where(F.col("periode") <= F.lit(str(end)).cast("date"))
    sums = months.agg(*map(F.expr, named(
        total_operations=_sum("nb_operations"), total_impliques=_sum("total_impliques"),
        total_decedes=_sum("total_decedes"), total_disparus=_sum("total_disparus"),
        total_saines_sauves=_sum("total_saines_sauves"),
        total_prises_en_compte=_sum("total_prises_en_compte"), total_blesses=_sum("total_blesses"),
    )))
    handled = "total_prises_en_compte"
    return sums.selectExpr("*", *named(
        taux_mortalite=percent("total_decedes", handled),
        taux_saines_sauves=percent("total_saines_sauves", handled),
        indice_gravite=gravity("total_decedes", "total_disparus", "total_blesses", handled),
    ))


def lives_saved(data: RescueData, year: int | None = None, active: bool = False) -> DataFrame:
    months = _months(data, active, year)
    sums = months.agg(*map(F.expr, named(
        saines_sauves=_sum("total_saines_sauves"), prises_en_compte=_sum("total_prises_en_compte"),
        total_operations=_sum("nb_operations"),
    )))
    return sums.selectExpr(
        f"'{'CUMUL' if year is None else year}' AS periode", "*",
        *named(taux_saines_sauves=percent("saines_sauves", "prises_en_compte")),
    )


# --- centres ----------------------------------------------------------------
def _centres(data: RescueData, centre=None, active: bool = False) -> DataFrame:
    found = filters.equals(V.centre_benchmark(data, dated=True), cross_name=centre)
    return found.where(F.col("cross_name").isin(L.ACTIVE_CENTRES)) if active else found


def benchmark(data: RescueData, centre=None, first: int | None = None, active: bool = False) -> DataFrame:
    return top(_centres(data, centre, active), first, largest("nb_operations"), smallest("cross_name"))


def centre_detail(data: RescueData, centre: str, active: bool = False) -> DataFrame:
    return _centres(data, centre, active)


RANK_OF = {"sauvetage": "rank_sauvetage", "volume": "rank_volume", "rapidite": "rank_rapidite"}


def ranking(data: RescueData, metric: str = "sauvetage", centre=None, active: bool = False) -> DataFrame:
    """An unknown metric ranks by rescue rate."""
    order = RANK_OF.get(metric, "rank_sauvetage")
    return _centres(data, centre, active).select(
        "cross_name", "nb_operations", "taux_saines_sauves", "duree_mediane_heures",
        "rank_volume", "rank_sauvetage", "rank_rapidite",
    ).orderBy(smallest(order), "cross_name")


# --- vessels ----------------------------------------------------------------
def vessels(data: RescueData, vessel_class=None, kind=None, limit: int | None = None, active: bool = False) -> DataFrame:
    report = V.vessel_analysis_active(data) if active else V.vessel_analysis(data)
    found = filters.equals(report, categorie_flotteur=vessel_class, type_flotteur=kind)
    return top(found, limit, largest("nb_operations"), *map(smallest, V.VESSEL_KEYS))


def vessel_class_totals(data: RescueData, vessel_class=None, active: bool = False) -> DataFrame:
    found = filters.equals(V.vessel_classes(data, active), categorie_flotteur=vessel_class)
    return found.orderBy(largest("total_operations"), "categorie_flotteur")


def water_sports(data: RescueData, vessel_class=None, active: bool = False) -> DataFrame:
    """Six craft types. The active form sums over fates, the general one lists them."""
    report = V.vessel_analysis_active(data) if active else V.vessel_analysis(data)
    found = filters.equals(report.where(F.col("type_flotteur").isin(L.WATER_SPORTS)), categorie_flotteur=vessel_class)
    if active:
        keys = ["type_flotteur", "categorie_flotteur"]
        sums = ["nb_operations", "nb_flotteurs", "total_saines_sauves", "total_personnes", "total_decedes", "total_prises_en_compte"]
        found = grouped(found, keys, *named(**{s: _sum(s) for s in sums})).selectExpr(
            "*", f"{percent('total_decedes', 'total_prises_en_compte')} AS taux_mortalite"
        )
    return found.orderBy(largest("nb_operations"), "type_flotteur", "categorie_flotteur")


# --- calendar ---------------------------------------------------------------
def calendar(data: RescueData, year=None, phase=None, school_holidays=None, holiday=None) -> DataFrame:
    found = filters.equals(
        V.calendar_profile(data, year), phase_journee=phase,
        est_vacances_scolaires=school_holidays, est_jour_ferie=holiday,
    )
    return found.orderBy(largest("annee"), smallest("mois"), largest("nb_operations"))


def _second_level(source: DataFrame, key: str, operations: str, index: str, extra: dict[str, str] | None = None) -> DataFrame:
    return grouped(source, [key], *named(
        total_operations=_sum(operations), total_personnes=_sum("total_personnes"),
        total_victimes=_sum("total_victimes"), **(extra or {}),
        indice_gravite_moyen=_mean_of(index, 3, 3),
    ))


def season(data: RescueData, year=None, active: bool = False) -> DataFrame:
    """By month. Severity is the plain mean of the groups' indices."""
    if active:
        months = _second_level(V.season_active(data, year), "mois", "nb_operations", "indice_gravite_moyen")
    else:
        months = _second_level(V.calendar_profile(data, year), "mois", "nb_operations", "indice_gravite")
    return months.orderBy("mois")


def day_phases(data: RescueData, year=None, active: bool = False) -> DataFrame:
    if active:
        phases = _second_level(V.day_phase_active(data, year), "phase_journee", "total_operations", "indice_gravite_moyen")
    else:
        profile = V.calendar_profile(data, year).where("phase_journee IS NOT NULL")
        phases = _second_level(profile, "phase_journee", "nb_operations", "indice_gravite")
    return share_of_total(phases, "total_operations", "pct_operations").orderBy(
        largest("total_operations"), "phase_journee"
    )


def school_holidays(data: RescueData, year=None, active: bool = False) -> DataFrame:
    mean = {"moy_personnes_par_op": _mean_of("moy_personnes_par_op", 2, 2)}
    if active:
        return _second_level(
            V.school_holidays_active(data, year), "en_vacances", "total_operations", "indice_gravite_moyen", mean
        )
    profile = V.calendar_profile(data, year).where("est_vacances_scolaires IS NOT NULL")
    return _second_level(
        profile.withColumnRenamed("est_vacances_scolaires", "en_vacances"),
        "en_vacances", "nb_operations", "indice_gravite", mean,
    )


# --- weather ----------------------------------------------------------------
def weather(
    data: RescueData, wind_min=None, wind_max=None, sea_min=None, sea_max=None, year=None, active: bool = False
) -> DataFrame:
    """``year`` matters only for the active centres; the general report has no year."""
    report = V.weather_profile_active(data, year) if active else V.weather_profile(data)
    ranged = filters.in_range(filters.in_range(report, "vent_force", wind_min, wind_max), "mer_force", sea_min, sea_max)
    return ranged.orderBy(largest("nb_operations"), *_ties(ranged))


def _by_force(data: RescueData, force: str, year, active: bool) -> DataFrame:
    source = V.weather_profile_active(data, year) if active else V.weather_profile(data)
    known = source.where(F.col(force).isNotNull())
    mean = {"taux_mortalite_moyen": _mean_of("taux_mortalite", 2, 2)}
    return _second_level(known, force, "nb_operations", "indice_gravite", mean).orderBy(force)


def by_wind(data: RescueData, year=None, active: bool = False) -> DataFrame:
    return _by_force(data, "vent_force", year, active)


def by_sea(data: RescueData, year=None, active: bool = False) -> DataFrame:
    return _by_force(data, "mer_force", year, active)


# --- trends -----------------------------------------------------------------
def yoy(data: RescueData, up_to: int | None = None, limit: int | None = None, active: bool = False) -> DataFrame:
    years = filters.in_range(V.year_over_year(data, active), "annee", high=up_to)
    return top(years, limit, largest("annee"))


def yoy_latest(data: RescueData, active: bool = False) -> DataFrame:
    return yoy(data, limit=1, active=active)


CENTRE_ALERT_COLUMNS = [
    "periode", "nb_operations", "total_personnes", "total_decedes", "total_disparus", "total_victimes",
    "zscore_operations", "zscore_victimes", "niveau_alerte_victimes", "niveau_alerte_operations",
]


def _alert_months(data: RescueData, year, centre, active: bool) -> DataFrame:
    months = V.anomalies(data, active=active, centre=centre or None)
    if year is not None:
        months = months.where(F.year("periode") == year)
    return months.select(*CENTRE_ALERT_COLUMNS) if centre else months


def _at_level(df: DataFrame, *levels: str) -> DataFrame:
    return df.where(f"niveau_alerte_victimes IN {any_of(list(levels))} OR niveau_alerte_operations IN {any_of(list(levels))}")


def alerts(data: RescueData, level=None, limit: int | None = None, year=None, centre=None, active: bool = False) -> DataFrame:
    """For a named centre the past is its own and ``level`` has no effect."""
    months = _alert_months(data, year, centre, active)
    if level is not None and not centre:
        months = _at_level(months, level)
    return top(months, limit, largest("periode"))


def active_alerts(data: RescueData, year=None, centre=None, active: bool = False, limit: int | None = None) -> DataFrame:
    months = _at_level(_alert_months(data, year, centre, active), "ALERTE", "ATTENTION")
    return top(months, limit, largest("periode"))


# --- place and kind ---------------------------------------------------------
def places(data: RescueData, prefecture=None, centre=None, department=None) -> DataFrame:
    found = filters.equals(V.geography(data), prefecture_maritime=prefecture, cross_name=centre, departement=department)
    return found.orderBy(largest("nb_operations"), *_ties(found))


def by_prefecture(data: RescueData) -> DataFrame:
    known = V.geography(data).where("prefecture_maritime IS NOT NULL")
    sums = {
        "total_operations": "nb_operations", "total_personnes": "total_personnes",
        "total_saines_sauves": "total_saines_sauves", "total_prises_en_compte": "total_prises_en_compte",
        "total_decedes": "total_decedes", "total_disparus": "total_disparus",
    }
    groups = grouped(known, ["prefecture_maritime"], *named(
        **{k: _sum(v) for k, v in sums.items()},
        distance_cote_moyenne_m=_mean_of("distance_cote_moyenne_m", 0, 0),
    ))
    return groups.selectExpr("*", *named(
        taux_saines_sauves=percent("total_saines_sauves", "total_prises_en_compte"),
        taux_mortalite=percent("total_decedes", "total_prises_en_compte"),
    )).orderBy(largest("total_operations"), "prefecture_maritime")


def by_kind(data: RescueData, kind=None, event_class=None) -> DataFrame:
    found = filters.equals(V.kinds(data), type_operation=kind, categorie_evenement=event_class)
    return found.orderBy(largest("nb_operations"), *_ties(found))


# --- person categories ------------------------------------------------------
def category_counts(data: RescueData, year=None, category=None) -> DataFrame:
    found = filters.equals(V.category_counts(data, year), categorie_personne=category)
    return found.orderBy(largest("annee"), largest("total_personnes"), "categorie_personne")


def category_rescue(data: RescueData, year=None, category=None, official: bool = False) -> DataFrame:
    found = filters.equals(V.category_rescue(data, year), categorie_personne=category)
    if official:
        found = found.where(filters.official_population())
    return found.orderBy(largest("annee"), largest("nombre_impliques"), "categorie_personne")


def category_trend(data: RescueData, category: str, limit: int | None = None) -> DataFrame:
    return top(filters.equals(V.category_months(data), categorie_personne=category), limit, largest("periode"))


def category_centres(data: RescueData, category=None, centre=None) -> DataFrame:
    found = filters.equals(V.category_centres(data), categorie_personne=category, cross_name=centre)
    return found.orderBy("cross_name", largest("total_personnes"), "categorie_personne")


def official_months(data: RescueData, year=None, centre=None) -> DataFrame:
    found = filters.equals(V.official_months(data, year), cross_name=centre)
    return found.orderBy(largest("periode"), smallest("cross_name"))


def category_places(data: RescueData, category=None, centre=None) -> DataFrame:
    found = filters.equals(V.category_places(data), categorie_personne=category, cross_name=centre)
    return found.orderBy(largest("total_personnes"), *_ties(found))


def case_map(
    data: RescueData, category=None, centre=None, lat_min=None, lat_max=None, lon_min=None, lon_max=None,
    limit: int | None = None,
) -> DataFrame:
    found = filters.equals(V.case_map(data), categorie_personne=category, cross_name=centre)
    boxed = filters.in_box(found, lat_min, lat_max, lon_min, lon_max)
    return top(boxed, limit, largest("nb_personnes"), smallest("operation_id"))


# --- small reports ----------------------------------------------------------
def headline(data: RescueData) -> DataFrame:
    return V.headline(data)


def yearly(data: RescueData) -> DataFrame:
    return V.yearly(data).orderBy(largest("annee"))


def centre_totals(data: RescueData, active: bool = False) -> DataFrame:
    totals = V.centre_totals(data)
    if active:
        totals = totals.where(F.col("cross_name").isin(L.ACTIVE_CENTRES))
    return totals.orderBy(largest("total_operations"), "cross_name")


def known_centres(data: RescueData) -> DataFrame:
    named_ones = V.centre_totals(data).where(F.col("cross_name") != L.UNKNOWN_CENTRE)
    return named_ones.select("cross_name", "total_operations").orderBy(
        largest("total_operations"), "cross_name"
    ).select("cross_name")


def known_years(data: RescueData) -> DataFrame:
    return V.yearly(data).select("annee").orderBy(largest("annee"))
