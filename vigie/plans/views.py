"""Indicator reports over cases, vessels and persons: one function per report.

Each takes a data handle and returns a lazy DataFrame with the published column
names. ``active`` restricts a report to the centres in service.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie import labels as L
from vigie.functions import temporal as T
from vigie.functions.measures import (
    ROWS, fixed_point, half_up, named, percent, total, total_if, wide_sum,
)
from vigie.functions.outcomes import any_of
from vigie.operators.counters import attach_counters, category_cases, vessels_by_case
from vigie.operators.quantiles import middle_values
from vigie.operators.rollup import (
    ALERT, BY_MONTH, BY_YEAR, DEATH_RATE, DURATION, END, PEOPLE_PER_CASE, RESCUE_RATE, SEVERITY,
    SUMS, VICTIMS, dated_cases, grouped, hours, roll_up, year_range,
)
from vigie.operators.series import (
    TrailingYear, alert_level, change_percent, previous, rounded_score, share_of_total,
)
from vigie.sources.dataset import RescueData

METRES, MILES = "distance_cote_metres", "distance_cote_milles_nautiques"
CATEGORY = "categorie_personne"
VESSEL_KEYS = ["type_flotteur", "categorie_flotteur", "resultat_flotteur"]
VALID_POSITION = "latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"


# --- monthly safety ---------------------------------------------------------
def monthly_safety(
    data: RescueData, active: bool = False, injuries_over_handled: bool = False, year: int | None = None
) -> DataFrame:
    """Totals and rates per month; injuries are a share of involved or of handled people."""
    months = roll_up(data, dated_cases(data, active=active, year=year), BY_MONTH)
    return monthly_rates(months, injuries_over_handled)


def monthly_rates(months: DataFrame, injuries_over_handled: bool = False) -> DataFrame:
    """Published columns from monthly sums."""
    return months.selectExpr(
        "periode", "annee", "mois",
        *named(
            nb_operations="n", total_saines_sauves="ss", total_prises_en_compte="pec",
            taux_saines_sauves=RESCUE_RATE, total_impliques="imp", total_decedes="dec",
            total_disparus="dis", total_secourues="sec", total_assistees="ass",
            total_retrouvees="ret", total_blesses="ble", total_tirees_affaire_seule="tas",
            total_fausses_alertes="fau", taux_mortalite=DEATH_RATE,
            taux_disparition=percent("dis", "pec"),
            taux_blessure=percent("ble", "pec" if injuries_over_handled else "imp"),
            indice_gravite=SEVERITY,
        ),
    )


# --- centres ----------------------------------------------------------------
def centre_benchmark(data: RescueData, dated: bool = False) -> DataFrame:
    """Durations, outcomes, workload and three rankings per centre."""
    cases = dated_cases(data, "cross", ALERT, END, dated=dated).where("cross IS NOT NULL")
    # One pass: sums by centre and duration, whose rows are few; they give the centre's sums and, in
    # their order, the middle of its durations.
    values = roll_up(data, cases, {"cross": "cross", "secs": DURATION}, first=f"min({ALERT})", last=f"max({ALERT})")
    timed = "CASE WHEN secs IS NOT NULL THEN n ELSE 0 END"
    ranked = values.selectExpr(
        "*", f"sum({timed}) OVER (PARTITION BY cross ORDER BY secs ROWS UNBOUNDED PRECEDING) AS upto", f"sum({timed}) OVER (PARTITION BY cross) AS known")
    joined = grouped(ranked, ["cross"], *named(
        n=total("n"), **{x: total(x) for x in SUMS}, s="sum(cast(secs AS decimal(38,0)) * n)", k="max(known)",
        lo_s="min(secs)", hi_s="max(secs)", first="min(first)", last="max(last)",
        lo="min(CASE WHEN upto >= (known + 1) div 2 THEN secs END)", hi="min(CASE WHEN upto >= (known + 2) div 2 THEN secs END)",
    ))
    days = f"floor({T.seconds_between('first', 'last')} / 86400) + 1"
    return joined.selectExpr(*named(
        cross_name="cross", nb_operations="n",
        duree_moyenne_heures=hours("s", "k"),
        duree_mediane_heures=hours("(lo + hi)", "2"),
        duree_min_heures=hours("lo_s"), duree_max_heures=hours("hi_s"),
        total_saines_sauves="ss", total_prises_en_compte="pec", taux_saines_sauves=RESCUE_RATE,
        total_personnes="imp", total_secourues="sec", total_assistees="ass",
        total_retrouvees="ret", total_decedes="dec", total_disparus="dis", total_blesses="ble",
        taux_mortalite=DEATH_RATE, operations_par_jour=half_up("n", days, 2),
        personnes_par_operation=PEOPLE_PER_CASE,
        rank_volume="cast(rank() OVER (ORDER BY n DESC) AS bigint)",
        rank_sauvetage="cast(rank() OVER (ORDER BY cast(ss AS double) / nullif(pec, 0) DESC NULLS LAST) AS bigint)",
        rank_rapidite="cast(rank() OVER (ORDER BY lo + hi ASC NULLS LAST) AS bigint)",
        premiere_operation=T.day("first"), derniere_operation=T.day("last"),
    ))


def centre_totals(data: RescueData) -> DataFrame:
    label = {"cross_name": f"coalesce(cross, '{L.UNKNOWN_CENTRE}')"}
    return roll_up(data, dated_cases(data, "cross"), label).selectExpr("cross_name", *named(
        total_operations="n", total_personnes="imp", total_saines_sauves="ss",
        total_decedes="dec", total_disparus="dis", taux_saines_sauves=RESCUE_RATE,
    ))


# --- vessels ----------------------------------------------------------------
def _vessel_rollup(
    data: RescueData, keys: list[str], active: bool, known_class: bool, *distances: str
) -> DataFrame:
    """Vessel groups; every vessel of a case carries the whole counters of the case.

    Vessels are reduced per case first, so the distinct number of cases is a row
    count and the counters are weighted by the number of vessels.
    """
    vessels = vessels_by_case(data, keys)
    if known_class:
        vessels = vessels.where("categorie_flotteur IS NOT NULL")
    cases = dated_cases(data, *distances, active=active, dated=False)
    joined = vessels.join(attach_counters(data, cases), "operation_id")
    sums = {
        "n": ROWS, "v": total("vessels"),
        "ss": total("nombre_saines_sauves * vessels"),
        "pec": total("nombre_prises_en_compte * vessels"),
        "imp": total("nombre_impliques * vessels"),
        "dec": total("nombre_decedes * vessels"),
        "dis": total("nombre_disparus * vessels"),
        "ble": total("nombre_blesses * vessels"),
    }
    for column in distances:
        units = fixed_point(column, 2 if column == METRES else 4)
        sums[f"sum_{column}"] = f"sum({units} * vessels)"
        sums[f"count_{column}"] = f"sum(CASE WHEN {column} IS NOT NULL THEN vessels END)"
    return grouped(joined, keys, *named(**sums))


def _mean(column: str, unit: int, places: int) -> str:
    """Rounded mean of a fixed-point column summed as ``sum_`` and counted as ``count_``."""
    return half_up(f"sum_{column}", f"count_{column} * {unit}", places, wide=True)


def vessel_analysis(data: RescueData) -> DataFrame:
    """By type, class and fate, with each group's share of all (summed) case counts."""
    groups = share_of_total(
        _vessel_rollup(data, VESSEL_KEYS, False, False, METRES, MILES), "n", "share"
    )
    return groups.selectExpr(*VESSEL_KEYS, *named(
        nb_operations="n", nb_flotteurs="v", pct_operations="share",
        total_saines_sauves="ss", total_prises_en_compte="pec", taux_saines_sauves=RESCUE_RATE,
        total_personnes="imp", total_decedes="dec", total_disparus="dis", total_blesses="ble",
        taux_mortalite=DEATH_RATE,
        distance_cote_moyenne_m=_mean(METRES, 100, 0),
        distance_cote_moyenne_nm=_mean(MILES, 10000, 2),
        personnes_par_operation=PEOPLE_PER_CASE,
    ))


def vessel_analysis_active(data: RescueData) -> DataFrame:
    groups = _vessel_rollup(data, VESSEL_KEYS, True, True, METRES)
    return groups.selectExpr(*VESSEL_KEYS, *named(
        nb_operations="n", nb_flotteurs="v", total_saines_sauves="ss",
        total_prises_en_compte="pec", total_personnes="imp", total_decedes="dec",
        total_disparus="dis", distance_cote_moyenne_m=_mean(METRES, 100, 0),
        taux_saines_sauves=RESCUE_RATE, taux_mortalite=DEATH_RATE,
    ))


def vessel_classes(data: RescueData, active: bool = False) -> DataFrame:
    groups = _vessel_rollup(data, ["categorie_flotteur"], active, True, METRES)
    return groups.selectExpr("categorie_flotteur", *named(
        total_operations="n", total_flotteurs="v", total_personnes="imp",
        total_saines_sauves="ss", total_decedes="dec", total_prises_en_compte="pec",
        taux_saines_sauves=RESCUE_RATE, taux_mortalite=DEATH_RATE,
        distance_cote_moyenne_m=_mean(METRES, 100, 0),
    ))


# --- calendar ---------------------------------------------------------------
def calendar_profile(data: RescueData, year: int | None = None) -> DataFrame:
    """Year, month, weekday, phase of day, holidays and tide, all crossed."""
    dims = ["phase_journee", "est_jour_ferie", "est_vacances_scolaires", "maree_categorie"]
    keys = {
        "annee": T.year_number(ALERT), "mois": T.month_number(ALERT),
        "jour_semaine": T.weekday_sunday0(ALERT), "nom_jour": T.weekday_padded(ALERT),
        **{d: d for d in dims},
    }
    return roll_up(data, dated_cases(data, *dims, year=year), keys).selectExpr(*keys, *named(
        nb_operations="n", total_saines_sauves="ss", total_prises_en_compte="pec",
        total_personnes="imp", total_decedes="dec", total_disparus="dis",
        total_victimes=VICTIMS, moy_personnes_par_op=PEOPLE_PER_CASE,
        taux_saines_sauves=RESCUE_RATE, indice_gravite=SEVERITY,
    ))


def season_active(data: RescueData, year: int | None = None) -> DataFrame:
    keys = {k: BY_MONTH[k] for k in ("annee", "mois")}
    return roll_up(data, dated_cases(data, active=True, year=year), keys).selectExpr(*keys, *named(
        nb_operations="n", total_personnes="imp", total_victimes=VICTIMS,
        indice_gravite_moyen=SEVERITY,
    ))


def day_phase_active(data: RescueData, year: int | None = None) -> DataFrame:
    """Undated cases count under a missing year."""
    cases = dated_cases(data, ALERT, "phase_journee", active=True, dated=False, year=year)
    keys = {**BY_YEAR, "phase_journee": "phase_journee"}
    return roll_up(data, cases.where("phase_journee IS NOT NULL"), keys).selectExpr(*keys, *named(
        total_operations="n", total_personnes="imp", total_victimes=VICTIMS,
        indice_gravite_moyen=SEVERITY,
    ))


def school_holidays_active(data: RescueData, year: int | None = None) -> DataFrame:
    flag = "est_vacances_scolaires"
    cases = dated_cases(data, ALERT, flag, active=True, dated=False, year=year)
    keys = {**BY_YEAR, "en_vacances": flag}
    return roll_up(data, cases.where(f"{flag} IS NOT NULL"), keys).selectExpr(*keys, *named(
        total_operations="n", total_personnes="imp", total_victimes=VICTIMS,
        moy_personnes_par_op=PEOPLE_PER_CASE, indice_gravite_moyen=SEVERITY,
    ))


# --- weather ----------------------------------------------------------------
_HAS_WEATHER = "vent_force IS NOT NULL OR mer_force IS NOT NULL"


def weather_profile(data: RescueData) -> DataFrame:
    keys = ["vent_force", "mer_force", "vent_direction_categorie", "maree_categorie", "maree_coefficient"]
    cases = dated_cases(data, *keys, dated=False).where(_HAS_WEATHER)
    return roll_up(data, cases, keys).selectExpr(*keys, *named(
        nb_operations="n", total_saines_sauves="ss", total_prises_en_compte="pec",
        total_personnes="imp", total_decedes="dec", total_disparus="dis", total_blesses="ble",
        total_victimes=VICTIMS, moy_personnes_par_op=PEOPLE_PER_CASE,
        taux_saines_sauves=RESCUE_RATE, taux_mortalite=DEATH_RATE, indice_gravite=SEVERITY,
    ))


def weather_profile_active(data: RescueData, year: int | None = None) -> DataFrame:
    cases = dated_cases(data, ALERT, "vent_force", "mer_force", active=True, dated=False, year=year)
    keys = {**BY_YEAR, "vent_force": "vent_force", "mer_force": "mer_force"}
    return roll_up(data, cases.where(_HAS_WEATHER), keys).selectExpr(*keys, *named(
        nb_operations="n", total_personnes="imp", total_victimes=VICTIMS,
        taux_mortalite=DEATH_RATE, indice_gravite=SEVERITY,
    ))


# --- trends -----------------------------------------------------------------
def year_over_year(data: RescueData, active: bool = False) -> DataFrame:
    cases = dated_cases(data, *([] if active else [END]), active=active)
    extra = {} if active else {"s": f"sum({DURATION})", "k": f"count({DURATION})"}
    years = roll_up(data, cases, BY_YEAR, **extra)
    columns = named(
        nb_operations="n", total_saines_sauves="ss", total_prises_en_compte="pec",
        taux_saines_sauves=RESCUE_RATE, total_personnes="imp", total_decedes="dec",
        total_disparus="dis", taux_mortalite=DEATH_RATE,
        ops_annee_precedente=previous("n", "annee"), yoy_operations_pct=change_percent("n", "annee"),
        yoy_personnes_pct=change_percent("imp", "annee"), yoy_sauves_pct=change_percent("ss", "annee"),
    )
    if not active:
        columns += named(
            total_blesses="ble", duree_moyenne_heures=hours("s", "k"),
            personnes_annee_precedente=previous("imp", "annee"),
            sauves_annee_precedente=previous("ss", "annee"),
            decedes_annee_precedente=previous("dec", "annee"),
            yoy_decedes_diff=f"dec - {previous('dec', 'annee')}",
        )
    return years.selectExpr("annee", *columns)


def anomalies(
    data: RescueData, active: bool = False, centre: str | None = None, by_centre: bool = False
) -> DataFrame:
    """Monthly figures against the twelve months before, with alert levels.

    ``centre`` looks at one centre; ``by_centre`` gives all centres at once, each
    against its own past.
    """
    narrow = centre is not None or by_centre
    cases = dated_cases(data, *(["cross"] if narrow else []), active=active)
    if centre is not None:
        cases = cases.where(F.col("cross") == centre)
    key = {"cross_name": "cross"} if by_centre else {}
    months = roll_up(data, cases, {**key, "periode": BY_MONTH["periode"]}).selectExpr(
        *key, "periode",
        *named(nb_operations="n", total_personnes="imp", total_decedes="dec",
               total_disparus="dis", total_victimes=VICTIMS),
    )
    by = "cross_name" if by_centre else ""
    ops = TrailingYear("nb_operations", "ops", by)
    people = TrailingYear("total_personnes", "people", by)
    lost = TrailingYear("total_victimes", "lost", by)
    history = months.selectExpr("*", *ops.windows(), *people.windows(), *lost.windows())
    scored = history.selectExpr("*", *named(z_ops=ops.score(), z_people=people.score(), z_lost=lost.score()))
    return scored.selectExpr(*months.columns, *named(
        ecart_operations=ops.gap(), ecart_personnes=people.gap(), ecart_victimes=lost.gap(),
        zscore_operations=rounded_score("z_ops"), zscore_personnes=rounded_score("z_people"),
        zscore_victimes=rounded_score("z_lost"), niveau_alerte_victimes=alert_level("z_lost"),
        niveau_alerte_operations=alert_level("z_ops"), moyenne_operations=ops.mean(),
        moyenne_personnes=people.mean(), moyenne_victimes=lost.mean(),
    ))


# --- place and kind ---------------------------------------------------------
def _position_sums(weight: str = "1") -> dict[str, str]:
    """Exact sums of micro-degrees over the valid positions, and their counts."""
    sums = {}
    for short, column in (("lat", "latitude"), ("lon", "longitude")):
        units = f"CASE WHEN {VALID_POSITION} THEN {fixed_point(column, 6)} * {weight} END"
        sums[f"sum_{short}"] = wide_sum(f"({units})")
        sums[f"count_{short}"] = f"sum(CASE WHEN {VALID_POSITION} THEN {weight} END)"
    return sums


def _mean_position(axis: str) -> str:
    return _mean(axis, 1_000_000, 4)


def geography(data: RescueData) -> DataFrame:
    """Mean positions here take every stored coordinate, valid or not."""
    keys = {
        "prefecture_maritime": "prefecture_maritime", "cross_name": "cross",
        "departement": "departement", "zone_responsabilite": "zone_responsabilite",
        "est_metropolitain": "est_metropolitain",
    }
    cases = dated_cases(
        data, *keys.values(), "latitude", "longitude", METRES, "est_dans_stm", "est_dans_dst", dated=False
    )
    lat, lon = (wide_sum(fixed_point(x, 6)) for x in ("latitude", "longitude"))
    groups = roll_up(
        data, cases, keys,
        sum_lat=lat, count_lat="count(latitude)", sum_lon=lon,
        count_lon="count(longitude)", sum_m=f"sum({fixed_point(METRES, 2)})", count_m=f"count({METRES})",
        stm="cast(count_if(est_dans_stm) AS bigint)", dst="cast(count_if(est_dans_dst) AS bigint)",
    )
    return groups.selectExpr(*keys, *named(
        nb_operations="n", total_saines_sauves="ss", total_prises_en_compte="pec",
        total_personnes="imp", total_decedes="dec", total_disparus="dis",
        lat_moyenne=_mean_position("lat"), lon_moyenne=_mean_position("lon"),
        distance_cote_moyenne_m=_mean("m", 100, 0), nb_dans_stm="stm", nb_dans_dst="dst",
        taux_saines_sauves=RESCUE_RATE, taux_mortalite=DEATH_RATE,
    ))


def kinds(data: RescueData) -> DataFrame:
    keys = ["type_operation", "sous_type_operation", "evenement", "categorie_evenement"]
    cases = dated_cases(data, *keys, ALERT, END, dated=False)
    groups = roll_up(data, cases, keys, s=f"sum({DURATION})", k=f"count({DURATION})")
    return groups.selectExpr(*keys, *named(
        nb_operations="n", total_saines_sauves="ss", total_prises_en_compte="pec",
        total_personnes="imp", total_decedes="dec", total_disparus="dis", total_blesses="ble",
        moy_personnes_par_op=PEOPLE_PER_CASE, duree_moyenne_heures=hours("s", "k"),
        taux_saines_sauves=RESCUE_RATE, taux_mortalite=DEATH_RATE, indice_gravite=SEVERITY,
    ))


# --- person categories ------------------------------------------------------
_LABEL = f"coalesce({CATEGORY}, '{L.UNKNOWN_CATEGORY}') AS {CATEGORY}"
_PEOPLE = "coalesce(imp, 0L)"


def _dated(year: int | None) -> str:
    return f"{ALERT} IS NOT NULL" if year is None else year_range(year)


def _category_rollup(
    data: RescueData, keys: dict[str, str], *columns: str, where: str = "true", year: int | None = None
) -> DataFrame:
    """Group person rows by case columns and category; cases are counted once each.

    Groups keep a missing category apart from a literal label for it, as the label is
    put on afterwards.
    """
    facts = category_cases(data, ALERT, *columns, where=f"{_dated(year)} AND ({where})")
    sums = {x: total(x) for x in ("blesses", "ss", "pec", "dec", "dis")}
    return grouped(
        facts, {**keys, CATEGORY: CATEGORY},
        *named(n=ROWS, imp="cast(sum(personnes) AS bigint)", **sums),
    )


def category_counts(data: RescueData, year: int | None = None) -> DataFrame:
    return _category_rollup(data, BY_YEAR, year=year).selectExpr(_LABEL, "annee", *named(
        nb_operations="n", total_personnes=_PEOPLE, total_blesses="blesses",
        saines_sauves="ss", decedes="dec", disparus="dis",
        pct_total_annee=percent("imp", "sum(imp) OVER (PARTITION BY annee)"),
    ))


def category_rescue(data: RescueData, year: int | None = None) -> DataFrame:
    return _category_rollup(data, BY_YEAR, year=year).selectExpr(_LABEL, "annee", *named(
        nombre_saines_sauves="ss", nombre_prises_en_compte="pec", nombre_decedes="dec",
        nombre_disparus="dis", nombre_blesses="blesses", nombre_impliques=_PEOPLE,
    ))


def category_months(data: RescueData) -> DataFrame:
    return _category_rollup(data, BY_MONTH).selectExpr(*BY_MONTH, _LABEL, *named(
        nb_operations="n", total_personnes=_PEOPLE, saines_sauves="ss", prises_en_compte="pec",
        decedes="dec", disparus="dis",
    ))


def category_centres(data: RescueData) -> DataFrame:
    groups = _category_rollup(data, {"cross_name": "cross"}, "cross", where="cross IS NOT NULL")
    rank = f"cast(rank() OVER (PARTITION BY {CATEGORY} ORDER BY imp DESC NULLS FIRST) AS bigint)"
    ranked = groups.selectExpr("*", f"{rank} AS place")
    return ranked.selectExpr("cross_name", _LABEL, *named(
        nb_operations="n", total_personnes=_PEOPLE, saines_sauves="ss", prises_en_compte="pec",
        decedes="dec", disparus="dis", taux_saines_sauves=RESCUE_RATE, rank_volume_categorie="place",
    ))


def official_months(data: RescueData, year: int | None = None) -> DataFrame:
    """Month and centre, with and without the categories left out of ministry figures.

    A missing category is neither official nor left out, but counts in the totals.
    """
    listed = any_of(L.NON_OFFICIAL_CATEGORIES)
    kept, gone = f"{CATEGORY} NOT IN {listed}", f"{CATEGORY} IN {listed}"
    sums = named(
        kept=total_if(kept, "personnes"), ss=total_if(kept, "ss"), pec=total_if(kept, "pec"),
        dec=total_if(kept, "dec"), everybody=total("personnes"), gone=total_if(gone, "personnes"),
    )
    facts = category_cases(data, ALERT, "cross", where=_dated(year))
    # the join already placed each case in one partition, so this grouping moves nothing
    by_case = grouped(facts, ["operation_id", ALERT, "cross"], *sums)
    groups = grouped(
        by_case, {**BY_MONTH, "cross_name": "cross"},
        *named(n=ROWS, **{x: total(x) for x in ("kept", "ss", "pec", "dec", "everybody", "gone")}),
    )
    return groups.selectExpr(*BY_MONTH, "cross_name", *named(
        nb_operations="n", total_personnes_sans_clandestins="kept",
        saines_sauves_sans_clandestins="ss", prises_en_compte_sans_clandestins="pec",
        decedes_sans_clandestins="dec", total_personnes_avec_clandestins="everybody",
        total_clandestins_migrants="gone", taux_saines_sauves_sans_clandestins=RESCUE_RATE,
    ))


def category_places(data: RescueData) -> DataFrame:
    """Mean valid position per centre and category, each person row counting once."""
    facts = category_cases(
        data, "cross", "prefecture_maritime", "latitude", "longitude",
        where="latitude IS NOT NULL AND longitude IS NOT NULL AND cross IS NOT NULL",
    )
    groups = grouped(
        facts,
        {"cross_name": "cross", "prefecture_maritime": "prefecture_maritime", CATEGORY: CATEGORY},
        *named(n=ROWS, imp=total("personnes"), ss=total("ss"), **_position_sums("person_rows")),
    )
    return groups.selectExpr("cross_name", "prefecture_maritime", _LABEL, *named(
        nb_operations="n", total_personnes="imp", saines_sauves="ss",
        latitude=_mean_position("lat"), longitude=_mean_position("lon"),
    ))


def case_map(data: RescueData) -> DataFrame:
    """Cases with a usable position and the category that most of their people belong to.

    The dominant category is a constant-size aggregate, not a sort. The smallest
    struct wins: an unknown sum first, then most people, then the category name with a
    missing name last.
    """
    facts = category_cases(data, "cross", "latitude", "longitude", where=VALID_POSITION)
    order = (
        f"struct(personnes IS NOT NULL AS known, -personnes AS fewest,"
        f" {CATEGORY} IS NULL AS unnamed, {CATEGORY} AS name)"
    )
    place = ["operation_id", "cross", "latitude", "longitude"]
    return grouped(facts, place, f"min({order}) AS best").selectExpr(
        "operation_id", "cross AS cross_name", "latitude", "longitude",
        f"coalesce(best.name, '{L.UNKNOWN_CATEGORY}') AS {CATEGORY}", "-best.fewest AS nb_personnes",
    )


# --- headline figures -------------------------------------------------------
def headline(data: RescueData) -> DataFrame:
    """One row for all dated cases.

    Distinct centres and departments come from a first grouping by both, so no row is
    duplicated to count two columns distinctly.
    """
    groups = roll_up(
        data, dated_cases(data, "cross", "departement"), ["cross", "departement"],
        first=f"min({ALERT})", last=f"max({ALERT})",
    )
    timed = dated_cases(data, END).where(f"{END} >= {ALERT}")
    twice = middle_values(timed, [], DURATION).selectExpr("lo + hi AS twice").scalar()
    one = groups.agg(*map(F.expr, named(
        total_operations=total("n"), nb_cross="cast(count(DISTINCT cross) AS bigint)",
        nb_departements="cast(count(DISTINCT departement) AS bigint)",
        total_personnes=total("imp"), total_saines_sauves=total("ss"), total_decedes=total("dec"),
        total_disparus=total("dis"), total_blesses=total("ble"), total_prises_en_compte=total("pec"),
        premiere_operation="min(first)", derniere_operation="max(last)",
    )))
    return one.withColumn("twice", twice).selectExpr(
        *one.columns, f"{half_up('twice', '120', 0)} AS duree_mediane"
    )


def yearly(data: RescueData) -> DataFrame:
    return roll_up(data, dated_cases(data), BY_YEAR).selectExpr("annee", *named(
        total_operations="n", total_personnes="imp", total_saines_sauves="ss",
        total_decedes="dec", total_disparus="dis", total_prises_en_compte="pec",
        taux_saines_sauves=RESCUE_RATE,
    ))
