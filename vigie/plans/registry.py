"""Named reports, exports and the ordered refresh of stored results."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from vigie.operators.counters import COUNTERS, attach_counters, category_cases, vessels_by_case
from vigie.plans import view_queries as Q
from vigie.plans import views as V
from vigie.sources import sinks, versions
from vigie.sources.dataset import CASE_FACTS, CATEGORY_FACTS, VESSEL_FACTS, RescueData, StoredFacts

Report = Callable[[RescueData], DataFrame]
COUNTER_TABLE = "operations_stats"

# The public names of the exportable reports
EXPORTS: dict[str, Report] = {
    "v_kpi_securite_mensuel": V.monthly_safety,
    "v_kpi_securite_mensuel_mv": lambda d: V.monthly_safety(d, injuries_over_handled=True),
    "v_kpi_cross_benchmark": V.centre_benchmark,
    "v_kpi_cross_benchmark_mv": lambda d: V.centre_benchmark(d, dated=True),
    "v_kpi_flotteurs_analyse": V.vessel_analysis,
    "v_kpi_flotteurs_categorie_mv": V.vessel_classes,
    "v_kpi_temporel_multidim": V.calendar_profile,
    "v_kpi_meteo_correlation": V.weather_profile,
    "v_kpi_yoy_comparison": V.year_over_year,
    "v_kpi_alertes_anomalies": V.anomalies,
    "v_kpi_alertes_anomalies_mv": V.anomalies,
    "v_kpi_geographique": V.geography,
    "v_kpi_type_operation": V.kinds,
    "v_kpi_categorie_personne_comptage": V.category_counts,
    "v_kpi_taux_sauvetage_categorie": V.category_rescue,
    "v_kpi_evolution_categorie_mensuel": V.category_months,
    "v_kpi_cross_categorie_benchmark": V.category_centres,
    "v_kpi_securite_sans_clandestins": V.official_months,
    "v_kpi_categorie_geographique": V.category_places,
}

# The stored reports, by public name
STORED: dict[str, Report] = {
    "v_kpi_global": V.headline,
    "v_kpi_annuel": V.yearly,
    "v_kpi_cross": V.centre_totals,
    "v_kpi_yoy_cross_actifs": lambda d: V.year_over_year(d, active=True),
    "v_kpi_cross_benchmark_mv": lambda d: V.centre_benchmark(d, dated=True),
    "v_kpi_flotteurs_categorie_mv": V.vessel_classes,
    "v_kpi_flotteurs_categorie_cross_actifs_mv": lambda d: V.vessel_classes(d, active=True),
    "v_kpi_flotteurs_analyse_cross_actifs_mv": V.vessel_analysis_active,
    "v_kpi_alertes_anomalies_mv": V.anomalies,
    "v_kpi_alertes_anomalies_cross_actifs_mv": lambda d: V.anomalies(d, active=True),
    "v_kpi_securite_mensuel_mv": lambda d: V.monthly_safety(d, injuries_over_handled=True),
    "v_kpi_securite_mensuel_cross_actifs_mv": lambda d: V.monthly_safety(d, True, True),
    "v_kpi_saisonnalite_mensuelle_cross_actifs_mv": V.season_active,
    "v_kpi_phase_journee_cross_actifs_mv": V.day_phase_active,
    "v_kpi_impact_vacances_cross_actifs_mv": V.school_holidays_active,
    "v_kpi_meteo_correlation_cross_actifs_mv": V.weather_profile_active,
    "v_kpi_categorie_personne_comptage": V.category_counts,
    "v_kpi_taux_sauvetage_categorie": V.category_rescue,
    "v_kpi_evolution_categorie_mensuel": V.category_months,
    "v_kpi_cross_categorie_benchmark": V.category_centres,
    "v_kpi_securite_sans_clandestins": V.official_months,
    "v_kpi_categorie_geographique": V.category_places,
    "v_kpi_carte_operations_categorie": V.case_map,
}
FACTS = ["operations_stats", CASE_FACTS, CATEGORY_FACTS]
CATEGORY_COLUMNS = ["date_heure_reception_alerte", "cross", "prefecture_maritime", "latitude", "longitude"]


def export(data: RescueData, name: str) -> DataFrame:
    if name not in EXPORTS:
        raise ValueError(f"unknown report {name!r}; known: {sorted(EXPORTS)}")
    return EXPORTS[name](data)


def export_bundle(data: RescueData) -> dict[str, DataFrame]:
    return {
        "securite_global": Q.safety_total(data),
        "lives_saved": Q.lives_saved(data),
        "yoy_latest": Q.yoy_latest(data),
        "alertes_actives": Q.active_alerts(data),
        "cross_benchmark": Q.benchmark(data, first=5),
        "flotteurs_par_categorie": Q.vessel_class_totals(data),
        "par_prefecture": Q.by_prefecture(data),
        "saisonnalite": Q.season(data),
        "phase_journee": Q.day_phases(data),
    }


def _catalog_name(place: str) -> str:
    """The catalog table of facts in a version's folder."""
    return f"{place.rsplit('/', 1)[-1]}_{hashlib.md5(place.encode()).hexdigest()}"


def _facts(data: RescueData, places: dict[str, str]) -> StoredFacts:
    """A handle in front of ``data`` that reads facts where they are, by bucket if a catalog table says how.

    Without the catalog table, as in a later session whose catalog is its own, they are plain files;
    facts without any file are taken from ``data``.
    """
    spark = data.spark

    def opened(name: str) -> DataFrame | None:
        table = _catalog_name(places[name])
        return spark.table(table) if spark.catalog.tableExists(table) else versions.written(spark, places[name])

    found = {name: opened(name) for name in (CASE_FACTS, CATEGORY_FACTS, VESSEL_FACTS) if name in places}
    return StoredFacts(data, {name: facts for name, facts in found.items() if facts is not None})


def store_facts(data: RescueData, root: str, buckets: int | None = None) -> StoredFacts:
    """Write the shared facts once and return a handle that reads them.

    The case join and the reductions of people and vessels then happen once, not once per report:
    the category facts carry the case columns that reports group or filter by. With ``buckets``
    the facts are also catalog tables with that many buckets by case, so vessels meet their cases
    without a shuffle. A case that holds a large share of all people or vessels has been reduced to
    one row a description before it is placed in its bucket.
    """
    places: dict[str, str] = {}

    def store(name: str, df: DataFrame) -> StoredFacts:
        places[name] = f"{root}/{name}"
        if buckets and name != COUNTER_TABLE:
            sinks.save_by_case(df, _catalog_name(places[name]), buckets, places[name])
        else:
            df.write.mode("overwrite").parquet(places[name])
        return _facts(data, places)

    joined = store(CASE_FACTS, attach_counters(data, data.cases()))
    store(COUNTER_TABLE, joined.cases().select("operation_id", *COUNTERS))
    store(CATEGORY_FACTS, category_cases(joined, *CATEGORY_COLUMNS))
    return store(VESSEL_FACTS, vessels_by_case(data, V.VESSEL_KEYS))


def stored_facts(data: RescueData, root: str, number: int | None = None) -> StoredFacts:
    """The handle of a refresh: reports with any parameters start from the facts that it wrote."""
    return _facts(data, versions.current(data.spark, root, number).places)


def _places(spark: SparkSession, root: str, numbers: list[int]) -> set[str]:
    return {place for number in numbers for place in versions.current(spark, root, number).places.values()}


def clean_up(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """``versions.clean_up``, and the catalog tables of the emptied folders go."""
    before = _places(spark, root, versions.numbers(spark, root))
    emptied = versions.clean_up(spark, root, keep)
    for place in before - _places(spark, root, versions.numbers(spark, root)[-max(keep, 1):]):
        spark.sql(f"DROP TABLE IF EXISTS `{_catalog_name(place)}`")
    return emptied


def refresh(
    data: RescueData, root: str, names: list[str] | None = None, side_by_side: int = 8, buckets: int | None = None
) -> str:
    """Recompute the stored reports in dependency order into a new version folder.

    Reports that are not recomputed keep their folder. All switch at once, with the commit of the
    version, so until then, and after a failure, readers see the previous state. Of two refreshes at
    the same time, the second to finish fails. ``buckets`` stores the facts by case, see
    :func:`store_facts`. Returns the version's folder.
    """
    before = versions.current(data.spark, root)
    folder = f"{root}/version-{uuid.uuid4().hex}"
    facts = store_facts(data, folder, buckets)
    names = list(names or STORED)

    def write(name: str) -> None:
        STORED[name](facts).write.mode("overwrite").parquet(f"{folder}/{name}")

    # reports depend on the facts only: submit their jobs side by side
    with ThreadPoolExecutor(max_workers=side_by_side) as pool:
        list(pool.map(write, names))
    places = {name: f"{folder}/{name}" for name in [COUNTER_TABLE, CASE_FACTS, CATEGORY_FACTS, VESSEL_FACTS, *names]}
    versions.commit(data.spark, root, before.places | places, before)
    return folder


def stored_report(spark: SparkSession, root: str, name: str, number: int | None = None) -> DataFrame:
    """A report as its last refresh, or the refresh of a number, left it."""
    return spark.read.parquet(versions.current(spark, root, number).places[name])
