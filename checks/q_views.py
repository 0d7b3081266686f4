"""Registered indicator reports."""

from vigie.functions.outcomes import LITERAL
from vigie.operators.counters import case_counters
from vigie.plans import views as V
from vigie.sources.star import StarData


def on(report, **options):
    return lambda spark, sf_dir: report(StarData(spark, sf_dir), **options)


QUERIES = {
    "operations_stats": on(case_counters),
    "kpi_securite_mensuel": on(V.monthly_safety),
    "kpi_securite_mensuel_mv": on(V.monthly_safety, injuries_over_handled=True),
    "kpi_securite_mensuel_actifs": on(V.monthly_safety, active=True, injuries_over_handled=True),
    "kpi_cross_benchmark": on(V.centre_benchmark),
    "kpi_cross_benchmark_mv": on(V.centre_benchmark, dated=True),
    "kpi_flotteurs_analyse": on(V.vessel_analysis),
    "kpi_flotteurs_analyse_actifs": on(V.vessel_analysis_active),
    "kpi_flotteurs_categorie": on(V.vessel_classes),
    "kpi_flotteurs_categorie_actifs": on(V.vessel_classes, active=True),
    "kpi_temporel_multidim": on(V.calendar_profile),
    "kpi_saisonnalite_actifs": on(V.season_active),
    "kpi_phase_journee_actifs": on(V.day_phase_active),
    "kpi_impact_vacances_actifs": on(V.school_holidays_active),
    "kpi_meteo_correlation": on(V.weather_profile),
    "kpi_meteo_correlation_actifs": on(V.weather_profile_active),
    "kpi_yoy": on(V.year_over_year),
    "kpi_yoy_actifs": on(V.year_over_year, active=True),
    "kpi_alertes_anomalies": on(V.anomalies),
    "kpi_alertes_anomalies_actifs": on(V.anomalies, active=True),
    "kpi_alertes_par_cross": on(V.anomalies, by_centre=True),
    "kpi_geographique": on(V.geography),
    "kpi_type_operation": on(V.kinds),
    "kpi_categorie_comptage": on(V.category_counts),
    "kpi_taux_sauvetage_categorie": on(V.category_rescue),
    "kpi_taux_sauvetage_categorie_literal": lambda spark, sf_dir: V.category_rescue(
        StarData(spark, sf_dir, LITERAL)
    ),
    "kpi_evolution_categorie_mensuel": on(V.category_months),
    "kpi_cross_categorie_benchmark": on(V.category_centres),
    "kpi_securite_sans_clandestins": on(V.official_months),
    "kpi_categorie_geographique": on(V.category_places),
    "kpi_carte_operations": on(V.case_map),
    "kpi_global": on(V.headline),
    "kpi_annuel": on(V.yearly),
    "kpi_cross": on(V.centre_totals),
}
