"""Registered parameterised reports, filters, view questions and page tables."""

from pyspark.sql import functions as F

from vigie import labels as L
from vigie.operators import filters
from vigie.operators.counters import attach_counters
from vigie.plans import frames as P
from vigie.plans import reports as R
from vigie.plans import view_queries as Q
from vigie.plans import views as V
from vigie.session import work_folder
from vigie.sources import ordered
from vigie.sources.star import StarData

D0, D1 = "1996-03-01", "1998-06-30"
ALERT = "date_heure_reception_alerte"


def on(report, *args, **options):
    return lambda spark, sf_dir: report(StarData(spark, sf_dir), *args, **options)


def frame(report, *args, **options):
    """A report over the extracted case frame since 1997."""
    return lambda spark, sf_dir: report(P.case_frame(StarData(spark, sf_dir), start="1997-01-01"), *args, **options)


def stored_cases(data, *columns):
    root = work_folder(data.spark, "ordered")
    ordered.save(data.cases("operation_id", ALERT, *columns), root, "operations", ALERT, "operation_id", 32)
    return ordered.opened(data.spark, root, "operations", ALERT, "operation_id")


def searched_on(spark, sf_dir):
    """The search page after the cursor of the one before."""
    data = StarData(spark, sf_dir)
    stored = stored_cases(data, "type_operation", "cross", "departement")
    first = R.next_cases(data, stored, None, 120, kind="SAR")
    return R.next_cases(data, stored, ordered.cursor_of(first, ALERT, "operation_id"), 50, kind="SAR")


def after(source, report, **options):
    """A page table on top of another report."""
    return lambda spark, sf_dir: report(source(StarData(spark, sf_dir)), **options)


def kept(columns, keep):
    """Case rows left by one filter."""
    return lambda spark, sf_dir: keep(StarData(spark, sf_dir).cases("operation_id", *columns))


def kept_counted(columns, keep, counters):
    def run(spark, sf_dir):
        data = StarData(spark, sf_dir)
        return keep(attach_counters(data, data.cases("operation_id", *columns))).select("operation_id", *columns, *counters)

    return run


FILTERS = {
    "flt_optional_eq": kept(["cross", "type_operation", "departement"], lambda d: filters.equals(d, type_operation="SAR", departement=None)),
    "flt_date_range": kept([ALERT], lambda d: filters.between_dates(d, D0, D1)),
    "flt_active_centres": kept(["cross"], lambda d: filters.of_centre(d, active=True)),
    "flt_centre_override": kept(["cross"], lambda d: filters.of_centre(d, "NATION_12", active=True)),
    "flt_centre_sentinel": kept(["cross"], lambda d: filters.of_centre(d, "Tous les CROSS", active=True)),
    "flt_type": kept(["type_operation"], lambda d: filters.of_type(d, "MAS")),
    "flt_casualties_tristate": kept_counted([], lambda d: filters.with_victims(d, False), ["nombre_decedes", "nombre_disparus"]),
    "flt_casualties_true": kept_counted([], lambda d: filters.with_victims(d, True), ["nombre_decedes", "nombre_disparus"]),
    "flt_min_persons": kept_counted([], lambda d: filters.at_least_people(d, 12), ["nombre_impliques"]),
    "flt_bbox": kept(["latitude", "longitude"], lambda d: filters.in_map_zone(d, "Méditerranée")),
    "flt_valid_coords": kept(["latitude", "longitude"], lambda d: d.where(filters.valid_position())),
    "flt_ilike": lambda spark, sf_dir: filters.contains_text(
        StarData(spark, sf_dir).vessels("operation_id", "numero_ordre", "type_flotteur"), "type_flotteur", "SKI"
    ),
    "flt_prefix_like": lambda spark, sf_dir: StarData(spark, sf_dir).persons("operation_id", "resultat_humain", "nombre").where(
        F.col("resultat_humain").startswith("Personne décédée")
    ),
    "flt_wind_sea_range": kept(["vent_force", "mer_force"], lambda d: filters.in_range(filters.in_range(d, "vent_force", 4, 8), "mer_force", 2)),
    "flt_category_group": lambda spark, sf_dir: filters.in_category_groups(
        StarData(spark, sf_dir).persons("operation_id", "categorie_personne", "nombre"), ["Pêcheur", "Commerce"]
    ),
    "flt_not_in_null": lambda spark, sf_dir: StarData(spark, sf_dir).persons("operation_id", "categorie_personne", "nombre").where(
        filters.official_population()
    ),
    "prj_recent_since": kept([ALERT], lambda d: filters.since_years(d, 3, "2001-08-01")),
}

REPORTS = {
    "q_kpis": on(R.key_figures),
    "q_kpis_actifs": on(R.key_figures, active=True),
    "q_nb_cross": on(R.centre_count),
    "q_nb_cross_tous": on(R.centre_count, active=False),
    "q_kpis_by_period": on(R.period_figures, D0, D1, True),
    "q_by_cross": on(R.by_centre),
    "q_by_cross_actifs": on(R.by_centre, active=True),
    "q_by_type": on(R.by_kind),
    "q_by_department": on(R.by_department, limit=20),
    "q_cross_list": on(R.centre_names),
    "q_type_list": on(R.kind_names),
    "q_timeline": on(R.timeline),
    "q_timeline_week": on(R.timeline, "week", D0, D1, True),
    "q_timeline_day": on(R.timeline, "day"),
    "q_monthly_comparison": on(R.month_comparison),
    "q_yearly": on(R.per_year),
    "q_yearly_actifs": on(R.per_year, active=True),
    "q_bilan_global": on(R.toll),
    "q_bilan_by_cross": on(R.toll_by_centre),
    "q_bilan_by_cross_filtered": on(R.toll_by_centre, D0, D1, True),
    "q_bilan_by_period": on(R.toll_of_period, D0, D1),
    "q_resultats_stats": on(R.outcome_table),
    "q_flotteurs_stats": on(R.vessel_kinds, limit=15),
    "q_flotteurs_pavillon": on(R.vessel_flags, 2),
    "q_top_operations": on(R.largest_cases),
    "q_casualties": on(R.cases_with_victims, limit=50),
    "q_search": on(R.search_cases, kind="SAR", start=D0, least_people=3, victims=True, limit=40, offset=15),
    "q_search_default": on(R.search_cases),
    "q_operations_export": on(R.case_extract),
    "q_operations_export_cross": on(R.case_extract, centre="Corse", start=D0, end=D1),
    "q_audit_logs": lambda spark, sf_dir: R.audit_entries(
        StarData(spark, sf_dir), action="UPDATE", user="user_1", since="2024-01-10", limit=500
    ).selectExpr("* EXCEPT (changed_fields)", "array_join(changed_fields, ',') AS changed_fields"),
    "q_audit_stats": on(R.audit_summary),
    "q_audited_tables": on(R.audited_tables),
    "q_page": lambda spark, sf_dir: R.table_page(
        StarData(spark, sf_dir).cases("operation_id", ALERT, "mer_force"), 30, 60, ALERT, "operation_id"
    ),
    "q_page_ordered": lambda spark, sf_dir: stored_cases(StarData(spark, sf_dir), "mer_force").page(30, 60),
    "q_search_cursor": searched_on,
    "q_count": lambda spark, sf_dir: R.row_count(StarData(spark, sf_dir).persons()),
    "q_op_search_count": on(R.case_page_with_count, 20, 50, kind="MAS", department="MACHINERY", start=D0),
    "q_distinct_values": lambda spark, sf_dir: R.distinct_values(StarData(spark, sf_dir).cases("evenement"), "evenement"),
    "q_children_by_fk": lambda spark, sf_dir: R.children_of(
        StarData(spark, sf_dir).vessels("operation_id", "numero_ordre", "type_flotteur", "pavillon"), 77
    ),
    "q_by_result": on(R.persons_by_outcome, L.MISSING),
    "q_op_with_children": on(R.cases_with_children),
}

VIEW_QUESTIONS = {
    "qk_securite_mensuel": on(Q.latest_months, limit=24),
    "qk_securite_mensuel_mois": on(Q.latest_months, month=7, limit=24, active=True),
    "qk_securite_global": on(Q.safety_total),
    "qk_securite_global_periode": on(Q.safety_total, D0, D1, True),
    "qk_lives_saved": on(Q.lives_saved),
    "qk_lives_saved_annee": on(Q.lives_saved, 1998, True),
    "qk_cross_benchmark": on(Q.benchmark, first=5),
    "qk_cross_benchmark_actifs": on(Q.benchmark, active=True),
    "qk_cross_detail": on(Q.centre_detail, "Corse"),
    "qk_cross_ranking": on(Q.ranking, "rapidite"),
    "qk_flotteurs_analyse": on(Q.vessels, limit=50),
    "qk_flotteurs_analyse_actifs": on(Q.vessels, vessel_class="Pêche", limit=50, active=True),
    "qk_flotteurs_categorie": on(Q.vessel_class_totals),
    "qk_sports_nautiques": on(Q.water_sports),
    "qk_sports_nautiques_actifs": on(Q.water_sports, active=True),
    "qk_temporel": on(Q.calendar, 1999, "Matin", False, None),
    "qk_saisonnalite": on(Q.season),
    "qk_saisonnalite_actifs": on(Q.season, 1997, True),
    "qk_phase_journee": on(Q.day_phases),
    "qk_phase_journee_actifs": on(Q.day_phases, active=True),
    "qk_impact_vacances": on(Q.school_holidays),
    "qk_impact_vacances_actifs": on(Q.school_holidays, active=True),
    "qk_meteo_correlation": on(Q.weather, 3, 9, 1, 6),
    "qk_meteo_correlation_actifs": on(Q.weather, year=2000, active=True),
    "qk_meteo_vent": on(Q.by_wind),
    "qk_meteo_mer": on(Q.by_sea, 1998, True),
    "qk_yoy": on(Q.yoy, 2000, 4),
    "qk_yoy_latest": on(Q.yoy_latest),
    "qk_alertes": on(Q.alerts, limit=12),
    "qk_alertes_cross": on(Q.alerts, centre="Corse", limit=24),
    "qk_alertes_niveau": on(Q.alerts, "ATTENTION", 40, active=True),
    "qk_alertes_actives": on(Q.active_alerts),
    "qk_alertes_actives_cross": on(Q.active_alerts, centre="Jobourg", limit=24),
    "qk_geographique": on(Q.places, centre="Jobourg"),
    "qk_par_prefecture": on(Q.by_prefecture),
    "qk_type_operation": on(Q.by_kind, "SAR", "CE1"),
    "qk_comptage_categorie": on(Q.category_counts, 1999),
    "qk_taux_categorie": on(Q.category_rescue, official=True),
    "qk_evolution_categorie": on(Q.category_trend, "Migrant", limit=24),
    "qk_cross_categorie": on(Q.category_centres, centre="Corse"),
    "qk_sans_clandestins": on(Q.official_months, 1998, "Corse"),
    "qk_carte_categories": on(Q.category_places, category="Marin étranger"),
    "qk_carte_operations": on(Q.case_map, None, None, 41, 51.5, -5.5, 100, 500),
    "qk_global": on(Q.headline),
    "qk_annuel": on(Q.yearly),
    "qk_cross": on(Q.centre_totals, active=True),
    "qk_cross_names": on(Q.known_centres),
    "qk_years": on(Q.known_years),
}

PAGES = {
    "src_base_extract": on(P.case_frame, 3, None, "2001-08-01"),
    "src_base_light": on(P.light_case_frame),
    "df_kpis": frame(P.frame_figures),
    "df_kpis_empty": lambda spark, sf_dir: P.frame_figures(P.case_frame(StarData(spark, sf_dir), start="2090-01-01")),
    "df_by_cross": frame(P.frame_by_centre),
    "df_by_type": frame(P.frame_by_kind),
    "df_timeline_gapfill": frame(P.frame_timeline, "day"),
    "df_timeline_gapfill_week": frame(P.frame_timeline, "week"),
    "df_timeline_gapfill_month": frame(P.frame_timeline),
    "df_yearly": frame(P.frame_yearly),
    "df_bilan": frame(P.frame_toll),
    "df_bilan_by_cross": frame(P.frame_toll_by_centre),
    "pg_severity_heatmap": after(V.monthly_safety, P.severity_heatmap),
    "pg_wind_sea_matrix": after(V.weather_profile, P.wind_sea_matrix),
    "pg_cross_category_matrix": after(V.category_centres, P.centre_category_matrix),
    "pg_category_recode_share": after(V.category_counts, P.category_shares),
    "pg_category_rate": after(V.category_rescue, P.category_rates),
    "pg_top5_categories_trend": after(V.category_counts, P.leading_category_trend),
    "pg_hierarchy": after(V.vessel_analysis_active, P.vessel_hierarchy),
    "pg_hierarchy_rollup": after(V.vessel_analysis_active, P.vessel_hierarchy, subtotals=True),
    "pg_status_level": after(V.monthly_safety, lambda d: P.status_levels(d).select(
        "periode", "statut_sauvetage", "statut_mortalite", "statut_gravite")),
    "pg_alert_counts": after(V.anomalies, P.alert_counts),
    "pg_radar_scores": after(lambda data: V.centre_benchmark(data, dated=True), P.radar_scores),
    "pg_overview_means": after(lambda data: V.centre_benchmark(data, dated=True), P.overview_means),
    "pg_outcome_shares": after(Q.safety_total, P.outcome_shares),
    "pg_sports_totals": after(lambda data: Q.water_sports(data, active=True), P.sport_totals),
    "pg_audit_diff_rows": after(lambda data: data.audit(), P.audit_changes),
    "pg_month_label": after(Q.season, lambda d: P.month_labels(d).select("mois", "nom_mois", "total_operations")),
    "pg_holiday_label": after(Q.school_holidays, lambda d: P.holiday_labels(d).select("en_vacances", "libelle", "total_operations")),
}

QUERIES = {**FILTERS, **REPORTS, **VIEW_QUESTIONS, **PAGES}
