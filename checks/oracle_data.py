"""DuckDB versions of the source, sink, quality, loading, change, join and stream queries."""

from checks import oracle_reports as R
from checks import oracle_views as O
from checks.sqlkit import AU, BASE, DATED, FL, ON_ACTIVE, OPS, RH, ST, grav, pct, with_

A = "date_heure_reception_alerte"
N = "count(*)::BIGINT"
K = "o_orderkey"
DAMAGED = f"""d AS (SELECT {K} AS row_id, o_orderdate,
 CASE WHEN {K} % 211 = 0 THEN NULL WHEN {K} % 101 = 0 THEN 'x' || {K}::VARCHAR WHEN {K} % 107 = 0 THEN ({K} - 1)::VARCHAR ELSE {K}::VARCHAR END AS operation_id,
 CASE WHEN {K} % 157 = 0 THEN 'XXX' WHEN {K} % 163 = 0 THEN '' ELSE (['SAR','MAS','DIV'])[{K} % 3 + 1] END AS type_operation,
 CASE WHEN {K} % 127 = 0 THEN NULL WHEN {K} % 63 = 0 THEN 'Atlantis' ELSE (['Corse','Corsen','Gris-Nez','Jobourg'])[{K} % 4 + 1] END AS "cross",
 CASE WHEN {K} % 151 = 0 THEN '12345' ELSE ({K} % 95)::VARCHAR END AS departement,
 CASE WHEN {K} % 109 = 0 THEN '123.5' WHEN {K} % 50 = 0 THEN NULL ELSE (({K} * 37) % 180 - 90)::VARCHAR END AS latitude,
 CASE WHEN {K} % 83 = 0 THEN NULL ELSE (({K} * 91) % 360 - 180)::VARCHAR END AS longitude,
 CASE WHEN {K} % 131 = 0 THEN 'inconnu' ELSE (['nord','nord-est','est','sud-est'])[{K} % 4 + 1] END AS vent_direction_categorie,
 CASE WHEN {K} % 113 = 0 THEN '-1' WHEN {K} % 117 = 0 THEN '3.5' WHEN {K} % 119 = 0 THEN 'fort' ELSE ({K} % 16)::VARCHAR END AS vent_force,
 ({K} % 11)::VARCHAR AS mer_force,
 CASE WHEN {K} % 139 = 0 THEN 'hier' WHEN {K} % 149 = 0 THEN NULL ELSE o_orderdate::DATE::VARCHAR || ' 00:00:00' END AS {A},
 CASE WHEN {K} % 137 = 0 THEN '  ' WHEN {K} % 2 = 0 THEN 'secmarweb' ELSE 'seamis_json' END AS systeme_source FROM orders)"""


def num(column: str) -> str:
    return f"TRY_CAST({column} AS DOUBLE)"


def case(column: str, check: str, bad: str, source: str = "d", keys: str = "row_id", value: str | None = None) -> str:
    name = check.replace("'", "''")
    shown = f'"{column}"' if value is None else value
    return f"SELECT {keys}, '{column}' AS \"column\", '{name}' AS \"check\", ({shown})::VARCHAR AS value FROM {source} WHERE {bad}"


def union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


def damaged(*parts: str) -> str:
    return with_(union(*parts), DAMAGED)


TYPE_ID = case("operation_id", "type(int)", "operation_id IS NOT NULL AND TRY_CAST(operation_id AS BIGINT) IS NULL")
TYPE_WIND = case("vent_force", "type(float)", f"vent_force IS NOT NULL AND {num('vent_force')} IS NULL")
TYPE_DATE = case(A, "type(datetime)", f"{A} IS NOT NULL AND TRY_CAST({A} AS TIMESTAMP) IS NULL")
NULL_ID, NULL_CENTRE, NULL_DATE = (case(c, "not_null", f'"{c}" IS NULL') for c in ("operation_id", "cross", A))
UNIQUE = f"""SELECT row_id, 'operation_id' AS "column", 'unique' AS "check", operation_id AS value FROM (SELECT *, {N[:-8]} OVER (PARTITION BY operation_id) AS k FROM d) WHERE k > 1"""
COMPASS = "'nord','nord-est','est','sud-est','sud','sud-ouest','ouest','nord-ouest'"
GREATER = case("mer_force", "greater_than(0)", f"NOT ({num('mer_force')} > 0)")
LESS = case("mer_force", "less_than(10)", f"NOT ({num('mer_force')} < 10)")
ISIN_WIND = case("vent_direction_categorie", "isin", f"vent_direction_categorie NOT IN ({COMPASS})")
ISIN_SOURCE = case("systeme_source", "isin", "systeme_source NOT IN ('secmarweb','seamis_json')")
LAT = case("latitude", "(-90 <= x) & (x <= 90)", f"NOT ({num('latitude')} BETWEEN -90 AND 90)")
LON = case("longitude", "(-180 <= x) & (x <= 180)", f"NOT ({num('longitude')} BETWEEN -180 AND 180)")
WIND = case("vent_force", "x >= 0", f"NOT ({num('vent_force')} >= 0)")
ALL = [TYPE_ID, NULL_ID, UNIQUE, NULL_CENTRE, LAT, LON, ISIN_WIND, TYPE_WIND, WIND, GREATER, LESS, TYPE_DATE, NULL_DATE, ISIN_SOURCE]
FAILS = f"fails AS ({union(*ALL)})"


def over_fails(body: str) -> str:
    return with_(body, DAMAGED, FAILS)


def limits(column: str, low=None, high=None) -> list[str]:
    parts = [] if low is None else [case(column, f"min({low})", f"NOT ({num(column)} >= {low})")]
    return parts + ([] if high is None else [case(column, f"max({high})", f"NOT ({num(column)} <= {high})")])


FIELD_RULES = [
    case("operation_id", "required", "operation_id IS NULL OR trim(operation_id) = ''"),
    case("operation_id", "min(1.0)", "NOT (TRY_CAST(operation_id AS BIGINT) >= 1)"),
    case("departement", "max_length(3)", "length(departement) > 3"),
    *limits("latitude", -90.0, 90.0), *limits("longitude", -180.0, 180.0),
    *[x.replace("TRY_CAST(vent_force AS DOUBLE)", "TRY_CAST(CASE WHEN vent_force <> '3.5' THEN vent_force END AS BIGINT)") for x in limits("vent_force", 0.0, 12.0)],
    *limits("mer_force", 0.0, 9.0),
    case("systeme_source", "max_length(50)", "length(systeme_source) > 50"),
]
ENTITY = [case("operation_id", "min(1)", "NOT (TRY_CAST(operation_id AS BIGINT) >= 1)"), *limits("latitude", -90, 90), *limits("longitude", -180, 180),
          *limits("vent_force", 0, 12), *limits("mer_force", 0, 9),
          case("latitude", "coordinates_pair", "(latitude IS NULL) <> (longitude IS NULL)")]
CENTRES = "'Gris-Nez','Jobourg','Corsen','Etel','La Garde','Corse','Antilles-Guyane','Nouvelle-Caledonie','Polynesie','Sud ocean Indien','Adge','La Reunion','Martinique','Mayotte','Soulac'"
TYPES = "'SAR','MAS','DIV','SUR','POL'"
STRICT = [*ENTITY, case("type_operation", "isin", f"type_operation NOT IN ({TYPES})"), case("cross", "isin", f'"cross" NOT IN ({CENTRES})')]


def counted(parts: list[str], keys: str, *relations: str) -> str:
    return with_(f'SELECT {keys}, "column", "check", value, {N} AS cas FROM ({union(*parts)}) GROUP BY ALL', *relations)


UNKNOWN = union(*[
    f"SELECT \"{c}\" AS valeur, {N} AS lignes, '{c}' AS colonne FROM d WHERE \"{c}\" <> '' AND \"{c}\" NOT IN ({v}) GROUP BY 1"
    for c, v in (("type_operation", TYPES), ("cross", CENTRES))
])
NUMBERS = "n AS (SELECT row_id, departement, " + ", ".join(f"{num(c)} AS {c}" for c in ("latitude", "longitude", "vent_force", "mer_force")) + " FROM d)"


def numbers(column: str, check: str, bad: str) -> str:
    return with_(case(column, check, bad, "n"), DAMAGED, NUMBERS)


ZONES = ((41, 51, -5, 10), (14, 18, -64, -60), (-22, -20, 54, 56), (-25, -10, -155, -130), (-23, -19, 163, 169), (-14, -12, 44, 46), (2, 6, -55, -51))
INSIDE = " OR ".join(f"(latitude BETWEEN {a} AND {b} AND longitude BETWEEN {c} AND {d})" for a, b, c, d in ZONES)
MAXLEN = "CASE type_flotteur WHEN 'Canoe/Kayak' THEN 6 WHEN 'Jet-ski' THEN 5 WHEN 'Planche a voile' THEN 5 WHEN 'Kitesurf' THEN 3 WHEN 'Engin de plage' THEN 4 WHEN 'Ski nautique' THEN 3 END"
BOATS = "boats AS (SELECT *, CASE WHEN numero_ordre % 5 <> 0 THEN numero_ordre::DOUBLE END AS longueur FROM fl)"
NO_PEOPLE = "resultat_humain <> '' AND NOT (coalesce(nombre, 0) >= 1)"
BOAT_TYPES = "'Aeronef','Canoe/Kayak','Commerce','Navire a passagers','Peche','Plaisance a voile','Plaisance a moteur','Ski nautique','Planche a voile','Kitesurf','Jet-ski','Engin de plage','Annexe','Voilier','Autre'"
CONFIG_COLUMNS = "operation_id, type_operation, \"cross\", departement, latitude, longitude, vent_direction_categorie, vent_force, mer_force, " + A + ", systeme_source"

QUALITY = {
    "dq_rules_from_config": over_fails("SELECT d.row_id, count(f.\"check\")::BIGINT AS echecs FROM d LEFT JOIN fails f ON d.row_id = f.row_id GROUP BY 1"),
    "dq_type_check": damaged(TYPE_ID, TYPE_WIND, TYPE_DATE),
    "dq_not_null": damaged(NULL_ID, NULL_CENTRE),
    "dq_unique": damaged(UNIQUE),
    "dq_greater_than": damaged(GREATER),
    "dq_less_than": damaged(LESS),
    "dq_isin": damaged(ISIN_WIND),
    "dq_range_expr": damaged(LAT),
    "dq_strict_columns": with_('SELECT operation_id, "cross" FROM d', DAMAGED),
    "dq_split": over_fails("""SELECT d.row_id, count(f."check") = 0 AS valide, coalesce(string_agg(f."column" || ':' || f."check", ';' ORDER BY f."column" || ':' || f."check"), '') AS echecs
 FROM d LEFT JOIN fails f ON d.row_id = f.row_id GROUP BY 1"""),
    "dq_failure_cases": over_fails("SELECT * FROM fails"),
    "dq_failure_summary": over_fails(f'SELECT "column", "check", {N} AS failures FROM fails GROUP BY 1, 2'),
    "dq_required_non_blank": damaged(case("systeme_source", "required", "systeme_source IS NULL OR trim(systeme_source) = ''"), FIELD_RULES[0]),
    "dq_min_max_len": damaged(*FIELD_RULES),
    "dq_enum_warning": with_(UNKNOWN, DAMAGED),
    "dq_enum_strict": damaged(case("type_operation", "isin", f"type_operation NOT IN ({TYPES})")),
    "dq_dataframe_report": with_(f"""SELECT 'error' AS niveau, "column" AS colonne, "check" AS controle, NULL::VARCHAR AS valeur, {N} AS lignes FROM ({union(*FIELD_RULES)}) GROUP BY ALL
 UNION ALL SELECT 'warning', colonne, 'isin', valeur, lignes FROM ({UNKNOWN})""", DAMAGED),
    "dq_coords_pair": numbers("latitude", "coordinates_pair", "(latitude IS NULL) <> (longitude IS NULL)"),
    "dq_coords_zone": numbers("latitude", "coordinates_zone", f"latitude IS NOT NULL AND longitude IS NOT NULL AND NOT ({INSIDE})"),
    "dq_result_count": with_(case("nombre", "outcome_count", NO_PEOPLE, "rh", "operation_id, resultat_humain"), RH),
    "dq_length_by_type": with_(case("longueur", "length_by_type", f"longueur > {MAXLEN}", "boats", "operation_id, type_flotteur"), FL, BOATS),
    "dq_beaufort": numbers("vent_force", "beaufort", "NOT (vent_force BETWEEN 0 AND 12)"),
    "dq_douglas": numbers("mer_force", "douglas", "NOT (mer_force BETWEEN 0 AND 9)"),
    "dq_departement_format": numbers("departement", "departement_format", "length(departement) > 3"),
    "dq_entity_operation": counted(ENTITY, "row_id", DAMAGED),
    "dq_entity_operation_strict": counted(STRICT, "row_id", DAMAGED),
    "dq_entity_flotteur": counted([
        case("operation_id", "min(1)", "NOT (operation_id >= 1)", "boats", "operation_id"),
        case("type_flotteur", "isin", f"type_flotteur NOT IN ({BOAT_TYPES})", "boats", "operation_id"),
        case("resultat_flotteur", "isin", "resultat_flotteur IN ('Remorqué','Assisté')", "boats", "operation_id"),
    ], "operation_id", FL, BOATS),
    "dq_entity_resultat": counted([
        case("operation_id", "min(1)", "NOT (operation_id >= 1)", "rh", "operation_id"),
        case("nombre", "outcome_count", NO_PEOPLE, "rh", "operation_id"),
    ], "operation_id", RH),
    "dq_fail_fast": with_("SELECT operation_id FROM ops", OPS),
}


def rows_of(relation: str) -> str:
    return f"(SELECT {N} FROM {relation})"


BUNDLE = {
    "securite_global": "qk_securite_global", "lives_saved": "qk_lives_saved", "yoy_latest": "qk_yoy_latest",
    "alertes_actives": "qk_alertes_actives", "cross_benchmark": "qk_cross_benchmark", "flotteurs_par_categorie": "qk_flotteurs_categorie",
    "par_prefecture": "qk_par_prefecture", "saisonnalite": "qk_saisonnalite", "phase_journee": "qk_phase_journee",
}
STORED = {
    "operations_stats": "operations_stats", "v_kpi_global": "kpi_global", "v_kpi_annuel": "kpi_annuel", "v_kpi_cross": "kpi_cross", "v_kpi_yoy_cross_actifs": "kpi_yoy_actifs",
    "v_kpi_cross_benchmark_mv": "kpi_cross_benchmark_mv", "v_kpi_flotteurs_categorie_mv": "kpi_flotteurs_categorie",
    "v_kpi_flotteurs_categorie_cross_actifs_mv": "kpi_flotteurs_categorie_actifs", "v_kpi_flotteurs_analyse_cross_actifs_mv": "kpi_flotteurs_analyse_actifs",
    "v_kpi_alertes_anomalies_mv": "kpi_alertes_anomalies", "v_kpi_alertes_anomalies_cross_actifs_mv": "kpi_alertes_anomalies_actifs",
    "v_kpi_securite_mensuel_mv": "kpi_securite_mensuel_mv", "v_kpi_securite_mensuel_cross_actifs_mv": "kpi_securite_mensuel_actifs",
    "v_kpi_saisonnalite_mensuelle_cross_actifs_mv": "kpi_saisonnalite_actifs", "v_kpi_phase_journee_cross_actifs_mv": "kpi_phase_journee_actifs",
    "v_kpi_impact_vacances_cross_actifs_mv": "kpi_impact_vacances_actifs", "v_kpi_meteo_correlation_cross_actifs_mv": "kpi_meteo_correlation_actifs",
    "v_kpi_categorie_personne_comptage": "kpi_categorie_comptage", "v_kpi_taux_sauvetage_categorie": "kpi_taux_sauvetage_categorie",
    "v_kpi_evolution_categorie_mensuel": "kpi_evolution_categorie_mensuel", "v_kpi_cross_categorie_benchmark": "kpi_cross_categorie_benchmark",
    "v_kpi_securite_sans_clandestins": "kpi_securite_sans_clandestins", "v_kpi_categorie_geographique": "kpi_categorie_geographique",
    "v_kpi_carte_operations_categorie": "kpi_carte_operations",
}
_SQL = {**O.VIEWS, **R.SQL}


def counts_of(names: dict[str, str]) -> str:
    return union(*[f"SELECT '{public}' AS table_name, {N} AS lignes FROM ({_SQL[key]})" for public, key in names.items()])


SUMMARY = union(*[
    f"SELECT '{t}' AS table_name, 'ETL_LOAD' AS operation_type, '{{\"rows_loaded\":' || {rows_of(r)}::VARCHAR || ',\"type\":\"full_refresh\"}}' AS new_values"
    for t, r in (("operations", "ops"), ("flotteurs", "fl"), ("resultats_humain", "rh"))
])
SNAPSHOT = f"""new AS (SELECT {K}, o_custkey, CASE WHEN {K} % 30 <> 0 THEN o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate,
 CASE WHEN {K} % 10 = 0 THEN '9-NEW' ELSE o_orderpriority END AS o_orderpriority FROM orders WHERE {K} % 17 <> 0
 UNION ALL SELECT -{K} - 1, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE {K} % 23 = 0)"""
_STATUS = "o.o_orderstatus IS DISTINCT FROM n.o_orderstatus"
_PRIORITY = "o.o_orderpriority IS DISTINCT FROM n.o_orderpriority"
_BOTH = f"o.{K} IS NOT NULL AND n.{K} IS NOT NULL"
DIFF = f"""SELECT 'operations' AS table_name, CASE WHEN o.{K} IS NULL THEN 'INSERT' WHEN n.{K} IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation_type,
 coalesce(o.{K}, n.{K}) AS record_id, CASE WHEN n.{K} IS NULL THEN '{{"pk":' || o.{K}::VARCHAR || '}}' END AS old_values,
 CASE WHEN o.{K} IS NULL THEN '{{"pk":' || n.{K}::VARCHAR || '}}' WHEN {_BOTH} THEN '{{' || concat_ws(',',
   CASE WHEN {_PRIORITY} THEN '"o_orderpriority":{{"old":"' || o.o_orderpriority || '","new":"' || n.o_orderpriority || '"}}' END,
   CASE WHEN {_STATUS} THEN '"o_orderstatus":{{"old":"' || o.o_orderstatus || '","new":null}}' END) || '}}' END AS new_values,
 CASE WHEN {_BOTH} THEN concat_ws(',', CASE WHEN {_PRIORITY} THEN 'o_orderpriority' END, CASE WHEN {_STATUS} THEN 'o_orderstatus' END) END AS changed_fields,
 'system' AS user_id
 FROM orders o FULL JOIN new n ON o.{K} = n.{K} WHERE NOT ({_BOTH}) OR {_PRIORITY} OR {_STATUS}"""
EDGE = "TIMESTAMP '2024-01-12 00:00:00'"
PROFILE_COLUMNS = {
    "operation_id": ("ID Operation", "int", "Obligatoire, Min: 1", "-"), "type_operation": ("Type d''operation", "str", "-", "SAR, MAS, DIV..."),
    "sous_type_operation": ("Sous-type", "str", "Max 100 car.", "-"), "cross": ("CROSS", "str", "-", "Gris-Nez, Jobourg, Corsen..."),
    "departement": ("Departement", "str", "Max 3 car.", "-"), "zone_responsabilite": ("Zone de responsabilite", "str", "Max 50 car.", "-"),
    "latitude": ("Latitude", "float", "Min: -90, Max: 90", "-"), "longitude": ("Longitude", "float", "Min: -180, Max: 180", "-"),
    "est_metropolitain": ("Metropolitain", "bool", "-", "-"), "evenement": ("Evenement", "str", "Max 100 car.", "-"),
    "categorie_evenement": ("Categorie evenement", "str", "Max 100 car.", "-"), "vent_force": ("Force vent", "int", "Min: 0, Max: 12", "-"),
    "mer_force": ("Etat de mer", "int", "Min: 0, Max: 9", "-"),
    "vent_direction_categorie": ("Direction vent (categorie)", "str", "-", "nord, nord-est, est..."),
    A: ("Reception alerte", "datetime", "-", "-"), "date_heure_fin_operation": ("Fin operation", "datetime", "-", "-"),
    "prefecture_maritime": ("Prefecture maritime", "str", "-", "Atlantique, Manche et mer du Nord, Mediterranee"),
    "phase_journee": ("Phase de journee", "str", "-", "Nuit, Aube, Matin..."), "distance_cote_metres": ("Distance cote (m)", "float", "Min: 0", "-"),
    "distance_cote_milles_nautiques": ("Distance cote (NM)", "float", "Min: 0", "-"), "est_jour_ferie": ("Jour ferie", "bool", "-", "-"),
    "est_vacances_scolaires": ("Vacances scolaires", "bool", "-", "-"), "est_dans_stm": ("Dans STM", "bool", "-", "-"),
    "est_dans_dst": ("Dans DST", "bool", "-", "-"), "maree_coefficient": ("Coefficient maree", "int", "Min: 20, Max: 120", "-"),
    "maree_categorie": ("Categorie maree", "str", "-", "Morte-eau, Moyenne, Vive-eau"),
}
OF_GOOD = "operation_id IN (SELECT operation_id FROM good)"
GOOD_OPS = "operation_id % 41 <> 0 AND operation_id % 43 <> 0 AND est_metropolitain IS NOT NULL"
GOOD = f"good AS (SELECT operation_id FROM ops WHERE {GOOD_OPS})"
#: Every row of the files with what it fails itself and what its case brings.
_OWN = "nullif(concat_ws(';', CASE WHEN est_metropolitain IS NULL THEN 'est_metropolitain:not_null' END, CASE WHEN operation_id % 41 = 0 THEN 'numero_sitrep:x >= 0' END, CASE WHEN operation_id % 43 = 0 THEN 'systeme_source:isin' END), '')"
_PARENT = "CASE WHEN c.operation_id IS NULL THEN 'parent_missing' WHEN c.own IS NOT NULL THEN 'parent_rejected(' || c.own || ')' END"
JUDGED = f"""cases AS (SELECT operation_id, {_OWN} AS own FROM ops WHERE operation_id % 47 <> 0),
judged AS (SELECT 'operations' AS table_name, own AS why, NULL AS parent FROM cases
 UNION ALL SELECT 'operations_stats', {_PARENT}, {_PARENT} FROM ops o LEFT JOIN cases c ON o.operation_id = c.operation_id
 UNION ALL SELECT 'flotteurs', {_PARENT}, {_PARENT} FROM fl o LEFT JOIN cases c ON o.operation_id = c.operation_id
 UNION ALL SELECT 'resultats_humain', coalesce({_PARENT}, CASE WHEN categorie_personne IS NULL THEN 'not_null' END), {_PARENT} FROM rh o LEFT JOIN cases c ON o.operation_id = c.operation_id)"""

DATA = {
    "src_csv_scan": with_(f'SELECT operation_id, type_operation, "cross", vent_force, {A} FROM ops', OPS),
    "src_table_scan": with_(O.YEARLY),
    "src_sql_params": with_(f'SELECT "cross", {N} AS n FROM ops WHERE vent_force >= 6 AND "cross" IS NOT NULL GROUP BY 1', OPS),
    "src_column_subset": with_('SELECT operation_id, "cross", latitude FROM ops', OPS),
    "sink_table_replace_append": with_("SELECT operation_id, type_operation FROM ops UNION ALL SELECT operation_id, type_operation FROM ops WHERE type_operation = 'SAR'", OPS),
    "sink_bulk_full_refresh": with_(union(*[f"SELECT '{t}' AS table_name, {N} AS lignes FROM {r}" for t, r in (("operations", "ops"), ("flotteurs", "fl"), ("resultats_humain", "rh"))]), OPS, FL, RH),
    "sink_valid_rejected_errors": with_("""SELECT CASE WHEN b.row_id IS NULL THEN 'valid' ELSE 'rejected' END AS sortie, d.row_id, '' AS controle
 FROM d LEFT JOIN bad b ON d.row_id = b.row_id
 UNION ALL SELECT 'errors', row_id, "check" FROM fails""", DAMAGED, FAILS.replace("fails AS (", "fails AS MATERIALIZED (", 1), "bad AS MATERIALIZED (SELECT DISTINCT row_id FROM fails)"),
    "sink_versions_rollback": with_(union(*[
        f"SELECT '{t}' AS table_name, {N} AS lignes, '{reader}' AS lecteur FROM {r} WHERE {kept}"
        for t, r in (("operations", "ops"), ("resultats_humain", "rh"))
        for reader, kept in (("lecteur_2", "operation_id % 3 = 0"), ("lecteur_3", "true"), ("version_1", "true"))]), OPS, RH),
    "sink_csv_export": with_("SELECT id::VARCHAR AS id, table_name, operation_type, changed_fields, user_id FROM au", AU),
    "sink_view_export": with_(O.YOY_ALL),
    "sink_export_bundle": counts_of(BUNDLE),
    "sink_materialize_refresh": counts_of(STORED) + f""" UNION ALL SELECT 'case_facts', {N} FROM orders
 UNION ALL SELECT 'category_facts', {N} FROM (SELECT DISTINCT l_orderkey, l_partkey % 11 FROM lineitem)""",
    "sink_facts_by_case_vessels": _SQL["kpi_flotteurs_analyse"],
    "sink_facts_by_case_map": _SQL["kpi_carte_operations"],
    "sink_incremental_refresh": _SQL["kpi_securite_mensuel"],
    "sink_incremental_durations": f"SELECT cross_name, duree_moyenne_heures, duree_mediane_heures, duree_min_heures, duree_max_heures FROM ({_SQL['kpi_cross_benchmark']})",
    "etl_merge_stats": with_("""SELECT a.operation_id, a.type_operation, e.est_jour_ferie, e.phase_journee, e.maree_coefficient
 FROM ops a LEFT JOIN (SELECT * FROM ops WHERE NOT est_jour_ferie) e ON a.operation_id = e.operation_id""", OPS),
    "etl_coerce_int": with_("SELECT row_id, TRY_CAST(operation_id AS BIGINT) AS operation_id, CASE WHEN vent_force <> '3.5' THEN TRY_CAST(vent_force AS BIGINT) END AS vent_force FROM d", DAMAGED),
    "etl_coerce_int_report": with_(f"SELECT 'operation_id' AS colonne, 0::BIGINT AS non_entiers UNION ALL SELECT 'vent_force', count(*) FILTER (WHERE vent_force = '3.5')::BIGINT FROM d", DAMAGED),
    "etl_parse_datetime": with_(f"SELECT row_id, TRY_CAST({A} AS TIMESTAMP) AS {A} FROM d", DAMAGED),
    "etl_blank_to_null": with_("SELECT row_id, nullif(trim(type_operation), '') AS type_operation, nullif(trim(systeme_source), '') AS systeme_source FROM d", DAMAGED),
    "etl_sample_children": with_("""SELECT operation_id, numero_ordre, pavillon FROM fl WHERE operation_id IN
 (SELECT o_orderkey FROM orders ORDER BY md5('42:' || o_orderkey::VARCHAR), o_orderkey LIMIT 10000)""", FL),
    "etl_audit_summary": with_(f"SELECT *, 'system' AS user_id FROM ({SUMMARY})", OPS, FL, RH),
    "etl_verify_counts": with_(union(*[f"SELECT '{t}' AS table_name, {N} AS lignes FROM {r}" for t, r in (("operations", "ops"), ("flotteurs", "fl"), ("resultats_humain", "rh"))]), OPS, FL, RH),
    "etl_staged_load": with_(f"""{SUMMARY.replace("FROM rh)", f"FROM rh WHERE categorie_personne IS NOT NULL AND {OF_GOOD})").replace("FROM fl)", f"FROM fl WHERE {OF_GOOD})").replace("FROM ops)", f"FROM ops WHERE {GOOD_OPS})")}
 UNION ALL SELECT 'v_kpi_annuel', 'REPORT', (SELECT {N} FROM ops WHERE {GOOD_OPS})::VARCHAR""", OPS, FL, RH, GOOD),
    "etl_follow_parent": with_(f"""SELECT table_name, CASE WHEN why IS NULL THEN 'valid' ELSE 'rejected' END AS controle, {N} AS lignes FROM judged GROUP BY 1, 2
 UNION ALL SELECT table_name, parent, {N} FROM judged WHERE parent IS NOT NULL GROUP BY 1, 2""", OPS, FL, RH, JUDGED),
    "etl_loaded_tables": with_(union(
        f"SELECT 'operations' AS table_name, {N} AS lignes FROM good", f"SELECT 'flotteurs', {N} FROM fl WHERE {OF_GOOD}",
        f"SELECT 'resultats_humain', {N} FROM rh WHERE categorie_personne IS NOT NULL AND {OF_GOOD}"), OPS, FL, RH, GOOD),
    "etl_raw_types": with_(f"""SELECT colonne, type, valeurs FROM (SELECT {N} AS n, count(operation_id)::BIGINT AS ids, count(latitude)::BIGINT AS lats, count(*) FILTER (WHERE row_id % 3 <> 0)::BIGINT AS part FROM d
 WHERE NOT ({num('mer_force')} >= 10)) r, LATERAL (VALUES ('row_id', 'bigint', n), ('operation_id', 'string', ids), ('latitude', 'double', lats), ('vent_force', 'string', n),
 ('mer_force', 'bigint', n), ('systeme_source', 'string', n), ('pair', 'boolean', n), ('parfois', 'double', part), ('jamais', 'double', 0), ('montant', 'double', n)) AS v(colonne, type, valeurs)""", DAMAGED),
    "dq_file_headers": with_(f"""SELECT fichier, {N} AS lignes, count(row_id)::BIGINT AS n_row_id, count(CASE WHEN fichier <> 'c' THEN operation_id END)::BIGINT AS n_operation_id,
 count("cross")::BIGINT AS n_cross, count(CASE WHEN fichier <> 'b' THEN vent_force END)::BIGINT AS n_vent_force, count(mer_force)::BIGINT AS n_mer_force, v."column", v."check", v.value
 FROM (SELECT *, (['a','b','c'])[row_id % 3 + 1] AS fichier FROM d) x LEFT JOIN (VALUES ('b', 'vent_force', 'renamed_column', 'force du vent'), ('b', 'note', 'unexpected_column', '6'),
 ('c', 'operation_id', 'missing_column', NULL)) AS v(f, "column", "check", value) ON v.f = x.fichier GROUP BY ALL""", DAMAGED),
    "cdc_snapshot_diff": with_(DIFF, SNAPSHOT),
    "cdc_etl_bypass": with_(f"""SELECT 'operations' AS table_name, 'ETL_LOAD' AS operation_type, '{{"rows_loaded":' || {rows_of("new")}::VARCHAR || ',"type":"full_refresh"}}' AS new_values""", SNAPSHOT),
    "batch_upsert": f"""SELECT {K}, o_orderstatus, o_orderpriority FROM orders WHERE {K} % 5 <> 0 OR {K} % 15 = 0
 UNION ALL SELECT CASE WHEN {K} % 15 = 0 THEN -{K} - 1 ELSE {K} END, 'U', o_orderpriority FROM orders WHERE {K} % 5 = 0 AND ({K} % 10 <> 0 OR {K} % 15 = 0)""",
    "delete_cascade": with_(union(*[f"SELECT '{t}' AS table_name, {N} AS lignes FROM {r} WHERE operation_id % 7 <> 0" for t, r in (("operations", "ops"), ("flotteurs", "fl"), ("resultats_humain", "rh"))]), OPS, FL, RH),
    "audit_retention": with_(f"""SELECT id, table_name, operation_type, new_values, "timestamp" FROM au WHERE "timestamp" >= {EDGE}
 UNION ALL SELECT NULL, 'audit_log', 'ETL_LOAD', '{{"action":"cleanup","deleted_rows":' || {N}::VARCHAR || ',"retention_days":20}}', TIMESTAMP '2024-02-01' FROM au WHERE "timestamp" < {EDGE} HAVING count(*) > 0""", AU),
    "fk_orphans": with_("SELECT operation_id, numero_ordre FROM fl WHERE operation_id NOT IN (SELECT operation_id FROM ops WHERE NOT est_dans_stm)", FL, OPS),
    "create_with_relations": """SELECT o_orderkey AS operation_id, CASE WHEN i = 1 THEN 'Migrant' ELSE 'Autre' END AS categorie_personne, i * (o_custkey % 5) AS nombre
 FROM (SELECT *, unnest(range(1, o_orderkey % 3 + 2)) AS i FROM orders)""",
    "join_range_selfjoin": with_("""SELECT m.*, count(p.periode)::BIGINT AS mois_connus, sum(p.nb_operations)::BIGINT AS s_nb_operations, sum(p.total_personnes)::BIGINT AS s_total_personnes
 FROM m LEFT JOIN m p ON p.periode < m.periode AND p.periode >= m.periode - INTERVAL 12 MONTH GROUP BY ALL""",
        OPS, RH, ST, BASE, f"m AS (SELECT periode, {N} AS nb_operations, sum(im)::BIGINT AS total_personnes FROM base WHERE {DATED} GROUP BY 1)"),
    "join_left_fill": with_("SELECT operation_id, zone_responsabilite, im AS nombre_impliques, bl AS nombre_blesses FROM base"),
    "join_scalar_cross": with_(f"SELECT *, {pct('n', 'sum(n) OVER ()')} AS part FROM (SELECT evenement, {N} AS n FROM ops GROUP BY 1)", OPS),
    "join_active_semi": with_(f'SELECT operation_id, "cross" FROM ops WHERE {ON_ACTIVE}', OPS),
    "data_dictionary": with_(union(*[
        f"SELECT '{c}' AS champ, '{label}' AS libelle, '{kind}' AS type, '{limit}' AS contraintes, '{values}' AS valeurs, {N} AS lignes, (count(*) - count(\"{c}\"))::BIGINT AS manquantes, count(DISTINCT \"{c}\")::BIGINT AS distinctes FROM ops"
        for c, (label, kind, limit, values) in PROFILE_COLUMNS.items()]), OPS),
    "list_projection": with_(f"""SELECT operation_id AS "ID", coalesce(strftime({A}, '%Y-%m-%d %H:%M'), '-') AS "Reception alerte", coalesce(type_operation, '-') AS "Type d'operation",
 coalesce("cross", '-') AS "CROSS", coalesce(departement, '-') AS "Departement" FROM ops""", OPS),
    "stream_audit_counts": with_(f'SELECT "timestamp"::DATE AS jour, table_name, operation_type, {N} AS entrees FROM au GROUP BY 1, 2, 3', AU),
    "stream_stats_refresh": _SQL["operations_stats"] + " WHERE operation_id IN (SELECT operation_id FROM rh)",
    "stream_monthly_kpi": _SQL["kpi_securite_mensuel"],
}

DATA["audit_retention_days"] = DATA["audit_retention"]
DATA["batch_upsert_deltas"] = DATA["batch_upsert"]
DATA["delete_cascade_deltas"] = DATA["delete_cascade"]

SQL = {**QUALITY, **DATA}
