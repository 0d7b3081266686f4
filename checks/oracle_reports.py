"""DuckDB versions of the filters, reports, view questions and page tables."""

from checks import oracle_views as O
from checks.sqlkit import ACTIVE, AU, BASE, DATED, FL, ON_ACTIVE, OPS, RH, ST, grav, hu, pct, with_

A = "date_heure_reception_alerte"
D0, D1 = "TIMESTAMP '1996-03-01'", "TIMESTAMP '1998-06-30'"
PERIOD = f"{A} >= {D0} AND {A} <= {D1}"
N = "count(*)::BIGINT"


def s(column: str) -> str:
    return f"coalesce(sum({column}), 0)::BIGINT"


def ops(columns: str, where: str) -> str:
    return with_(f"SELECT operation_id{', ' if columns else ''}{columns} FROM ops WHERE {where}", OPS)


def base(body: str) -> str:
    return with_(body)


FILTERS = {
    "flt_optional_eq": ops('"cross", type_operation, departement', "type_operation = 'SAR'"),
    "flt_date_range": ops(A, PERIOD),
    "flt_active_centres": ops('"cross"', ON_ACTIVE),
    "flt_centre_override": ops('"cross"', "\"cross\" = 'NATION_12'"),
    "flt_centre_sentinel": ops('"cross"', ON_ACTIVE),
    "flt_type": ops("type_operation", "type_operation = 'MAS'"),
    "flt_casualties_tristate": base("SELECT operation_id, de AS nombre_decedes, di AS nombre_disparus FROM base WHERE de = 0 AND di = 0"),
    "flt_casualties_true": base("SELECT operation_id, de AS nombre_decedes, di AS nombre_disparus FROM base WHERE de > 0 OR di > 0"),
    "flt_min_persons": base("SELECT operation_id, im AS nombre_impliques FROM base WHERE im >= 12"),
    "flt_bbox": ops("latitude, longitude", "latitude >= 41 AND latitude <= 44 AND longitude >= 3 AND longitude <= 10"),
    "flt_valid_coords": ops("latitude, longitude", "latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180"),
    "flt_ilike": with_("SELECT operation_id, numero_ordre, type_flotteur FROM fl WHERE type_flotteur ILIKE '%SKI%'", FL),
    "flt_prefix_like": with_("SELECT operation_id, resultat_humain, nombre FROM rh WHERE resultat_humain LIKE 'Personne décédée%'", RH),
    "flt_wind_sea_range": ops("vent_force, mer_force", "vent_force BETWEEN 4 AND 8 AND mer_force >= 2"),
    "flt_category_group": with_("SELECT operation_id, categorie_personne, nombre FROM rh WHERE categorie_personne IN ('Pêcheur français','Pêcheur amateur','Commerce français')", RH),
    "flt_not_in_null": with_("SELECT operation_id, categorie_personne, nombre FROM rh WHERE categorie_personne NOT IN ('Clandestin', 'Migrant')", RH),
    "prj_recent_since": ops(A, f"{A} >= DATE '2001-08-01' - INTERVAL 3 YEAR"),
}

TOLL = ", ".join(
    f"{s(c)} AS total_{n}" for c, n in (
        ("de", "decedes"), ("di", "disparus"), ("bl", "blesses"), ("ss", "saines_sauves"), ("se", "secourues"),
        ("asi", "assistees"), ("re", "retrouvees"), ("im", "impliques"), ("pec", "prises_en_compte"))
)


def figures(where: str) -> str:
    return base(f"""SELECT {N} AS total_operations, count(DISTINCT "cross")::BIGINT AS nb_cross, count(DISTINCT departement)::BIGINT AS nb_departements,
 {s("im")} AS total_personnes, min({A}) AS premiere_operation, max({A}) AS derniere_operation FROM base WHERE {where}""")


def two(key: str, where: str, tail: str = "") -> str:
    return base(f"SELECT {key}, {N} AS total_operations, {s('im')} AS total_personnes FROM base WHERE {where} GROUP BY 1 {tail}")


LABEL = "coalesce(\"cross\", 'Non renseigné') AS \"cross\""


def toll_by_centre(where: str) -> str:
    return base(f"""SELECT {LABEL}, {s("de")} AS decedes, {s("di")} AS disparus, {s("bl")} AS blesses, {s("ss")} AS saines_sauves
 FROM base WHERE {where} GROUP BY 1""")


LISTED = f'operation_id, {A}, type_operation, "cross", departement, im AS nombre_impliques, ss AS nombre_saines_sauves, de AS nombre_decedes, di AS nombre_disparus'
EXTRACT = f'operation_id, {A}, type_operation, sous_type_operation, "cross", departement, latitude, longitude, im AS nombre_impliques, ss AS nombre_saines_sauves, de AS nombre_decedes, di AS nombre_disparus, bl AS nombre_blesses'
NEWEST = f"ORDER BY {A} DESC NULLS FIRST, operation_id"

REPORTS = {
    "q_kpis": figures(DATED),
    "q_kpis_actifs": figures(f"{DATED} AND {ON_ACTIVE}"),
    "q_nb_cross": with_(f'SELECT count(DISTINCT "cross")::BIGINT AS nb_cross FROM ops WHERE {ON_ACTIVE}', OPS),
    "q_nb_cross_tous": with_('SELECT count(DISTINCT "cross")::BIGINT AS nb_cross FROM ops', OPS),
    "q_kpis_by_period": base(f'SELECT {N} AS total_operations, {s("im")} AS total_personnes, count(DISTINCT "cross")::BIGINT AS nb_cross FROM base WHERE {PERIOD} AND {ON_ACTIVE}'),
    "q_by_cross": two(LABEL, "true"),
    "q_by_cross_actifs": two(LABEL, ON_ACTIVE),
    "q_by_type": with_(f"SELECT type_operation, total, {pct('total', 'sum(total) OVER ()')} AS pourcentage FROM (SELECT coalesce(type_operation, 'Autre') AS type_operation, {N} AS total FROM ops GROUP BY 1)", OPS),
    "q_by_department": two("departement", "departement IS NOT NULL", "ORDER BY 2 DESC, 1 LIMIT 20"),
    "q_cross_list": with_('SELECT DISTINCT "cross" FROM ops WHERE "cross" IS NOT NULL', OPS),
    "q_type_list": with_("SELECT DISTINCT type_operation FROM ops WHERE type_operation IS NOT NULL", OPS),
    "q_timeline": two(f"date_trunc('month', {A})::TIMESTAMP AS periode", DATED),
    "q_timeline_week": two(f"date_trunc('week', {A})::TIMESTAMP AS periode", f"{PERIOD} AND {ON_ACTIVE}"),
    "q_timeline_day": two(f"date_trunc('day', {A})::TIMESTAMP AS periode", DATED),
    "q_monthly_comparison": with_(f"SELECT year({A})::BIGINT AS annee, month({A})::BIGINT AS mois, {N} AS total_operations FROM ops WHERE {DATED} GROUP BY 1, 2", OPS),
    "q_yearly": two("annee", DATED),
    "q_yearly_actifs": two("annee", f"{DATED} AND {ON_ACTIVE}"),
    "q_bilan_global": base(f"SELECT {TOLL} FROM base"),
    "q_bilan_by_cross": toll_by_centre("true"),
    "q_bilan_by_cross_filtered": toll_by_centre(f"{PERIOD} AND {ON_ACTIVE}"),
    "q_bilan_by_period": base(f"SELECT {TOLL} FROM base WHERE {PERIOD}"),
    "q_resultats_stats": with_(f"SELECT coalesce(resultat_humain, 'Inconnu') AS resultat, coalesce(categorie_personne, 'Autre') AS categorie, {s('nombre')} AS total FROM rh GROUP BY resultat_humain, categorie_personne", RH),
    "q_flotteurs_stats": with_(f"SELECT coalesce(type_flotteur, 'Non renseigné') AS type_flotteur, coalesce(categorie_flotteur, 'Non renseigné') AS categorie_flotteur, {N} AS total FROM fl GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 15", FL),
    "q_flotteurs_pavillon": with_(f"SELECT *, {pct('total', 'sum(total) OVER ()')} AS pourcentage FROM (SELECT coalesce(pavillon, 'Inconnu') AS pavillon, {N} AS total FROM fl GROUP BY 1) ORDER BY total DESC, pavillon LIMIT 2", FL),
    "q_top_operations": base(f"""SELECT * FROM (SELECT operation_id, {A}, type_operation, "cross", im AS nombre_impliques, ss AS nombre_saines_sauves,
 row_number() OVER (ORDER BY im DESC, operation_id)::BIGINT AS rang FROM base WHERE im > 0) WHERE rang <= 10"""),
    "q_casualties": base(f"""SELECT operation_id, {A}, type_operation, "cross", departement, de AS nombre_decedes, di AS nombre_disparus, de + di AS total_victimes
 FROM base WHERE de > 0 OR di > 0 ORDER BY total_victimes DESC, {A} DESC NULLS FIRST, operation_id LIMIT 50"""),
    "q_search": base(f"SELECT {LISTED} FROM base WHERE type_operation = 'SAR' AND {A} >= {D0} AND im >= 3 AND (de > 0 OR di > 0) {NEWEST} LIMIT 40 OFFSET 15"),
    "q_search_default": base(f"SELECT {LISTED} FROM base {NEWEST} LIMIT 100"),
    "q_search_cursor": base(f"SELECT {LISTED} FROM base WHERE type_operation = 'SAR' {NEWEST} LIMIT 50 OFFSET 120"),
    "q_page_ordered": with_(f"SELECT operation_id, {A}, mer_force FROM ops {NEWEST} LIMIT 60 OFFSET 30", OPS),
    "q_operations_export": base(f"SELECT {EXTRACT} FROM base"),
    "q_operations_export_cross": base(f"SELECT {EXTRACT} FROM base WHERE \"cross\" = 'Corse' AND {PERIOD}"),
    "q_audit_logs": with_("""SELECT * FROM au WHERE operation_type = 'UPDATE' AND user_id ILIKE '%user_1%' AND "timestamp" >= TIMESTAMP '2024-01-10'
 ORDER BY "timestamp" DESC, id LIMIT 500""", AU),
    "q_audit_stats": with_(f"""SELECT {N} AS total_entries, count(DISTINCT table_name)::BIGINT AS tables_tracked, count(DISTINCT user_id)::BIGINT AS users_active,
 count(*) FILTER (WHERE operation_type = 'INSERT')::BIGINT AS total_inserts, count(*) FILTER (WHERE operation_type = 'UPDATE')::BIGINT AS total_updates,
 count(*) FILTER (WHERE operation_type = 'DELETE')::BIGINT AS total_deletes, min("timestamp") AS first_entry, max("timestamp") AS last_entry FROM au""", AU),
    "q_audited_tables": with_("SELECT DISTINCT table_name FROM au", AU),
    "q_page": with_(f"SELECT operation_id, {A}, mer_force FROM ops {NEWEST} LIMIT 60 OFFSET 30", OPS),
    "q_count": with_(f"SELECT {N} AS total FROM rh", RH),
    "q_op_search_count": with_(f"""SELECT operation_id, {A}, type_operation, "cross", departement, (SELECT {N} FROM m) AS total FROM m {NEWEST} LIMIT 50 OFFSET 20""",
        OPS, f"m AS (SELECT * FROM ops WHERE type_operation = 'MAS' AND departement = 'MACHINERY' AND {A} >= {D0})"),
    "q_distinct_values": with_("SELECT DISTINCT evenement FROM ops", OPS),
    "q_children_by_fk": with_("SELECT operation_id, numero_ordre, type_flotteur, pavillon FROM fl WHERE operation_id = 77", FL),
    "q_by_result": with_("SELECT operation_id, categorie_personne, resultat_humain, nombre, dont_nombre_blesse FROM rh WHERE resultat_humain = 'Personne disparue'", RH),
    "q_op_with_children": with_("""SELECT o.operation_id, type_operation, "cross", relation, rang, libelle, resultat, nombre FROM ops o LEFT JOIN (
   SELECT operation_id, 'flotteur' AS relation, numero_ordre AS rang, pavillon AS libelle, resultat_flotteur AS resultat, NULL::BIGINT AS nombre FROM fl
   UNION ALL SELECT operation_id, 'resultat', NULL, categorie_personne, resultat_humain, nombre FROM rh) c ON o.operation_id = c.operation_id""", OPS, FL, RH),
}


def safety(view: str, where: str) -> str:
    inner = f"""SELECT sum(nb_operations)::BIGINT AS n, sum(total_impliques)::BIGINT AS im, sum(total_decedes)::BIGINT AS de, sum(total_disparus)::BIGINT AS di,
 sum(total_saines_sauves)::BIGINT AS ss, sum(total_prises_en_compte)::BIGINT AS pec, sum(total_blesses)::BIGINT AS bl FROM ({O.MONTHLY[view]}) WHERE {where}"""
    return f"""SELECT n AS total_operations, im AS total_impliques, de AS total_decedes, di AS total_disparus, ss AS total_saines_sauves,
 pec AS total_prises_en_compte, bl AS total_blesses, {pct("de", "pec")} AS taux_mortalite, {pct("ss", "pec")} AS taux_saines_sauves, {grav()} AS indice_gravite FROM ({inner})"""


def lives(label: str, view: str, where: str) -> str:
    return base(f"""SELECT '{label}' AS periode, ss AS saines_sauves, pec AS prises_en_compte, n AS total_operations, {pct("ss", "pec")} AS taux_saines_sauves
 FROM (SELECT sum(total_saines_sauves)::BIGINT AS ss, sum(total_prises_en_compte)::BIGINT AS pec, sum(nb_operations)::BIGINT AS n FROM ({O.MONTHLY[view]}) WHERE {where})""")


MV, ACT = "kpi_securite_mensuel_mv", "kpi_securite_mensuel_actifs"


def of(view: str, tail: str, columns: str = "*") -> str:
    return base(f"SELECT {columns} FROM ({view}) {tail}")


def vessel(view: str, tail: str, columns: str = "*") -> str:
    return with_(f"SELECT {columns} FROM ({view}) {tail}", OPS, RH, ST, BASE, FL)


def person(view: str, tail: str, columns: str = "*") -> str:
    return with_(f"SELECT {columns} FROM ({view}) {tail}", OPS, RH)


def mean(column: str, places: int, digits: int) -> str:
    return hu(f"sum(round({column} * {10**places})::BIGINT)", f"count({column}) * {10**places}", digits)


def second(view: str, key: str, n: str, index: str, where: str, extra: str = "") -> str:
    return f"""SELECT {key}, sum({n})::BIGINT AS total_operations, sum(total_personnes)::BIGINT AS total_personnes, sum(total_victimes)::BIGINT AS total_victimes,
 {extra} {mean(index, 3, 3)} AS indice_gravite_moyen FROM ({view}) WHERE {where} GROUP BY 1"""


def shared(body: str) -> str:
    return base(f"SELECT *, {pct('total_operations', 'sum(total_operations) OVER ()')} AS pct_operations FROM ({body})")


PEOPLE_MEAN = mean("moy_personnes_par_op", 2, 2) + " AS moy_personnes_par_op,"
DEATH_MEAN = mean("taux_mortalite", 2, 2) + " AS taux_mortalite_moyen,"
SPORTS = "type_flotteur IN ('Kitesurf','Canoe/Kayak','Planche a voile','Jet-ski','Ski nautique','Engin de plage')"
SPORTS_ACTIVE = f"""SELECT *, {pct("total_decedes", "total_prises_en_compte")} AS taux_mortalite FROM (SELECT type_flotteur, categorie_flotteur,
 sum(nb_operations)::BIGINT AS nb_operations, sum(nb_flotteurs)::BIGINT AS nb_flotteurs, sum(total_saines_sauves)::BIGINT AS total_saines_sauves,
 sum(total_personnes)::BIGINT AS total_personnes, sum(total_decedes)::BIGINT AS total_decedes, sum(total_prises_en_compte)::BIGINT AS total_prises_en_compte
 FROM ({O.VESSEL_ACTIVE}) WHERE {SPORTS} GROUP BY 1, 2)"""
CENTRE_ALERT = "periode, nb_operations, total_personnes, total_decedes, total_disparus, total_victimes, zscore_operations, zscore_victimes, niveau_alerte_victimes, niveau_alerte_operations"
RAISED = "(niveau_alerte_victimes IN ('ALERTE','ATTENTION') OR niveau_alerte_operations IN ('ALERTE','ATTENTION'))"
BY_TYPE_ORDER = "ORDER BY nb_operations DESC, type_flotteur NULLS LAST, categorie_flotteur NULLS LAST, resultat_flotteur NULLS LAST"

VIEW_QUESTIONS = {
    "qk_securite_mensuel": of(O.MONTHLY[MV], "ORDER BY periode DESC LIMIT 24"),
    "qk_securite_mensuel_mois": of(O.MONTHLY[ACT], "WHERE mois = 7 ORDER BY periode DESC LIMIT 24"),
    "qk_securite_global": base(safety(MV, "true")),
    "qk_securite_global_periode": base(safety(ACT, "periode >= DATE '1996-03-01' AND periode <= DATE '1998-06-30'")),
    "qk_lives_saved": lives("CUMUL", MV, "true"),
    "qk_lives_saved_annee": lives("1998", ACT, "annee = 1998"),
    "qk_cross_benchmark": of(O.BENCHMARK_MV, "ORDER BY nb_operations DESC, cross_name LIMIT 5"),
    "qk_cross_benchmark_actifs": of(O.BENCHMARK_MV, f"WHERE cross_name IN {ACTIVE}"),
    "qk_cross_detail": of(O.BENCHMARK_MV, "WHERE cross_name = 'Corse'"),
    "qk_cross_ranking": of(O.BENCHMARK_MV, "", "cross_name, nb_operations, taux_saines_sauves, duree_mediane_heures, rank_volume, rank_sauvetage, rank_rapidite"),
    "qk_flotteurs_analyse": vessel(O.VESSEL_ALL, f"{BY_TYPE_ORDER} LIMIT 50"),
    "qk_flotteurs_analyse_actifs": vessel(O.VESSEL_ACTIVE, f"WHERE categorie_flotteur = 'Pêche' {BY_TYPE_ORDER} LIMIT 50"),
    "qk_flotteurs_categorie": vessel(O.CLASSES_ALL, ""),
    "qk_sports_nautiques": vessel(O.VESSEL_ALL, f"WHERE {SPORTS}"),
    "qk_sports_nautiques_actifs": vessel(SPORTS_ACTIVE, ""),
    "qk_temporel": of(O.CALENDAR, "WHERE annee = 1999 AND phase_journee = 'Matin' AND est_vacances_scolaires = false"),
    "qk_saisonnalite": base(second(O.CALENDAR, "mois", "nb_operations", "indice_gravite", "true")),
    "qk_saisonnalite_actifs": base(second(O.SEASON_ACTIVE, "mois", "nb_operations", "indice_gravite_moyen", "annee = 1997")),
    "qk_phase_journee": shared(second(O.CALENDAR, "phase_journee", "nb_operations", "indice_gravite", "phase_journee IS NOT NULL")),
    "qk_phase_journee_actifs": shared(second(O.PHASE_ACTIVE, "phase_journee", "total_operations", "indice_gravite_moyen", "true")),
    "qk_impact_vacances": base(second(O.CALENDAR, "est_vacances_scolaires AS en_vacances", "nb_operations", "indice_gravite", "est_vacances_scolaires IS NOT NULL", PEOPLE_MEAN)),
    "qk_impact_vacances_actifs": base(second(O.HOLIDAY_ACTIVE, "en_vacances", "total_operations", "indice_gravite_moyen", "true", PEOPLE_MEAN)),
    "qk_meteo_correlation": of(O.WEATHER, "WHERE vent_force BETWEEN 3 AND 9 AND mer_force BETWEEN 1 AND 6"),
    "qk_meteo_correlation_actifs": of(O.WEATHER_ACTIVE, "WHERE annee = 2000"),
    "qk_meteo_vent": base(second(O.WEATHER, "vent_force", "nb_operations", "indice_gravite", "vent_force IS NOT NULL", DEATH_MEAN)),
    "qk_meteo_mer": base(second(O.WEATHER_ACTIVE, "mer_force", "nb_operations", "indice_gravite", "mer_force IS NOT NULL AND annee = 1998", DEATH_MEAN)),
    "qk_yoy": of(O.YOY_ALL, "WHERE annee <= 2000 ORDER BY annee DESC LIMIT 4"),
    "qk_yoy_latest": of(O.YOY_ALL, "ORDER BY annee DESC LIMIT 1"),
    "qk_alertes": of(O.ALERTS_ALL, "ORDER BY periode DESC LIMIT 12"),
    "qk_alertes_cross": of(O.alerts(f"{DATED} AND \"cross\" = 'Corse'"), "ORDER BY periode DESC LIMIT 24", CENTRE_ALERT),
    "qk_alertes_niveau": of(O.ALERTS_ACTIVE, "WHERE niveau_alerte_victimes = 'ATTENTION' OR niveau_alerte_operations = 'ATTENTION' ORDER BY periode DESC LIMIT 40"),
    "qk_alertes_actives": of(O.ALERTS_ALL, f"WHERE {RAISED}"),
    "qk_alertes_actives_cross": of(O.alerts(f"{DATED} AND \"cross\" = 'Jobourg'"), f"WHERE {RAISED} ORDER BY periode DESC LIMIT 24", CENTRE_ALERT),
    "qk_geographique": of(O.GEOGRAPHY, "WHERE cross_name = 'Jobourg'"),
    "qk_par_prefecture": base(f"""SELECT *, {pct("total_saines_sauves", "total_prises_en_compte")} AS taux_saines_sauves, {pct("total_decedes", "total_prises_en_compte")} AS taux_mortalite
 FROM (SELECT prefecture_maritime, sum(nb_operations)::BIGINT AS total_operations, sum(total_personnes)::BIGINT AS total_personnes, sum(total_saines_sauves)::BIGINT AS total_saines_sauves,
 sum(total_prises_en_compte)::BIGINT AS total_prises_en_compte, sum(total_decedes)::BIGINT AS total_decedes, sum(total_disparus)::BIGINT AS total_disparus,
 {mean("distance_cote_moyenne_m", 0, 0)} AS distance_cote_moyenne_m FROM ({O.GEOGRAPHY}) WHERE prefecture_maritime IS NOT NULL GROUP BY 1)"""),
    "qk_type_operation": of(O.KINDS, "WHERE type_operation = 'SAR' AND categorie_evenement = 'CE1'"),
    "qk_comptage_categorie": person(O.CAT_COUNT, "WHERE annee = 1999"),
    "qk_taux_categorie": person(O.cat_rescue(), "WHERE categorie_personne NOT IN ('Clandestin', 'Migrant')"),
    "qk_evolution_categorie": person(O.CAT_MONTH, "WHERE categorie_personne = 'Migrant' ORDER BY periode DESC LIMIT 24"),
    "qk_cross_categorie": person(O.CAT_CENTRE, "WHERE cross_name = 'Corse'"),
    "qk_sans_clandestins": person(O.OFFICIAL_MONTH, "WHERE annee = 1998 AND cross_name = 'Corse'"),
    "qk_carte_categories": person(O.CAT_PLACE, "WHERE categorie_personne = 'Marin étranger'"),
    "qk_carte_operations": person(O.CASE_MAP, "WHERE latitude >= 41 AND latitude <= 51.5 AND longitude >= -5.5 AND longitude <= 100 ORDER BY nb_personnes DESC, operation_id LIMIT 500"),
    "qk_global": base(O.HEADLINE),
    "qk_annuel": base(O.YEARLY),
    "qk_cross": of(O.CENTRES, f"WHERE cross_name IN {ACTIVE}"),
    "qk_cross_names": of(O.CENTRES, "WHERE cross_name <> 'Non renseigné'", "cross_name"),
    "qk_years": of(O.YEARLY, "", "annee"),
}

SINCE = f"{A} >= TIMESTAMP '1997-01-01'"


def filled(period: str, step: str) -> str:
    return base(f"""SELECT g.periode, coalesce(n, 0)::BIGINT AS total_operations, coalesce(im, 0)::BIGINT AS total_personnes
 FROM (SELECT unnest(generate_series(lo, hi, INTERVAL {step}))::DATE AS periode FROM (SELECT min({period})::TIMESTAMP AS lo, max({period})::TIMESTAMP AS hi FROM base WHERE {SINCE})) g
 LEFT JOIN (SELECT ({period})::DATE AS periode, {N} AS n, {s("im")} AS im FROM base WHERE {SINCE} GROUP BY 1) b ON g.periode = b.periode""")


FRAME = f"""operation_id, {A}, type_operation, "cross", departement, latitude, longitude, evenement, categorie_evenement,
 im AS nombre_impliques, ss AS nombre_saines_sauves, de AS nombre_decedes, di AS nombre_disparus, bl AS nombre_blesses, pec AS nombre_prises_en_compte"""


def frame_figures(where: str) -> str:
    return base(f"""SELECT {N} AS total_operations, count(DISTINCT "cross")::BIGINT AS nb_cross, count(DISTINCT departement)::BIGINT AS nb_departements, {s("im")} AS total_personnes,
 {s("ss")} AS total_saines_sauves, {s("de")} AS total_decedes, {s("di")} AS total_disparus, min({A}) AS premiere_operation, max({A}) AS derniere_operation FROM base WHERE {where}""")


MERGED = "CASE WHEN categorie_personne IN ('Clandestin','Migrant') THEN 'Migrant/Clandestin' ELSE categorie_personne END AS categorie_personne"
MATRIX = ["Autre", "Plaisancier français", "Pratiquant loisirs nautiques", "Migrant", "Commerce français", "Marin étranger", "Pêcheur français", "Pêcheur amateur", "Non renseigné"]
_cell = ", ".join(
    "coalesce(sum(total_personnes) FILTER (WHERE categorie_personne "
    + ("IN ('Migrant','Clandestin')" if m == "Migrant" else f"= '{m}'")
    + f'), 0)::BIGINT AS "{m}"'
    for m in MATRIX
) + (
    ", coalesce(sum(total_personnes) FILTER (WHERE categorie_personne NOT IN ('Migrant','Clandestin','Migrant/Clandestin','Toutes catégories',"
    + ", ".join(f"'{m}'" for m in MATRIX) + ')), 0)::BIGINT AS "Autres catégories"'
)
H3 = "categorie_flotteur, type_flotteur, resultat_flotteur"
LABELLED = " AND ".join(f"{k} IS NOT NULL" for k in H3.split(", "))
MONTH_LABEL = "(['Jan','Fév','Mar','Avr','Mai','Jun','Jul','Aoû','Sep','Oct','Nov','Déc'])[mois]"

PAGES = {
    "src_base_extract": base(f"SELECT {FRAME} FROM base WHERE {A} >= DATE '2001-08-01' - INTERVAL 3 YEAR"),
    "src_base_light": base(f'SELECT operation_id, {A}, "cross", type_operation, im AS nombre_impliques, ss AS nombre_saines_sauves, de AS nombre_decedes, di AS nombre_disparus FROM base WHERE {DATED}'),
    "df_kpis": frame_figures(SINCE),
    "df_kpis_empty": frame_figures("false"),
    "df_by_cross": base(f"SELECT {LABEL}, {N} AS total_operations, {s('im')} AS total_personnes, {s('ss')} AS nombre_saines_sauves FROM base WHERE {SINCE} GROUP BY base.\"cross\""),
    "df_by_type": with_(f"""SELECT coalesce(type_operation, 'Autre') AS type_operation, total, round_even((total::DOUBLE / (sum(total) OVER ())::DOUBLE * 100) * 100, 0) / 100 AS pourcentage
 FROM (SELECT type_operation, {N} AS total FROM ops WHERE {SINCE} GROUP BY 1)""", OPS),
    "df_timeline_gapfill": filled(A, "1 DAY"),
    "df_timeline_gapfill_week": filled(f"{A} + to_days((7 - isodow({A}))::INTEGER)", "7 DAY"),
    "df_timeline_gapfill_month": filled(f"date_trunc('month', {A})", "1 MONTH"),
    "df_yearly": base(f"SELECT annee, {N} AS total_operations, {s('im')} AS total_personnes, {s('ss')} AS nombre_saines_sauves, {s('de')} AS nombre_decedes FROM base WHERE {SINCE} GROUP BY 1"),
    "df_bilan": base(f"SELECT {s('ss')} AS total_saines_sauves, {s('de')} AS total_decedes, {s('di')} AS total_disparus, {s('bl')} AS total_blesses, {s('im')} AS total_impliques FROM base WHERE {SINCE}"),
    "df_bilan_by_cross": base(f"SELECT {LABEL}, {s('ss')} AS saines_sauves, {s('de')} AS decedes, {s('di')} AS disparus, {s('bl')} AS blesses FROM base WHERE {SINCE} GROUP BY base.\"cross\""),
    "pg_severity_heatmap": of(O.MONTHLY["kpi_securite_mensuel"], "GROUP BY annee", "annee, " + ", ".join(f"avg(indice_gravite) FILTER (WHERE mois = {m}) AS m{m:02d}" for m in range(1, 13))),
    "pg_wind_sea_matrix": of(O.WEATHER, "WHERE vent_force IS NOT NULL AND mer_force IS NOT NULL AND indice_gravite IS NOT NULL GROUP BY vent_force", "vent_force, " + ", ".join(
        hu(f"sum(round(indice_gravite * 1000)::BIGINT) FILTER (WHERE mer_force = {m})", f"count(*) FILTER (WHERE mer_force = {m}) * 1000", 6) + f" AS mer_{m}" for m in range(10)) + ", "
        + hu("sum(round(indice_gravite * 1000)::BIGINT) FILTER (WHERE mer_force NOT BETWEEN 0 AND 9)", "count(*) FILTER (WHERE mer_force NOT BETWEEN 0 AND 9) * 1000", 6) + " AS mer_autre"),
    "pg_cross_category_matrix": person(O.CAT_CENTRE, "GROUP BY cross_name", f"cross_name, {_cell}"),
    "pg_category_recode_share": person(f"SELECT {MERGED}, sum(total_personnes)::BIGINT AS total_personnes, sum(nb_operations)::BIGINT AS nb_operations FROM ({O.CAT_COUNT}) GROUP BY 1", "", f"*, {pct('total_personnes', 'sum(total_personnes) OVER ()')} AS part"),
    "pg_category_rate": person(f"""SELECT {MERGED}, sum(nombre_saines_sauves)::BIGINT AS nombre_saines_sauves, sum(nombre_prises_en_compte)::BIGINT AS nombre_prises_en_compte,
 sum(nombre_decedes)::BIGINT AS nombre_decedes, sum(nombre_disparus)::BIGINT AS nombre_disparus, sum(nombre_impliques)::BIGINT AS nombre_impliques FROM ({O.cat_rescue()}) GROUP BY 1""", "",
        "*, round_even((nombre_saines_sauves::DOUBLE / (CASE WHEN nombre_prises_en_compte = 0 THEN 1 ELSE nombre_prises_en_compte END)::DOUBLE * 100) * 100, 0) / 100 AS taux_saines_sauves"),
    "pg_top5_categories_trend": with_(f"""SELECT * FROM c WHERE categorie_personne IN (SELECT categorie_personne FROM c WHERE categorie_personne <> 'Toutes catégories'
 GROUP BY 1 ORDER BY sum(total_personnes) DESC, 1 LIMIT 5)""", OPS, RH, f"c AS ({O.CAT_COUNT})"),
    "pg_hierarchy": vessel(O.VESSEL_ACTIVE, f"WHERE {LABELLED} GROUP BY ALL", f"{H3}, sum(nb_operations)::BIGINT AS nb_operations"),
    "pg_hierarchy_rollup": vessel(O.VESSEL_ACTIVE, f"WHERE {LABELLED} GROUP BY ROLLUP ({H3})", f"{H3}, sum(nb_operations)::BIGINT AS nb_operations"),
    "pg_status_level": of(O.MONTHLY["kpi_securite_mensuel"], "", """periode,
 CASE WHEN coalesce(taux_saines_sauves, 0) >= 98 THEN 'Excellent' WHEN coalesce(taux_saines_sauves, 0) >= 95 THEN 'Attention' ELSE 'Critique' END AS statut_sauvetage,
 CASE WHEN coalesce(taux_mortalite, 0) <= 1 THEN 'Normal' WHEN coalesce(taux_mortalite, 0) <= 3 THEN 'Élevé' ELSE 'Critique' END AS statut_mortalite,
 CASE WHEN coalesce(indice_gravite, 0) <= 0.05 THEN 'Faible' WHEN coalesce(indice_gravite, 0) <= 0.1 THEN 'Modéré' ELSE 'Élevé' END AS statut_gravite"""),
    "pg_alert_counts": of(O.ALERTS_ALL, "", """count(*) FILTER (WHERE niveau_alerte_victimes = 'ALERTE' OR niveau_alerte_operations = 'ALERTE')::BIGINT AS nb_alertes,
 count(*) FILTER (WHERE niveau_alerte_victimes = 'ATTENTION' OR niveau_alerte_operations = 'ATTENTION')::BIGINT AS nb_attention"""),
    "pg_radar_scores": of(O.BENCHMARK_MV, "", "cross_name, " + ", ".join(
        f"{c}::DOUBLE / greatest(max({c}) OVER (), 1)::DOUBLE * 100 AS {a}" for c, a in (("nb_operations", "volume"), ("total_personnes", "personnes"), ("total_saines_sauves", "saines_sauves")))
        + ", coalesce(taux_saines_sauves, 0)::DOUBLE AS taux, 100::DOUBLE - least(coalesce(duree_mediane_heures, 0) * 10, 100)::DOUBLE AS rapidite"),
    "pg_overview_means": of(O.BENCHMARK_MV, "", f"""{N} AS nb_cross, {mean("taux_saines_sauves", 2, 6)} AS taux_moyen, {mean("duree_mediane_heures", 2, 6)} AS duree_moyenne,
 sum(nb_operations)::BIGINT AS total_operations"""),
    "pg_outcome_shares": base(" UNION ALL ".join(
        f"SELECT '{label}' AS categorie, {c} AS nombre, {hu(c, 'greatest(total_impliques, 1)', 1, 100)} AS pourcentage FROM ({safety(MV, 'true')})"
        for label, c in (("Saines et Sauves", "total_saines_sauves"), ("Blessés", "total_blesses"), ("Décédés", "total_decedes"), ("Disparus", "total_disparus")))),
    "pg_sports_totals": vessel(f"SELECT sum(nb_operations)::BIGINT AS total_operations, sum(total_personnes)::BIGINT AS total_personnes, sum(total_decedes)::BIGINT AS total_decedes FROM ({SPORTS_ACTIVE})", "", f"*, {pct('total_decedes', 'total_personnes')} AS taux_mortalite"),
    "pg_audit_diff_rows": with_("SELECT id, changed_fields AS champ, '-' AS avant, new_values->>'$.k' AS apres FROM au WHERE operation_type = 'UPDATE'", AU),
    "pg_month_label": base(f"SELECT mois, {MONTH_LABEL} AS nom_mois, total_operations FROM ({second(O.CALENDAR, 'mois', 'nb_operations', 'indice_gravite', 'true')})"),
    "pg_holiday_label": base(f"SELECT en_vacances, CASE WHEN en_vacances THEN 'Vacances' ELSE 'Hors vacances' END AS libelle, total_operations FROM ({second(O.CALENDAR, 'est_vacances_scolaires AS en_vacances', 'nb_operations', 'indice_gravite', 'est_vacances_scolaires IS NOT NULL')})"),
}

SQL = {**FILTERS, **REPORTS, **VIEW_QUESTIONS, **PAGES}
