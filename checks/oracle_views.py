"""DuckDB versions of the indicator reports."""

from checks.sqlkit import ACTIVE, AU, BASE, DATED, FL, ON_ACTIVE, OPS, RH, ST, SUMS, grav, hu, pct, with_  # noqa: F401

SS_RATE, DE_RATE = pct("ss", "pec"), pct("de", "pec")
VIEWS: dict[str, str] = {}


def grouped(keys: str, where: str = "true", extra: str = "") -> str:
    more = f", {extra}" if extra else ""
    by = f"{keys}, " if keys else ""
    tail = "GROUP BY ALL" if keys else ""
    return f"(SELECT {by}{SUMS}{more} FROM base WHERE {where} {tail})"


def monthly(where: str, injured_over: str) -> str:
    return f"""SELECT periode, annee, mois, n AS nb_operations, ss AS total_saines_sauves, pec AS total_prises_en_compte,
 {SS_RATE} AS taux_saines_sauves, im AS total_impliques, de AS total_decedes, di AS total_disparus, se AS total_secourues,
 asi AS total_assistees, re AS total_retrouvees, bl AS total_blesses, ta AS total_tirees_affaire_seule,
 fa AS total_fausses_alertes, {DE_RATE} AS taux_mortalite, {pct("di", "pec")} AS taux_disparition,
 {pct("bl", injured_over)} AS taux_blessure, {grav()} AS indice_gravite
 FROM {grouped("periode, annee, mois", where)}"""


MONTHLY = {
    "kpi_securite_mensuel": monthly(DATED, "im"),
    "kpi_securite_mensuel_mv": monthly(DATED, "pec"),
    "kpi_securite_mensuel_actifs": monthly(f"{DATED} AND {ON_ACTIVE}", "pec"),
}


def benchmark(where: str) -> str:
    extra = (
        "sum(secs)::BIGINT AS s, count(secs)::BIGINT AS k, min(secs) AS lo_s, max(secs) AS hi_s,"
        " quantile_disc(secs, 0.5) AS q, (2 * median(secs))::BIGINT AS twice_median,"
        " min(date_heure_reception_alerte) AS d0, max(date_heure_reception_alerte) AS d1"
    )
    days = "((epoch(d1) - epoch(d0)) / 86400)::DOUBLE"
    return f"""SELECT "cross" AS cross_name, n AS nb_operations, {hu("s", "k * 3600", 2)} AS duree_moyenne_heures,
 {hu("twice_median", "7200", 2)} AS duree_mediane_heures, {hu("lo_s", "3600", 2)} AS duree_min_heures,
 {hu("hi_s", "3600", 2)} AS duree_max_heures, ss AS total_saines_sauves, pec AS total_prises_en_compte,
 {SS_RATE} AS taux_saines_sauves, im AS total_personnes, se AS total_secourues, asi AS total_assistees,
 re AS total_retrouvees, de AS total_decedes, di AS total_disparus, bl AS total_blesses, {DE_RATE} AS taux_mortalite,
 {hu("n", f"(floor({days}) + 1)::BIGINT", 2)} AS operations_par_jour, {hu("im", "n", 2)} AS personnes_par_operation,
 rank() OVER (ORDER BY n DESC)::BIGINT AS rank_volume,
 rank() OVER (ORDER BY ss::DOUBLE / nullif(pec, 0) DESC NULLS LAST)::BIGINT AS rank_sauvetage,
 rank() OVER (ORDER BY twice_median ASC NULLS LAST)::BIGINT AS rank_rapidite,
 d0::DATE AS premiere_operation, d1::DATE AS derniere_operation
 FROM {grouped('"cross"', where, extra)}"""


BENCHMARK_MV = benchmark(f'"cross" IS NOT NULL AND {DATED}')

VESSEL_SUMS = (
    "count(DISTINCT f.operation_id)::BIGINT AS n, count(*)::BIGINT AS v, "
    + ", ".join(f"coalesce(sum({x}), 0)::BIGINT AS {x}" for x in ("ss", "pec", "im", "de", "di", "bl"))
    + ", sum(round(distance_cote_metres * 100)::BIGINT)::BIGINT AS sm, count(distance_cote_metres)::BIGINT AS cm"
    ", sum(round(distance_cote_milles_nautiques * 10000)::BIGINT)::BIGINT AS sn, count(distance_cote_milles_nautiques)::BIGINT AS cn"
)
METRES, MILES = hu("sm", "cm * 100", 0), hu("sn", "cn * 10000", 2)


def vessels(keys: str, where: str) -> str:
    return (
        f"(SELECT {keys}, {VESSEL_SUMS} FROM fl f JOIN base b ON f.operation_id = b.operation_id"
        f" WHERE {where} GROUP BY ALL)"
    )


V3 = "type_flotteur, categorie_flotteur, resultat_flotteur"
VESSEL_ALL = f"""SELECT {V3}, n AS nb_operations, v AS nb_flotteurs, {pct("n", "sum(n) OVER ()")} AS pct_operations,
 ss AS total_saines_sauves, pec AS total_prises_en_compte, {SS_RATE} AS taux_saines_sauves, im AS total_personnes,
 de AS total_decedes, di AS total_disparus, bl AS total_blesses, {DE_RATE} AS taux_mortalite,
 {METRES} AS distance_cote_moyenne_m, {MILES} AS distance_cote_moyenne_nm, {hu("im", "n", 2)} AS personnes_par_operation
 FROM {vessels(V3, "true")}"""
VESSEL_ACTIVE = f"""SELECT {V3}, n AS nb_operations, v AS nb_flotteurs, ss AS total_saines_sauves, pec AS total_prises_en_compte,
 im AS total_personnes, de AS total_decedes, di AS total_disparus, {METRES} AS distance_cote_moyenne_m,
 {SS_RATE} AS taux_saines_sauves, {DE_RATE} AS taux_mortalite
 FROM {vessels(V3, f"{ON_ACTIVE} AND categorie_flotteur IS NOT NULL")}"""


def vessel_classes(where: str) -> str:
    return f"""SELECT categorie_flotteur, n AS total_operations, v AS total_flotteurs, im AS total_personnes,
 ss AS total_saines_sauves, de AS total_decedes, pec AS total_prises_en_compte, {SS_RATE} AS taux_saines_sauves,
 {DE_RATE} AS taux_mortalite, {METRES} AS distance_cote_moyenne_m
 FROM {vessels("categorie_flotteur", where)}"""


CALENDAR = f"""SELECT annee, mois, jour_semaine, nom_jour, phase_journee, est_jour_ferie, est_vacances_scolaires, maree_categorie,
 n AS nb_operations, ss AS total_saines_sauves, pec AS total_prises_en_compte, im AS total_personnes, de AS total_decedes,
 di AS total_disparus, de + di AS total_victimes, {hu("im", "n", 2)} AS moy_personnes_par_op,
 {SS_RATE} AS taux_saines_sauves, {grav()} AS indice_gravite
 FROM {grouped("annee, mois, dayofweek(date_heure_reception_alerte)::BIGINT AS jour_semaine, rpad(dayname(date_heure_reception_alerte), 9, ' ') AS nom_jour, phase_journee, est_jour_ferie, est_vacances_scolaires, maree_categorie", DATED)}"""
SEASON_ACTIVE = f"""SELECT annee, mois, n AS nb_operations, im AS total_personnes, de + di AS total_victimes, {grav()} AS indice_gravite_moyen
 FROM {grouped("annee, mois", f"{DATED} AND {ON_ACTIVE}")}"""
PHASE_ACTIVE = f"""SELECT annee, phase_journee, n AS total_operations, im AS total_personnes, de + di AS total_victimes, {grav()} AS indice_gravite_moyen
 FROM {grouped("annee, phase_journee", f"phase_journee IS NOT NULL AND {ON_ACTIVE}")}"""
HOLIDAY_ACTIVE = f"""SELECT annee, en_vacances, n AS total_operations, im AS total_personnes, de + di AS total_victimes,
 {hu("im", "n", 2)} AS moy_personnes_par_op, {grav()} AS indice_gravite_moyen
 FROM {grouped("annee, est_vacances_scolaires AS en_vacances", f"est_vacances_scolaires IS NOT NULL AND {ON_ACTIVE}")}"""
W5 = "vent_force, mer_force, vent_direction_categorie, maree_categorie, maree_coefficient"
HAS_WEATHER = "(vent_force IS NOT NULL OR mer_force IS NOT NULL)"
WEATHER = f"""SELECT {W5}, n AS nb_operations, ss AS total_saines_sauves, pec AS total_prises_en_compte, im AS total_personnes,
 de AS total_decedes, di AS total_disparus, bl AS total_blesses, de + di AS total_victimes, {hu("im", "n", 2)} AS moy_personnes_par_op,
 {SS_RATE} AS taux_saines_sauves, {DE_RATE} AS taux_mortalite, {grav()} AS indice_gravite
 FROM {grouped(W5, HAS_WEATHER)}"""
WEATHER_ACTIVE = f"""SELECT annee, vent_force, mer_force, n AS nb_operations, im AS total_personnes, de + di AS total_victimes,
 {DE_RATE} AS taux_mortalite, {grav()} AS indice_gravite
 FROM {grouped("annee, vent_force, mer_force", f"{HAS_WEATHER} AND {ON_ACTIVE}")}"""


def yoy(where: str, full: bool) -> str:
    def change(x):
        return f"{hu(f'{x} - lag({x}) OVER w', f'lag({x}) OVER w', 2, 100)}"

    more = (
        f""", bl AS total_blesses, {hu("s", "k * 3600", 2)} AS duree_moyenne_heures, lag(im) OVER w AS personnes_annee_precedente,
 lag(ss) OVER w AS sauves_annee_precedente, lag(de) OVER w AS decedes_annee_precedente, de - lag(de) OVER w AS yoy_decedes_diff"""
        if full
        else ""
    )
    return f"""SELECT annee, n AS nb_operations, ss AS total_saines_sauves, pec AS total_prises_en_compte, {SS_RATE} AS taux_saines_sauves,
 im AS total_personnes, de AS total_decedes, di AS total_disparus, {DE_RATE} AS taux_mortalite,
 lag(n) OVER w AS ops_annee_precedente, {change("n")} AS yoy_operations_pct, {change("im")} AS yoy_personnes_pct,
 {change("ss")} AS yoy_sauves_pct{more}
 FROM {grouped("annee", where, "sum(secs)::BIGINT AS s, count(secs)::BIGINT AS k")} WINDOW w AS (ORDER BY annee)"""


def alerts(where: str, by_centre: bool = False) -> str:
    """Twelve-month comparison written as a self join, unlike the library's range window."""
    key = '"cross", ' if by_centre else ""
    same = 'AND p."cross" IS NOT DISTINCT FROM m."cross"' if by_centre else ""
    stats = ", ".join(
        f"sum(p.{x})::HUGEINT AS s_{x}, sum((p.{x})::HUGEINT * p.{x})::HUGEINT AS q_{x}" for x in ("n", "im", "vi")
    )

    def z(x):
        v = f"(k * q_{x} - s_{x} * s_{x})::DOUBLE"
        return (
            f"CASE WHEN k > 1 AND {v} > 0 THEN ({x} * k - s_{x})::DOUBLE / sqrt({v} * k::DOUBLE / (k::DOUBLE - 1)) END"
        )

    def level(x):
        return f"CASE WHEN z_{x} > 2.5 THEN 'ALERTE' WHEN z_{x} > 1.5 THEN 'ATTENTION' ELSE 'NORMAL' END"

    def r(x):
        return f"sign(z_{x}) * floor(abs(z_{x}) * 100 + 0.5) / 100 + 0.0"

    label = '"cross" AS cross_name, ' if by_centre else ""
    return f"""SELECT {label}periode, n AS nb_operations, im AS total_personnes, de AS total_decedes, di AS total_disparus, vi AS total_victimes,
 {hu("n * k - s_n", "k", 2)} AS ecart_operations, {hu("im * k - s_im", "k", 2)} AS ecart_personnes, {hu("vi * k - s_vi", "k", 2)} AS ecart_victimes,
 {r("n")} AS zscore_operations, {r("im")} AS zscore_personnes, {r("vi")} AS zscore_victimes,
 {level("vi")} AS niveau_alerte_victimes, {level("n")} AS niveau_alerte_operations,
 {hu("s_n", "k", 2)} AS moyenne_operations, {hu("s_im", "k", 2)} AS moyenne_personnes, {hu("s_vi", "k", 2)} AS moyenne_victimes
 FROM (SELECT *, {z("n")} AS z_n, {z("im")} AS z_im, {z("vi")} AS z_vi FROM (
   WITH months AS (SELECT *, de + di AS vi FROM {grouped(key + "periode", where)})
   SELECT m.*, count(p.n)::BIGINT AS k, {stats}
   FROM months m LEFT JOIN months p ON p.periode < m.periode AND p.periode >= m.periode - INTERVAL 12 MONTH {same}
   GROUP BY ALL))"""


G5 = 'prefecture_maritime, "cross", departement, zone_responsabilite, est_metropolitain'
_MEANS = (
    "sum(round(latitude * 1000000)::BIGINT)::BIGINT AS sla, count(latitude)::BIGINT AS cla,"
    " sum(round(longitude * 1000000)::BIGINT)::BIGINT AS slo, count(longitude)::BIGINT AS clo,"
    " sum(round(distance_cote_metres * 100)::BIGINT)::BIGINT AS sm, count(distance_cote_metres)::BIGINT AS cm,"
    " count(*) FILTER (WHERE est_dans_stm)::BIGINT AS stm, count(*) FILTER (WHERE est_dans_dst)::BIGINT AS dst"
)
GEOGRAPHY = f"""SELECT prefecture_maritime, "cross" AS cross_name, departement, zone_responsabilite, est_metropolitain,
 n AS nb_operations, ss AS total_saines_sauves, pec AS total_prises_en_compte, im AS total_personnes, de AS total_decedes,
 di AS total_disparus, {hu("sla", "cla * 1000000", 4)} AS lat_moyenne, {hu("slo", "clo * 1000000", 4)} AS lon_moyenne,
 {METRES} AS distance_cote_moyenne_m, stm AS nb_dans_stm, dst AS nb_dans_dst, {SS_RATE} AS taux_saines_sauves, {DE_RATE} AS taux_mortalite
 FROM {grouped(G5, "true", _MEANS)}"""
K4 = "type_operation, sous_type_operation, evenement, categorie_evenement"
KINDS = f"""SELECT {K4}, n AS nb_operations, ss AS total_saines_sauves, pec AS total_prises_en_compte, im AS total_personnes,
 de AS total_decedes, di AS total_disparus, bl AS total_blesses, {hu("im", "n", 2)} AS moy_personnes_par_op,
 {hu("s", "k * 3600", 2)} AS duree_moyenne_heures, {SS_RATE} AS taux_saines_sauves, {DE_RATE} AS taux_mortalite, {grav()} AS indice_gravite
 FROM {grouped(K4, "true", "sum(secs)::BIGINT AS s, count(secs)::BIGINT AS k")}"""

# person categories, straight from person rows; `flat` drops accents
_FLAT = {
    "ss": "flat IN ('Personne secourue','Personne assistee','Personne retrouvee')",
    "pec": "flat IN ('Personne secourue','Personne assistee','Personne retrouvee','Personne disparue','Personne decedee','Personne decedee accidentellement','Personne decedee naturellement')",
    "de": "flat LIKE 'Personne decedee%'",
    "di": "flat = 'Personne disparue'",
}


def people(spelling: str = "replace(resultat_humain, 'é', 'e')") -> str:
    return f"""(SELECT rh.*, {spelling} AS flat, o."cross", o.prefecture_maritime, o.latitude, o.longitude, o.date_heure_reception_alerte,
 year(o.date_heure_reception_alerte)::BIGINT AS annee, month(o.date_heure_reception_alerte)::BIGINT AS mois,
 date_trunc('month', o.date_heure_reception_alerte)::DATE AS periode FROM rh JOIN ops o ON rh.operation_id = o.operation_id)"""


def tally(alias: str, extra: str = "true") -> str:
    return f"coalesce(sum(nombre) FILTER (WHERE ({_FLAT[alias]}) AND {extra}), 0)::BIGINT AS {alias}"


CAT = "coalesce(categorie_personne, 'Non renseigné') AS categorie_personne"
CAT_SUMS = (
    "count(DISTINCT operation_id)::BIGINT AS n, coalesce(sum(nombre), 0)::BIGINT AS im, coalesce(sum(dont_nombre_blesse), 0)::BIGINT AS bl, "
    + ", ".join(tally(a) for a in _FLAT)
)


def by_category(keys: str, where: str, spelling: str = "replace(resultat_humain, 'é', 'e')") -> str:
    return f"(SELECT {keys}, categorie_personne, {CAT_SUMS} FROM {people(spelling)} WHERE {where} GROUP BY ALL)"


CAT_COUNT = f"""SELECT {CAT}, annee, n AS nb_operations, im AS total_personnes, bl AS total_blesses, ss AS saines_sauves, de AS decedes, di AS disparus,
 {pct("im", "sum(im) OVER (PARTITION BY annee)")} AS pct_total_annee FROM {by_category("annee", DATED)}"""


def cat_rescue(spelling: str = "replace(resultat_humain, 'é', 'e')") -> str:
    return f"""SELECT {CAT}, annee, ss AS nombre_saines_sauves, pec AS nombre_prises_en_compte, de AS nombre_decedes, di AS nombre_disparus,
 bl AS nombre_blesses, im AS nombre_impliques FROM {by_category("annee", DATED, spelling)}"""


CAT_MONTH = f"""SELECT periode, annee, mois, {CAT}, n AS nb_operations, im AS total_personnes, ss AS saines_sauves, pec AS prises_en_compte,
 de AS decedes, di AS disparus FROM {by_category("periode, annee, mois", DATED)}"""
CAT_CENTRE = f"""SELECT "cross" AS cross_name, {CAT}, n AS nb_operations, im AS total_personnes, ss AS saines_sauves, pec AS prises_en_compte,
 de AS decedes, di AS disparus, {SS_RATE} AS taux_saines_sauves, rank() OVER (PARTITION BY t.categorie_personne ORDER BY im DESC)::BIGINT AS rank_volume_categorie
 FROM {by_category('"cross"', f'"cross" IS NOT NULL AND {DATED}')} t"""
_KEPT = "categorie_personne NOT IN ('Clandestin', 'Migrant')"
OFFICIAL_MONTH = f"""SELECT periode, annee, mois, "cross" AS cross_name, n AS nb_operations, kept AS total_personnes_sans_clandestins,
 ss AS saines_sauves_sans_clandestins, pec AS prises_en_compte_sans_clandestins, de AS decedes_sans_clandestins,
 every AS total_personnes_avec_clandestins, gone AS total_clandestins_migrants, {SS_RATE} AS taux_saines_sauves_sans_clandestins
 FROM (SELECT periode, annee, mois, "cross", count(DISTINCT operation_id)::BIGINT AS n,
   coalesce(sum(nombre) FILTER (WHERE {_KEPT}), 0)::BIGINT AS kept, {tally("ss", _KEPT)}, {tally("pec", _KEPT)}, {tally("de", _KEPT)},
   coalesce(sum(nombre), 0)::BIGINT AS every, coalesce(sum(nombre) FILTER (WHERE categorie_personne IN ('Clandestin', 'Migrant')), 0)::BIGINT AS gone
   FROM {people()} WHERE {DATED} GROUP BY ALL)"""
CAT_PLACE = f"""SELECT "cross" AS cross_name, prefecture_maritime, {CAT}, n AS nb_operations, im AS total_personnes, ss AS saines_sauves,
 {hu("sla", "k * 1000000", 4)} AS latitude, {hu("slo", "k * 1000000", 4)} AS longitude
 FROM (SELECT "cross", prefecture_maritime, categorie_personne, count(DISTINCT operation_id)::BIGINT AS n, coalesce(sum(nombre), 0)::BIGINT AS im,
   {tally("ss")}, sum(round(latitude * 1000000)::BIGINT)::BIGINT AS sla, sum(round(longitude * 1000000)::BIGINT)::BIGINT AS slo, count(*)::BIGINT AS k
   FROM {people()} WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND "cross" IS NOT NULL GROUP BY ALL)"""
CASE_MAP = """SELECT operation_id, cross_name, latitude, longitude, coalesce(categorie_personne, 'Non renseigné') AS categorie_personne, nb_personnes
 FROM (SELECT *, row_number() OVER (PARTITION BY operation_id ORDER BY nb_personnes DESC, categorie_personne ASC NULLS LAST) AS place
   FROM (SELECT o.operation_id, o."cross" AS cross_name, latitude, longitude, categorie_personne, sum(nombre)::BIGINT AS nb_personnes
   FROM ops o JOIN rh ON o.operation_id = rh.operation_id
   WHERE latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 GROUP BY ALL)) WHERE place = 1"""
HEADLINE = f"""SELECT n AS total_operations, nc AS nb_cross, nd AS nb_departements, im AS total_personnes, ss AS total_saines_sauves, de AS total_decedes,
 di AS total_disparus, bl AS total_blesses, pec AS total_prises_en_compte, d0 AS premiere_operation, d1 AS derniere_operation,
 {hu("twice_median", "120", 0)} AS duree_mediane
 FROM {grouped("", DATED, 'count(DISTINCT "cross")::BIGINT AS nc, count(DISTINCT departement)::BIGINT AS nd, min(date_heure_reception_alerte) AS d0, max(date_heure_reception_alerte) AS d1, (2 * median(secs) FILTER (WHERE secs >= 0))::BIGINT AS twice_median')}"""
YEARLY = f"""SELECT annee, n AS total_operations, im AS total_personnes, ss AS total_saines_sauves, de AS total_decedes, di AS total_disparus,
 pec AS total_prises_en_compte, {SS_RATE} AS taux_saines_sauves FROM {grouped("annee", DATED)}"""
CENTRES = f"""SELECT cross_name, n AS total_operations, im AS total_personnes, ss AS total_saines_sauves, de AS total_decedes, di AS total_disparus,
 {SS_RATE} AS taux_saines_sauves FROM {grouped("coalesce(\"cross\", 'Non renseigné') AS cross_name", DATED)}"""

_V = (OPS, RH, ST, BASE, FL)
_P = (OPS, RH)
ALERTS_ALL = alerts(DATED)
ALERTS_ACTIVE = alerts(f"{DATED} AND {ON_ACTIVE}")
ALERTS_BY_CENTRE = alerts(DATED, by_centre=True)
YOY_ALL, YOY_ACTIVE = yoy(DATED, True), yoy(f"{DATED} AND {ON_ACTIVE}", False)
CLASSES_ALL = vessel_classes("categorie_flotteur IS NOT NULL")
CLASSES_ACTIVE = vessel_classes(f"categorie_flotteur IS NOT NULL AND {ON_ACTIVE}")

VIEWS = {
    "operations_stats": with_(
        """SELECT operation_id, ss AS nombre_saines_sauves, pec AS nombre_prises_en_compte, de AS nombre_decedes, di AS nombre_disparus,
 bl AS nombre_blesses, se AS nombre_secourues, asi AS nombre_assistees, re AS nombre_retrouvees, ta AS nombre_tirees_affaire_seule,
 im AS nombre_impliques, fa AS nombre_fausses_alertes FROM st""",
        OPS, RH, ST,
    ),
    **{k: with_(v) for k, v in MONTHLY.items()},
    "kpi_cross_benchmark": with_(benchmark('"cross" IS NOT NULL')),
    "kpi_cross_benchmark_mv": with_(BENCHMARK_MV),
    "kpi_flotteurs_analyse": with_(VESSEL_ALL, *_V),
    "kpi_flotteurs_analyse_actifs": with_(VESSEL_ACTIVE, *_V),
    "kpi_flotteurs_categorie": with_(CLASSES_ALL, *_V),
    "kpi_flotteurs_categorie_actifs": with_(CLASSES_ACTIVE, *_V),
    "kpi_temporel_multidim": with_(CALENDAR),
    "kpi_saisonnalite_actifs": with_(SEASON_ACTIVE),
    "kpi_phase_journee_actifs": with_(PHASE_ACTIVE),
    "kpi_impact_vacances_actifs": with_(HOLIDAY_ACTIVE),
    "kpi_meteo_correlation": with_(WEATHER),
    "kpi_meteo_correlation_actifs": with_(WEATHER_ACTIVE),
    "kpi_yoy": with_(YOY_ALL),
    "kpi_yoy_actifs": with_(YOY_ACTIVE),
    "kpi_alertes_anomalies": with_(ALERTS_ALL),
    "kpi_alertes_anomalies_actifs": with_(ALERTS_ACTIVE),
    "kpi_alertes_par_cross": with_(ALERTS_BY_CENTRE),
    "kpi_geographique": with_(GEOGRAPHY),
    "kpi_type_operation": with_(KINDS),
    "kpi_categorie_comptage": with_(CAT_COUNT, *_P),
    "kpi_taux_sauvetage_categorie": with_(cat_rescue(), *_P),
    "kpi_taux_sauvetage_categorie_literal": with_(cat_rescue("resultat_humain"), *_P),
    "kpi_evolution_categorie_mensuel": with_(CAT_MONTH, *_P),
    "kpi_cross_categorie_benchmark": with_(CAT_CENTRE, *_P),
    "kpi_securite_sans_clandestins": with_(OFFICIAL_MONTH, *_P),
    "kpi_categorie_geographique": with_(CAT_PLACE, *_P),
    "kpi_carte_operations": with_(CASE_MAP, *_P),
    "kpi_global": with_(HEADLINE),
    "kpi_annuel": with_(YEARLY),
    "kpi_cross": with_(CENTRES),
}
