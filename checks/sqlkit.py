"""Pieces of DuckDB SQL shared by the comparison queries."""

from __future__ import annotations

ACTIVE = (
    "('Antilles-Guyane','Corse','Corsen','Étel','Etel','Gris-Nez','Jobourg','La Garde',"
    "'Nouvelle-Calédonie','Polynésie','Sud océan Indien')"
)
CATEGORIES = (
    "['Autre','Plaisancier français','Pratiquant loisirs nautiques','Migrant','Clandestin',"
    "'Commerce français','Marin étranger','Pêcheur français','Pêcheur amateur','Toutes catégories']"
)
OUTCOMES = (
    "['Personne secourue','Personne assistée','Personne retrouvée','Personne disparue',"
    "'Personne décédée','Personne décédée accidentellement','Personne décédée naturellement',"
    "'Personne tirée d''affaire seule','Personne impliquée dans fausse alerte']"
)
COMPASS = "['nord','nord-est','est','sud-est','sud','sud-ouest','ouest','nord-ouest']"

OPS = f"""ops AS (
  SELECT o_orderkey AS operation_id,
    CASE left(o_orderpriority,1) WHEN '1' THEN 'SAR' WHEN '2' THEN 'MAS' WHEN '3' THEN 'SUR' WHEN '5' THEN 'DIV' END AS type_operation,
    'ST' || (o_orderkey % 4)::VARCHAR AS sous_type_operation,
    CASE WHEN c_nationkey <= 10 THEN (['Antilles-Guyane','Corse','Corsen','Étel','Etel','Gris-Nez','Jobourg','La Garde','Nouvelle-Calédonie','Polynésie','Sud océan Indien'])[c_nationkey + 1]
         WHEN c_nationkey <> 24 THEN n_name END AS "cross",
    c_mktsegment AS departement, n_regionkey = 3 AS est_metropolitain, o_orderstatus AS zone_responsabilite,
    CASE WHEN o_orderkey % 50 <> 0 THEN ((o_orderkey * 37) % 18000)::DOUBLE / 100 - 90 END AS latitude,
    CASE WHEN o_orderkey % 50 <> 0 THEN ((o_orderkey * 91) % 36000)::DOUBLE / 100 - 180 END AS longitude,
    'EV' || (o_orderkey % 8)::VARCHAR AS evenement, 'CE' || (o_orderkey % 3)::VARCHAR AS categorie_evenement,
    ({COMPASS})[o_orderkey % 8 + 1] AS vent_direction_categorie,
    CASE WHEN o_custkey % 11 <> 0 THEN o_orderkey % 13 END AS vent_force,
    CASE WHEN o_custkey % 7 <> 0 THEN o_custkey % 10 END AS mer_force,
    CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate END AS date_heure_reception_alerte,
    CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate + to_minutes((o_orderkey * 17) % 4320 - 60) END AS date_heure_fin_operation,
    day(o_orderdate) = 1 AS est_jour_ferie,
    CASE WHEN o_orderkey % 89 <> 0 THEN month(o_orderdate) IN (7, 8) END AS est_vacances_scolaires,
    CASE WHEN o_custkey % 6 <> 0 THEN (['Nuit','Matin','Apres-midi','Soir','Aube'])[o_custkey % 6] END AS phase_journee,
    CASE WHEN o_orderkey % 31 <> 0 THEN (o_orderkey % 50000)::DOUBLE / 4 END AS distance_cote_metres,
    CASE WHEN o_orderkey % 31 <> 0 THEN (o_orderkey % 27000)::DOUBLE / 1000 END AS distance_cote_milles_nautiques,
    o_orderkey % 9 = 0 AS est_dans_stm, o_orderkey % 14 = 0 AS est_dans_dst,
    CASE WHEN r_regionkey <> 4 THEN r_name END AS prefecture_maritime,
    o_orderkey % 101 + 20 AS maree_coefficient,
    CASE WHEN o_orderkey % 101 <= 25 THEN '20-45' WHEN o_orderkey % 101 <= 50 THEN '46-70' WHEN o_orderkey % 101 <= 75 THEN '71-95' ELSE '96-120' END AS maree_categorie
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)"""
FL = """fl AS (
  SELECT l_orderkey AS operation_id, l_linenumber::BIGINT AS numero_ordre,
    CASE WHEN p_partkey % 12 < 6 THEN (['Kitesurf','Canoe/Kayak','Planche a voile','Jet-ski','Ski nautique','Engin de plage'])[p_partkey % 12 + 1]
         WHEN p_partkey % 12 < 11 THEN p_type END AS type_flotteur,
    CASE WHEN p_size % 6 <> 0 THEN (['Pêche','Plaisance','Commerce','Loisir nautique','Autre'])[p_size % 6] END AS categorie_flotteur,
    CASE l_returnflag WHEN 'R' THEN 'Français' WHEN 'N' THEN 'Étranger' END AS pavillon,
    CASE WHEN l_linestatus = 'O' THEN 'Remorqué' ELSE 'Assisté' END AS resultat_flotteur
  FROM lineitem LEFT JOIN part ON l_partkey = p_partkey)"""
RH = f"""rh AS (
  SELECT l_orderkey AS operation_id,
    CASE WHEN l_partkey % 11 <> 0 THEN ({CATEGORIES})[l_partkey % 11] END AS categorie_personne,
    ({OUTCOMES})[l_suppkey % 9 + 1] AS resultat_humain,
    floor(l_quantity)::BIGINT % 6 AS nombre,
    least(floor(l_quantity)::BIGINT % 6, l_linenumber % 3)::BIGINT AS dont_nombre_blesse
  FROM lineitem)"""


def _when(labels: str) -> str:
    return f"coalesce(sum(nombre) FILTER (WHERE resultat_humain IN ({labels})), 0)::BIGINT"


_DEAD = "'Personne décédée','Personne décédée accidentellement','Personne décédée naturellement'"
_SAFE = "'Personne secourue','Personne assistée','Personne retrouvée'"
ST = f"""st AS (
  SELECT ops.operation_id, {_when(_SAFE)} AS ss, {_when(_SAFE + ",'Personne disparue'," + _DEAD)} AS pec,
    {_when(_DEAD)} AS de, {_when("'Personne disparue'")} AS di, coalesce(sum(dont_nombre_blesse), 0)::BIGINT AS bl,
    {_when("'Personne secourue'")} AS se, {_when("'Personne assistée'")} AS asi, {_when("'Personne retrouvée'")} AS re,
    {_when("'Personne tirée d''affaire seule'")} AS ta, coalesce(sum(nombre), 0)::BIGINT AS im,
    {_when("'Personne impliquée dans fausse alerte'")} AS fa
  FROM ops LEFT JOIN rh ON ops.operation_id = rh.operation_id GROUP BY ops.operation_id)"""
BASE = """base AS (
  SELECT ops.*, ss, pec, de, di, bl, se, asi, re, ta, im, fa,
    year(date_heure_reception_alerte)::BIGINT AS annee, month(date_heure_reception_alerte)::BIGINT AS mois,
    date_trunc('month', date_heure_reception_alerte)::DATE AS periode,
    (epoch(date_heure_fin_operation) - epoch(date_heure_reception_alerte))::BIGINT AS secs
  FROM ops LEFT JOIN st ON ops.operation_id = st.operation_id)"""
AU = """au AS (
  SELECT event_id AS id, (['operations','flotteurs','resultats_humain'])[user_id % 3 + 1] AS table_name,
    CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'view' THEN 'UPDATE' WHEN 'click' THEN 'UPDATE' WHEN 'error' THEN 'DELETE' WHEN 'purchase' THEN 'ETL_LOAD' END AS operation_type,
    user_id AS record_id, NULL::VARCHAR AS old_values, props AS new_values,
    CASE WHEN event_type IN ('view', 'click') THEN 'k' END AS changed_fields,
    'User_' || user_id::VARCHAR AS user_id, ts AS "timestamp" FROM events)"""

ON_ACTIVE = f'"cross" IN {ACTIVE}'
DATED = "date_heure_reception_alerte IS NOT NULL"


def with_(body: str, *parts: str) -> str:
    """Prefix ``body`` with the named relations (all case relations by default)."""
    return "WITH " + ",\n".join(parts or (OPS, RH, ST, BASE)) + "\n" + body


def hu(num: str, den: str, places: int, scale: int = 1) -> str:
    """num*scale/den rounded half away from zero, in integers."""
    n, d = f"({num})::HUGEINT", f"({den})::HUGEINT"
    f = 2 * scale * 10**places
    return (
        f"CASE WHEN {d} <> 0 THEN ((CASE WHEN {n} < 0 THEN -1 ELSE 1 END)"
        f" * ((abs({n}) * {f} + {d}) // (2 * {d})))::DOUBLE / {10**places} END"
    )


def pct(num: str, den: str) -> str:
    return hu(num, den, 2, 100)


def grav(p: str = "") -> str:
    return hu(f"{p}de * 3 + {p}di * 2 + {p}bl", f"{p}pec", 3)


SUMS = (
    "count(*)::BIGINT AS n, "
    + ", ".join(
        f"coalesce(sum({c}), 0)::BIGINT AS {c}"
        for c in ("ss", "pec", "de", "di", "bl", "se", "asi", "re", "ta", "im", "fa")
    )
)
