"""Field metadata of the three entities, and the rule sets and listings made from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie import labels as L
from vigie.functions.outcomes import quoted
from vigie.operators import quality as Q
from vigie.operators.rollup import grouped


@dataclass(frozen=True)
class Field:
    name: str
    label: str
    kind: str
    required: bool = False
    low: float | None = None
    high: float | None = None
    max_chars: int | None = None
    reference: str | None = None
    list_place: int | None = None


@dataclass(frozen=True)
class Entity:
    name: str
    key: str
    fields: tuple[Field, ...]

    def get(self, name: str) -> Field | None:
        return next((f for f in self.fields if f.name == name), None)

    def listed(self) -> list[Field]:
        return sorted((f for f in self.fields if f.list_place is not None), key=lambda f: f.list_place)


# ---------------------------------------------------------------------------
# The fields of the entities in file order
# ---------------------------------------------------------------------------
_CASE_FIELDS = (
    Field("operation_id", "ID Operation", "int", required=True, low=1.0, list_place=1),
    Field("numero_sitrep", "Numero SITREP", "str", max_chars=50),
    Field("cross_sitrep", "CROSS SITREP", "str", max_chars=100),
    Field("type_operation", "Type d'operation", "str", reference="TYPE_OPERATION", list_place=3),
    Field("sous_type_operation", "Sous-type", "str", max_chars=100),
    Field("cross", "CROSS", "str", reference="CROSS_VALUES", list_place=4),
    Field("pourquoi_alerte", "Pourquoi alerte", "str", max_chars=100),
    Field("moyen_alerte", "Moyen d'alerte", "str", max_chars=100),
    Field("qui_alerte", "Qui alerte", "str", max_chars=100),
    Field("categorie_qui_alerte", "Categorie alertant", "str", max_chars=100),
    Field("departement", "Departement", "str", max_chars=3, list_place=5),
    Field("zone_responsabilite", "Zone de responsabilite", "str", max_chars=50),
    Field("latitude", "Latitude", "float", low=-90.0, high=90.0),
    Field("longitude", "Longitude", "float", low=-180.0, high=180.0),
    Field("est_metropolitain", "Metropolitain", "bool"),
    Field("evenement", "Evenement", "str", max_chars=100),
    Field("categorie_evenement", "Categorie evenement", "str", max_chars=100),
    Field("autorite", "Autorite", "str", max_chars=100),
    Field("seconde_autorite", "Seconde autorite", "str", max_chars=100),
    Field("vent_direction", "Direction vent", "int", low=0.0, high=360.0),
    Field("vent_force", "Force vent", "int", low=0.0, high=12.0),
    Field("mer_force", "Etat de mer", "int", low=0.0, high=9.0),
    Field("vent_direction_categorie", "Direction vent (categorie)", "str", reference="VENT_DIRECTION_CATEGORIE"),
    Field("date_heure_reception_alerte", "Reception alerte", "datetime", list_place=2),
    Field("date_heure_fin_operation", "Fin operation", "datetime"),
    Field("fuseau_horaire", "Fuseau horaire", "str", max_chars=50),
    Field("systeme_source", "Systeme source", "str", max_chars=50),
    Field("prefecture_maritime", "Prefecture maritime", "str", reference="PREFECTURE_MARITIME"),
    Field("phase_journee", "Phase de journee", "str", reference="PHASE_JOURNEE"),
    Field("distance_cote_metres", "Distance cote (m)", "float", low=0.0),
    Field("distance_cote_milles_nautiques", "Distance cote (NM)", "float", low=0.0),
    Field("est_jour_ferie", "Jour ferie", "bool"),
    Field("est_vacances_scolaires", "Vacances scolaires", "bool"),
    Field("concerne_plongee", "Concerne plongee", "bool"),
    Field("implique_wingfoil", "Implique wingfoil", "bool"),
    Field("est_dans_stm", "Dans STM", "bool"),
    Field("nom_stm", "Nom STM", "str", max_chars=100),
    Field("est_dans_dst", "Dans DST", "bool"),
    Field("nom_dst", "Nom DST", "str", max_chars=100),
    Field("maree_port", "Port de reference maree", "str", max_chars=100),
    Field("maree_coefficient", "Coefficient maree", "int", low=20.0, high=120.0),
    Field("maree_categorie", "Categorie maree", "str", reference="MAREE_CATEGORIE"),
)
_PERSON_FIELDS = (
    Field("resultat_id", "ID", "int", list_place=1),
    Field("operation_id", "ID Operation", "int", required=True),
    Field("categorie_personne", "Categorie de personne", "str", reference="CATEGORIE_PERSONNE", list_place=2),
    Field("resultat_humain", "Resultat", "str", reference="RESULTAT_HUMAIN", list_place=3),
    Field("nombre", "Nombre", "int", required=True, low=0.0, list_place=4),
    Field("dont_nombre_blesse", "Dont blesses", "int", low=0.0, list_place=5),
)
_VESSEL_FIELDS = (
    Field("flotteur_id", "ID", "int", list_place=1),
    Field("operation_id", "ID Operation", "int", required=True),
    Field("numero_ordre", "Ordre", "int", low=1.0, list_place=2),
    Field("type_flotteur", "Type de flotteur", "str", reference="TYPE_FLOTTEUR", list_place=3),
    Field("categorie_flotteur", "Categorie", "str", max_chars=100, list_place=4),
    Field("pavillon", "Pavillon", "str", max_chars=50, list_place=5),
    Field("numero_immatriculation", "Immatriculation", "str", max_chars=50),
    Field("resultat_flotteur", "Resultat", "str", reference="RESULTAT_FLOTTEUR", list_place=6),
)
# ---------------------------------------------------------------------------

CASE = Entity("operation", "operation_id", _CASE_FIELDS)
VESSEL = Entity("flotteur", "flotteur_id", _VESSEL_FIELDS)
PERSON = Entity("resultat_humain", "resultat_id", _PERSON_FIELDS)


def field_rules(entity: Entity, columns: list[str]) -> Q.RuleSet:
    """Required, minimum, maximum and text-length rules for the columns that are there."""
    found = Q.RuleSet({f.name: f.kind for f in entity.fields})
    for f in entity.fields:
        if f.name not in columns:
            continue
        if f.required:
            found.rules.append(Q.required_rule(f.name))
        if f.low is not None:
            found.rules.append(Q.compare_rule(f.name, f.kind, "min", ">=", f.low))
        if f.high is not None:
            found.rules.append(Q.compare_rule(f.name, f.kind, "max", "<=", f.high))
        if f.max_chars is not None:
            found.rules.append(Q.length_rule(f.name, f.max_chars))
    return found


def reference_lists(entity: Entity, columns: list[str]) -> dict[str, list[str]]:
    return {f.name: L.REFERENCE_LISTS[f.reference] for f in entity.fields if f.reference and f.name in columns}


def _entity_rules(columns: list[str], ids: list[str], ranges: dict[str, tuple], lists: dict[str, str], strict: bool, extra: list[Q.Rule]) -> Q.RuleSet:
    rules = [Q.compare_rule(c, "int", "min", ">=", 1) for c in ids if c in columns]
    for column, (low, high) in ranges.items():
        if column in columns:
            rules.append(Q.compare_rule(column, "float", "min", ">=", low))
            if high is not None:
                rules.append(Q.compare_rule(column, "float", "max", "<=", high))
    for column, name in lists.items():
        if column in columns:
            rules.append(Q.isin_rule(column, "str", L.REFERENCE_LISTS[name], blocking=strict, ignore_blank=not strict))
    return Q.RuleSet({c: "str" for c in columns}, rules + extra)


def case_rules(columns: list[str], strict: bool = False) -> Q.RuleSet:
    """Ranges, reference lists (blocking when ``strict``) and the coordinate pair."""
    ranges = {
        "latitude": (-90, 90), "longitude": (-180, 180), "vent_direction": (0, 360), "vent_force": (0, 12),
        "mer_force": (0, 9), "distance_cote_metres": (0, None), "distance_cote_milles_nautiques": (0, None),
        "maree_coefficient": (20, 120),
    }
    lists = {
        "type_operation": "TYPE_OPERATION", "cross": "CROSS_VALUES", "phase_journee": "PHASE_JOURNEE",
        "prefecture_maritime": "PREFECTURE_MARITIME", "maree_categorie": "MAREE_CATEGORIE",
    }
    pair = [Q.coordinates_pair()] if {"latitude", "longitude"} <= set(columns) else []
    return _entity_rules(columns, ["operation_id"], ranges, lists, strict, pair)


def vessel_rules(columns: list[str], strict: bool = False) -> Q.RuleSet:
    lists = {"type_flotteur": "TYPE_FLOTTEUR", "resultat_flotteur": "RESULTAT_FLOTTEUR"}
    return _entity_rules(columns, ["flotteur_id", "operation_id"], {}, lists, strict, [])


def person_rules(columns: list[str], strict: bool = False) -> Q.RuleSet:
    lists = {"categorie_personne": "CATEGORIE_PERSONNE", "resultat_humain": "RESULTAT_HUMAIN"}
    ranges = {"nombre": (0, None), "dont_nombre_blesse": (0, None)}
    together = [Q.outcome_needs_people()] if {"resultat_humain", "nombre"} <= set(columns) else []
    return _entity_rules(columns, ["resultat_id", "operation_id"], ranges, lists, strict, together)


def data_dictionary(entity: Entity, df: DataFrame, exact: bool = True) -> DataFrame:
    """Fields with their constraints and the measured missing and distinct counts.

    Exact counts come from long (field, value) rows: values are grouped first and counted
    second, so no distinct set is held per task. On very large tables ``exact=False``
    estimates distinct values in a single pass that shuffles only sketches.
    """
    there = [f for f in entity.fields if f.name in df.columns]

    def limits(f: Field) -> str:
        parts = ["Obligatoire"] if f.required else []
        parts += [f"Min: {f.low:g}"] if f.low is not None else []
        parts += [f"Max: {f.high:g}"] if f.high is not None else []
        parts += [f"Max {f.max_chars} car."] if f.max_chars is not None else []
        return ", ".join(parts) or "-"

    def preview(f: Field) -> str:
        values = L.REFERENCE_LISTS.get(f.reference or "", [])
        return (", ".join(values[:3]) + ("..." if len(values) > 3 else "")) or "-"

    profile = _exact_profile(df, there) if exact else _quick_profile(df, there)

    def lookup(of) -> str:
        cases = " ".join(f"WHEN {quoted(f.name)} THEN {quoted(of(f))}" for f in there)
        return f"CASE champ {cases} END"

    return profile.selectExpr(
        "champ", f"{lookup(lambda f: f.label)} AS libelle", f"{lookup(lambda f: f.kind)} AS type",
        f"{lookup(limits)} AS contraintes", f"{lookup(preview)} AS valeurs", "lignes", "manquantes", "distinctes",
    )


def _exact_profile(df: DataFrame, fields: list[Field]) -> DataFrame:
    pairs = ", ".join(f"{quoted(f.name)}, cast({Q.ident(f.name)} AS string)" for f in fields)
    long = df.selectExpr(f"stack({len(fields)}, {pairs}) AS (champ, valeur)")
    return grouped(
        grouped(long, ["champ", "valeur"], "count(1) AS k"), ["champ"],
        "cast(sum(k) AS bigint) AS lignes",
        "cast(sum(CASE WHEN valeur IS NULL THEN k ELSE 0 END) AS bigint) AS manquantes",
        "cast(count(valeur) AS bigint) AS distinctes",
    )


def _quick_profile(df: DataFrame, fields: list[Field]) -> DataFrame:
    wide = df.agg(
        F.expr("count(1) AS lignes"),
        *[F.expr(f"count({Q.ident(f.name)})").alias(f"n_{f.name}") for f in fields],
        *[F.expr(f"approx_count_distinct({Q.ident(f.name)})").alias(f"d_{f.name}") for f in fields],
    )
    rows = ", ".join(f"{quoted(f.name)}, lignes - `n_{f.name}`, `d_{f.name}`" for f in fields)
    return wide.selectExpr("lignes", f"stack({len(fields)}, {rows}) AS (champ, manquantes, distinctes)")


def list_projection(entity: Entity, df: DataFrame, with_id: bool = True) -> DataFrame:
    """Listed fields in their order under their labels; '-' for missing, minutes for instants."""
    columns = [f"{Q.ident(entity.key)} AS `ID`"] if with_id and entity.key in df.columns else []
    for f in entity.listed():
        if f.name not in df.columns or (with_id and f.name == entity.key):
            continue
        shown = f"substring(cast({Q.ident(f.name)} AS string), 1, 16)" if f.kind == "datetime" else f"cast({Q.ident(f.name)} AS string)"
        columns.append(f"coalesce({shown}, '-') AS {Q.ident(f.label)}")
    return df.selectExpr(*columns)
