"""Business tables derived from an order/line-item star schema.

Every business column is a rule over the star tables. ``customer``, ``nation``,
``region`` and ``part`` are joined only when a requested column needs them; no join
is hinted, so Spark broadcasts a side only when its measured size allows it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigie import labels as L
from vigie.functions.outcomes import FOLDED, any_of, quoted
from vigie.sources.dataset import AUDIT, CASES, PERSONS, VESSELS, RescueData

SCHEMAS = {
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
    " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
}
TYPES = {"1": "SAR", "2": "MAS", "3": "SUR", "5": "DIV"}
PHASES = ["Nuit", "Matin", "Apres-midi", "Soir", "Aube"]
COMPASS = L.REFERENCE_LISTS["VENT_DIRECTION_CATEGORIE"]
VESSEL_CLASSES = ["Pêche", "Plaisance", "Commerce", "Loisir nautique", "Autre"]
OUTCOMES = [
    L.RESCUED, L.ASSISTED, L.FOUND, L.MISSING, L.DEAD,
    L.DEAD_ACCIDENT, L.DEAD_NATURAL, L.SELF_RESCUED, L.FALSE_ALARM,
]
CATEGORIES = L.REFERENCE_LISTS["CATEGORIE_PERSONNE"]
AUDIT_ACTIONS = {
    "signup": "INSERT", "view": "UPDATE", "click": "UPDATE",
    "error": "DELETE", "purchase": "ETL_LOAD",
}
AUDITED = ["operations", "flotteurs", "resultats_humain"]


def _pick(index: str, values: list[str]) -> str:
    """The element of a constant list at a zero-based index, NULL outside the list."""
    return f"get(array{any_of(values)}, cast({index} AS int))"


def _unless(condition: str, value: str) -> str:
    return f"CASE WHEN NOT ({condition}) THEN {value} END"


def _recode(column: str, mapping: dict[str, str]) -> str:
    branches = " ".join(f"WHEN {quoted(k)} THEN {quoted(v)}" for k, v in mapping.items())
    return f"CASE {column} {branches} END"


_TIDE = "(o_orderkey % 101 + 20)"
CASE_RULES = {
    "operation_id": "o_orderkey",
    "type_operation": _recode("substring(o_orderpriority, 1, 1)", TYPES),
    "sous_type_operation": "concat('ST', cast(o_orderkey % 4 AS string))",
    "cross": f"CASE WHEN c_nationkey <= 10 THEN {_pick('c_nationkey', L.ACTIVE_CENTRES)}"
    " WHEN c_nationkey <> 24 THEN n_name END",
    "departement": "c_mktsegment",
    "est_metropolitain": "n_regionkey = 3",
    "zone_responsabilite": "o_orderstatus",
    "latitude": _unless("o_orderkey % 50 = 0", "((o_orderkey * 37) % 18000) / 100D - 90D"),
    "longitude": _unless("o_orderkey % 50 = 0", "((o_orderkey * 91) % 36000) / 100D - 180D"),
    "evenement": "concat('EV', cast(o_orderkey % 8 AS string))",
    "categorie_evenement": "concat('CE', cast(o_orderkey % 3 AS string))",
    "vent_direction_categorie": _pick("o_orderkey % 8", COMPASS),
    "vent_force": _unless("o_custkey % 11 = 0", "o_orderkey % 13"),
    "mer_force": _unless("o_custkey % 7 = 0", "o_custkey % 10"),
    "date_heure_reception_alerte": _unless("o_orderkey % 97 = 0", "o_orderdate"),
    "date_heure_fin_operation": _unless(
        "o_orderkey % 13 = 0",
        "o_orderdate + make_dt_interval(0, 0, cast((o_orderkey * 17) % 4320 - 60 AS int), 0)",
    ),
    "est_jour_ferie": "dayofmonth(cast(o_orderdate AS date)) = 1",
    "est_vacances_scolaires": _unless("o_orderkey % 89 = 0", "month(cast(o_orderdate AS date)) IN (7, 8)"),
    "phase_journee": _pick("o_custkey % 6 - 1", PHASES),
    "distance_cote_metres": _unless("o_orderkey % 31 = 0", "(o_orderkey % 50000) / 4D"),
    "distance_cote_milles_nautiques": _unless("o_orderkey % 31 = 0", "(o_orderkey % 27000) / 1000D"),
    "est_dans_stm": "o_orderkey % 9 = 0",
    "est_dans_dst": "o_orderkey % 14 = 0",
    "prefecture_maritime": _unless("r_regionkey = 4", "r_name"),
    "maree_coefficient": _TIDE,
    "maree_categorie": f"CASE WHEN {_TIDE} <= 45 THEN '20-45' WHEN {_TIDE} <= 70 THEN '46-70'"
    f" WHEN {_TIDE} <= 95 THEN '71-95' ELSE '96-120' END",
}
_FROM_CUSTOMER = {"cross", "departement", "est_metropolitain", "prefecture_maritime"}
_FROM_NATION = {"cross", "est_metropolitain", "prefecture_maritime"}
_FROM_REGION = {"prefecture_maritime"}

VESSEL_RULES = {
    "operation_id": "l_orderkey",
    "numero_ordre": "cast(l_linenumber AS bigint)",
    "type_flotteur": f"CASE WHEN p_partkey % 12 < 6 THEN {_pick('p_partkey % 12', L.WATER_SPORTS)}"
    " WHEN p_partkey % 12 < 11 THEN p_type END",
    "categorie_flotteur": _pick("p_size % 6 - 1", VESSEL_CLASSES),
    "pavillon": _recode("l_returnflag", {"R": "Français", "N": "Étranger"}),
    "resultat_flotteur": "CASE WHEN l_linestatus = 'O' THEN 'Remorqué' ELSE 'Assisté' END",
}
_FROM_PART = {"type_flotteur", "categorie_flotteur"}

_PEOPLE = "(cast(floor(l_quantity) AS bigint) % 6)"
PERSON_RULES = {
    "operation_id": "l_orderkey",
    "categorie_personne": _pick("l_partkey % 11 - 1", CATEGORIES),
    "resultat_humain": _pick("l_suppkey % 9", OUTCOMES),
    "nombre": _PEOPLE,
    "dont_nombre_blesse": f"least({_PEOPLE}, cast(l_linenumber % 3 AS bigint))",
}

AUDIT_RULES = {
    "id": "event_id",
    "table_name": _pick("user_id % 3", AUDITED),
    "operation_type": _recode("event_type", AUDIT_ACTIONS),
    "record_id": "user_id",
    "old_values": "cast(NULL AS string)",
    "new_values": "props",
    "changed_fields": "CASE WHEN event_type IN ('view', 'click') THEN array('k') END",
    "user_id": "concat('User_', cast(user_id AS string))",
    "timestamp": "ts",
}


def project(frame: DataFrame, rules: dict[str, str], columns: tuple[str, ...]) -> DataFrame:
    return frame.selectExpr(*[f"{rules[c]} AS `{c}`" for c in (columns or tuple(rules))])


def person_projection(lines: DataFrame, *columns: str) -> DataFrame:
    """Person rows of any batch or stream of line items."""
    return project(lines, PERSON_RULES, columns)


def audit_projection(events: DataFrame, *columns: str) -> DataFrame:
    """Audit rows of any batch or stream of events."""
    return project(events, AUDIT_RULES, columns)


class StarData(RescueData):
    def __init__(self, spark: SparkSession, root: str, spelling: str = FOLDED):
        super().__init__(spark, spelling)
        self.root = root
        self._tables: dict[str, DataFrame] = {}

    def star(self, name: str) -> DataFrame:
        """A star table under its known schema; no footer is read to plan a report."""
        if name not in self._tables:
            reader = self.spark.read.schema(SCHEMAS[name])
            self._tables[name] = reader.parquet(f"{self.root}/{name}.parquet")
        return self._tables[name]

    def widen_orders(self, orders: DataFrame, columns: set[str]) -> DataFrame:
        """Add the dimension columns that ``columns`` need to a frame of orders."""
        if not columns & _FROM_CUSTOMER:
            return orders
        dim = self.star("customer")
        if columns & _FROM_NATION:
            nation = self.star("nation")
            if columns & _FROM_REGION:
                region = self.star("region")
                nation = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            dim = dim.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        return orders.join(dim, F.col("o_custkey") == F.col("c_custkey"), "left")

    def case_projection(self, orders: DataFrame, *columns: str) -> DataFrame:
        wanted = columns or tuple(CASE_RULES)
        return project(self.widen_orders(orders, set(wanted)), CASE_RULES, wanted)

    def table(self, name: str, *columns: str) -> DataFrame:
        if name == CASES:
            return self.case_projection(self.star("orders"), *columns)
        if name == VESSELS:
            wanted = columns or tuple(VESSEL_RULES)
            lines = self.star("lineitem")
            if set(wanted) & _FROM_PART:
                part = self.star("part")
                lines = lines.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
            return project(lines, VESSEL_RULES, wanted)
        if name == PERSONS:
            return person_projection(self.star("lineitem"), *columns)
        if name == AUDIT:
            return audit_projection(self.star("events"), *columns)
        raise KeyError(name)
