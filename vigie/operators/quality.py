"""Declared data-quality rules run as one projection.

A rule set turns column declarations into named boolean SQL expressions that are true
for a *bad* value. All rules of a table are evaluated in one pass over its rows; the
failures of a row are an array of (column, check, value) structs, so valid rows,
rejected rows and failure cases are three views of one flagged frame. Uniqueness needs
the other rows: duplicated keys are found by a grouped count and joined back, so one
key held by a third of the rows never gathers in a single task.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie import labels as L
from vigie.functions.outcomes import any_of, quoted
from vigie.operators.rollup import grouped

# Type names of the declarations
SPARK_TYPES = {
    "int": "bigint", "str": "string", "float": "double", "float64": "double",
    "bool": "boolean", "datetime": "timestamp_ntz",
}
FAILURES = "failures"
_PLAIN_CHECK = re.compile(r"[\dx\s.()<>=&|+-]*")


class QualityError(ValueError):
    """Raised by the fail-fast mode."""


@dataclass(frozen=True)
class Rule:
    """``bad`` is true for a row that breaks the rule; NULL counts as a pass."""

    column: str
    check: str
    bad: str
    blocking: bool = True


@dataclass
class RuleSet:
    columns: dict[str, str]
    rules: list[Rule] = field(default_factory=list)
    unique: list[str] = field(default_factory=list)
    strict: bool = False


def ident(name: str) -> str:
    return f"`{name}`"


def whole_number(column: str, kind: str = "string") -> str:
    """Text or number as an integer, ``12.0`` included; anything else, fractions included, is missing.

    ``kind`` is the stored type of a number that need not be read as text. A text with a point is never
    read as an integer first: each failure to do so costs more than all other work on the row.
    """
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return f"cast({ident(column)} AS bigint)"
    number, text = f"try_cast({ident(column)} AS double)", f"cast({ident(column)} AS string)"
    whole = f"CASE WHEN {number} % 1 = 0 THEN try_cast({number} AS bigint) END"
    if kind in ("float", "double"):
        return whole
    return f"coalesce(CASE WHEN NOT contains({text}, '.') THEN try_cast({text} AS bigint) END, {whole})"


def typed(column: str, kind: str) -> str:
    target = SPARK_TYPES[kind]
    if target == "bigint":
        return whole_number(column)
    return ident(column) if target == "string" else f"try_cast({ident(column)} AS {target})"


def type_rule(column: str, kind: str) -> Rule:
    """A stored value that does not read as the declared type."""
    return Rule(column, f"type({kind})", f"{ident(column)} IS NOT NULL AND {typed(column, kind)} IS NULL")


def not_null_rule(column: str) -> Rule:
    return Rule(column, "not_null", f"{ident(column)} IS NULL")


def required_rule(column: str) -> Rule:
    """Neither missing nor blank."""
    return Rule(column, "required", f"{ident(column)} IS NULL OR trim(cast({ident(column)} AS string)) = ''")


def literal(value) -> str:
    return quoted(value) if isinstance(value, str) else repr(value)


def compare_rule(column: str, kind: str, check: str, operator: str, value) -> Rule:
    return Rule(column, f"{check}({value})", f"NOT ({typed(column, kind)} {operator} {literal(value)})")


def isin_rule(column: str, kind: str, values: list, blocking: bool = True, ignore_blank: bool = False) -> Rule:
    listed = ", ".join(map(literal, values))
    bad = f"{typed(column, kind)} NOT IN ({listed})"
    if ignore_blank:
        bad = f"{ident(column)} <> '' AND {bad}"
    return Rule(column, "isin", bad, blocking)


def length_rule(column: str, most: int) -> Rule:
    return Rule(column, f"max_length({most})", f"length({ident(column)}) > {most}")


def expression_rule(column: str, kind: str, text: str) -> Rule:
    """A range written over ``x``, such as ``(0 <= x) & (x <= 120)``.

    Only numbers, ``x``, comparisons, ``&`` and ``|`` are let through; Spark reads the rest.
    """
    if not _PLAIN_CHECK.fullmatch(text):
        raise ValueError(f"unsupported check: {text!r}")
    sql = text.replace("&", " AND ").replace("|", " OR ")
    return Rule(column, text, f"NOT ({re.sub(r'\bx\b', typed(column, kind), sql)})")


def rules_from_config(config: dict, strict: bool = False, top_level_isin: bool = False) -> RuleSet:
    """Rule set from column declarations: type, nullable, unique, checks, check.

    A list written as ``isin`` beside ``checks`` is inert unless ``top_level_isin``.
    """
    found = RuleSet({c: p["type"] for c, p in config.items()}, strict=strict)
    for column, props in config.items():
        kind = props["type"]
        if kind not in SPARK_TYPES:
            raise KeyError(kind)
        if kind != "str":
            found.rules.append(type_rule(column, kind))
        if not props.get("nullable", True):
            found.rules.append(not_null_rule(column))
        if props.get("unique", False):
            found.unique.append(column)
        for check in props.get("checks", []):
            if "greater_than" in check:
                found.rules.append(compare_rule(column, kind, "greater_than", ">", check["greater_than"]))
            elif "less_than" in check:
                found.rules.append(compare_rule(column, kind, "less_than", "<", check["less_than"]))
            elif "isin" in check:
                found.rules.append(isin_rule(column, kind, check["isin"]))
        if "check" in props:
            found.rules.append(expression_rule(column, kind, props["check"]))
        if top_level_isin and "isin" in props:
            found.rules.append(isin_rule(column, kind, props["isin"]))
    return found


def unexpected_columns(df: DataFrame, rules: RuleSet) -> list[str]:
    return [c for c in df.columns if c not in rules.columns]


def missing_columns(df: DataFrame, rules: RuleSet) -> list[str]:
    return [c for c in rules.columns if c not in df.columns]


def header_failures(headers: DataFrame, rules: RuleSet) -> DataFrame:
    """``source_file, column, check, value`` of the columns that a file's header has wrong.

    ``renamed_column`` is a declared column that is missing while an unexpected one stands at its
    place (``value``: that name); the others are ``missing_column``, ``unexpected_column`` (``value``:
    its place, from 1; only in strict rule sets) and ``duplicate_column`` (``value``: how often).
    """
    declared = f"array({', '.join(map(quoted, rules.columns))})" if rules.columns else "cast(array() AS array<string>)"
    found = headers.selectExpr(
        "*", f"{declared} AS declared", "array_distinct(header) AS names").selectExpr(
        "*", "array_except(declared, names) AS missing", "array_except(names, declared) AS odd").selectExpr(
        "*", "filter(transform(missing, c -> struct(c AS column, 'renamed_column' AS check,"
        " get(header, cast(array_position(declared, c) - 1 AS int)) AS value)), r -> array_contains(odd, r.value)) AS renamed")
    strict = "transform(filter(odd, c -> NOT exists(renamed, r -> r.value = c)), c -> struct(c AS column, 'unexpected_column' AS check, cast(array_position(header, c) AS string) AS value))"
    parts = [
        "renamed",
        "transform(filter(missing, c -> NOT exists(renamed, r -> r.column = c)), c -> struct(c AS column, 'missing_column' AS check, cast(NULL AS string) AS value))",
        "transform(filter(names, c -> size(filter(header, h -> h = c)) > 1),"
        " c -> struct(c AS column, 'duplicate_column' AS check, cast(size(filter(header, h -> h = c)) AS string) AS value))",
        *([strict] if rules.strict else []),
    ]
    return found.selectExpr("source_file", f"inline(concat({', '.join(parts)}))")


def duplicated(df: DataFrame, columns: list[str]) -> DataFrame:
    """Key values that occur more than once, a repeated missing value included."""
    return grouped(df.select(*columns), columns, "count(1) AS copies").where("copies > 1").drop("copies")


def _mark_duplicates(df: DataFrame, column: str, flag: str, repeated: DataFrame | None = None) -> DataFrame:
    keys = (duplicated(df, [column]) if repeated is None else repeated).withColumnRenamed(column, "dup_key").withColumn(flag, F.lit(True))
    return df.join(keys, F.col(column).eqNullSafe(F.col("dup_key")), "left").drop("dup_key")


def flag(df: DataFrame, rules: RuleSet, blocking: bool = True, repeated: dict[str, DataFrame] | None = None) -> DataFrame:
    """``df`` with an array column of its failures, empty for a good row.

    The array is only built for a row that breaks some rule, as Spark interprets the expression that
    drops its gaps. ``repeated`` has, by unique column, its :func:`duplicated` values if they are stored.
    """
    struct = "CASE WHEN {bad} THEN struct({column} AS column, {check} AS check, cast({value} AS string) AS value) END"
    parts = [
        struct.format(bad=r.bad, column=quoted(r.column), check=quoted(r.check), value=ident(r.column) if r.column in df.columns else "NULL")
        for r in rules.rules
        if r.blocking == blocking
    ]
    marked, flags, bad = df, [], [r.bad for r in rules.rules if r.blocking == blocking]
    if blocking:
        for i, column in enumerate(rules.unique):
            flags.append(f"dup_{i}")
            marked = _mark_duplicates(marked, column, flags[-1], (repeated or {}).get(column))
            bad.append(flags[-1])
            parts.append(struct.format(bad=flags[-1], column=quoted(column), check="'unique'", value=ident(column)))
    empty = "cast(array() AS array<struct<column:string,check:string,value:string>>)"
    broken = " OR ".join(f"({b})" for b in bad)
    found = f"CASE WHEN {broken} THEN array_compact(array({', '.join(parts)})) ELSE {empty} END" if parts else empty
    return marked.withColumn(FAILURES, F.expr(found)).drop(*flags)


def valid_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size(FAILURES) == 0).drop(FAILURES)


def rejected_rows(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size(FAILURES) > 0).drop(FAILURES)


def failure_cases(flagged: DataFrame, *keys: str) -> DataFrame:
    """One row per failed check: the row's key columns, the column, the check, the value."""
    return flagged.select(*keys, F.explode(FAILURES).alias("f")).select(*keys, "f.column", "f.check", "f.value")


def failure_summary(flagged: DataFrame) -> DataFrame:
    return grouped(failure_cases(flagged), ["column", "check"], "cast(count(1) AS bigint) AS failures")


def require_valid(df: DataFrame, rules: RuleSet) -> DataFrame:
    """Fail-fast mode: the first failure found stops the run."""
    if rules.strict and unexpected_columns(df, rules):
        raise QualityError(f"unexpected columns: {unexpected_columns(df, rules)}")
    first = failure_cases(flag(df, rules)).limit(1).collect()  # at most one row
    if first:
        raise QualityError(f"{first[0]['column']}: {first[0]['check']} failed for {first[0]['value']!r}")
    return df


def unknown_values(df: DataFrame, column: str, known: list[str]) -> DataFrame:
    """Values outside a reference list with their number of rows; missing and blank ones pass."""
    odd = df.where(f"{ident(column)} <> '' AND {ident(column)} NOT IN {any_of(known)}")
    return grouped(odd, {"valeur": ident(column)}, "cast(count(1) AS bigint) AS lignes").withColumn(
        "colonne", F.lit(column)
    )


def quality_report(df: DataFrame, rules: RuleSet, known: dict[str, list[str]]) -> DataFrame:
    """Failures per column and check plus, as warnings, values outside reference lists."""
    errors = failure_summary(flag(df, rules)).selectExpr(
        "'error' AS niveau", "column AS colonne", "check AS controle", "cast(NULL AS string) AS valeur", "failures AS lignes"
    )
    warnings = [
        unknown_values(df, column, values).selectExpr(
            "'warning' AS niveau", "colonne", "'isin' AS controle", "valeur", "lignes"
        )
        for column, values in known.items()
    ]
    return reduce(DataFrame.unionByName, warnings, errors)


# --- rules across columns ---------------------------------------------------
def coordinates_pair() -> Rule:
    return Rule("latitude", "coordinates_pair", "(latitude IS NULL) <> (longitude IS NULL)")


def coordinates_zone() -> Rule:
    """A full position outside every French zone: a warning."""
    lat, lon = typed("latitude", "float"), typed("longitude", "float")
    inside = " OR ".join(
        f"({lat} BETWEEN {a} AND {b} AND {lon} BETWEEN {c} AND {d})" for a, b, c, d in L.FRENCH_ZONES.values()
    )
    return Rule("latitude", "coordinates_zone", f"{lat} IS NOT NULL AND {lon} IS NOT NULL AND NOT ({inside})", blocking=False)


def outcome_needs_people() -> Rule:
    return Rule("nombre", "outcome_count", "resultat_humain <> '' AND NOT (coalesce(try_cast(nombre AS bigint), 0) >= 1)")


def length_fits_type() -> Rule:
    limits = ", ".join(f"{quoted(k)}, {v}D" for k, v in L.MAX_LENGTH_BY_TYPE.items())
    return Rule("longueur", "length_by_type", f"try_cast(longueur AS double) > try_element_at(map({limits}), type_flotteur)")


def beaufort(column: str = "vent_force") -> Rule:
    return Rule(column, "beaufort", f"NOT ({typed(column, 'float')} BETWEEN 0 AND 12)")


def douglas(column: str = "mer_force") -> Rule:
    return Rule(column, "douglas", f"NOT ({typed(column, 'float')} BETWEEN 0 AND 9)")


def department_format(column: str = "departement") -> Rule:
    return Rule(column, "departement_format", f"length({ident(column)}) > 3")
