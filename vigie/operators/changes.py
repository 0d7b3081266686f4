"""Snapshot comparison, batch upserts, cascades, retention."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie.functions.outcomes import quoted

IGNORED = ("created_at", "updated_at")


def snapshot_diff(old: DataFrame, new: DataFrame, key: str, table: str = "operations", user: str = "system") -> DataFrame:
    """Audit rows that lead from one snapshot to the next.

    An insert or delete keeps only the key. An update keeps, per field that differs,
    its old and new value as JSON, and the list of those fields. Bookkeeping times do
    not count as change, and unchanged rows give no row.
    """
    fields = [c for c in new.columns if c in old.columns and c != key and c not in IGNORED]
    before = old.select(key, F.struct(*fields).alias("was"))
    after = new.select(key, F.struct(*fields).alias("now"))
    both = before.join(after, key, "full_outer")
    changes = ", ".join(
        f"CASE WHEN NOT (was.`{f}` <=> now.`{f}`) THEN"
        f" struct({quoted(f)} AS field, cast(was.`{f}` AS string) AS old, cast(now.`{f}` AS string) AS new) END"
        for f in sorted(fields)
    )
    marked = both.selectExpr(
        f"`{key}` AS record_id",
        "CASE WHEN was IS NULL THEN 'INSERT' WHEN now IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS operation_type",
        f"CASE WHEN was IS NOT NULL AND now IS NOT NULL THEN array_compact(array({changes})) END AS diff",
    ).where("operation_type <> 'UPDATE' OR size(diff) > 0")
    pk = "to_json(named_struct('pk', record_id))"
    keep_nulls = "map('ignoreNullFields', 'false')"
    fields_json = (
        f"to_json(map_from_entries(transform(diff, d -> struct(d.field, named_struct('old', d.old, 'new', d.new)))), {keep_nulls})"
    )
    return marked.selectExpr(
        f"{quoted(table)} AS table_name", "operation_type", "record_id",
        f"CASE WHEN operation_type = 'DELETE' THEN {pk} END AS old_values",
        f"CASE operation_type WHEN 'INSERT' THEN {pk} WHEN 'UPDATE' THEN {fields_json} END AS new_values",
        "transform(diff, d -> d.field) AS changed_fields",
        f"{quoted(user)} AS user_id",
    )


def change_log(
    old: dict[str, DataFrame], new: dict[str, DataFrame], keys: dict[str, str], bulk_load: bool = False
) -> DataFrame:
    """Audit rows for several tables; a bulk load leaves one summary row a table instead."""
    if bulk_load:
        return load_summary(new)
    return reduce(DataFrame.unionByName, [snapshot_diff(old[t], new[t], keys[t], t) for t in new])


def load_summary(tables: dict[str, DataFrame], user: str = "system") -> DataFrame:
    """One ETL_LOAD row per table with the number of rows loaded."""
    rows = [
        df.agg(F.expr("cast(count(1) AS bigint)").alias("n")).selectExpr(
            f"{quoted(name)} AS table_name", "'ETL_LOAD' AS operation_type", "cast(NULL AS bigint) AS record_id",
            "cast(NULL AS string) AS old_values",
            "to_json(named_struct('rows_loaded', n, 'type', 'full_refresh')) AS new_values",
            "cast(NULL AS array<string>) AS changed_fields", f"{quoted(user)} AS user_id",
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.expr("cast(count(1) AS bigint)").alias("lignes")).select(F.lit(name).alias("table_name"), "lignes")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def upsert(base: DataFrame, delta: DataFrame, key: str, operation: str = "op") -> DataFrame:
    """The next snapshot: rows of ``delta`` replace or join those of ``base``, deletes vanish.

    ``delta`` holds one row per key with an extra column that is ``delete`` for removals.
    """
    kept = base.join(delta.select(key), key, "left_anti")
    written = delta.where(F.col(operation) != "delete").select(*base.columns)
    return kept.unionByName(written)


def delete_cases(tables: dict[str, DataFrame], gone: DataFrame) -> dict[str, DataFrame]:
    """Every table without the given cases; children go with their case."""
    ids = gone.select("operation_id")
    return {name: df.join(ids, "operation_id", "left_anti") for name, df in tables.items()}


def retention_note(removed: DataFrame, days: int, anchor: datetime | str) -> DataFrame:
    """The entry that says how many entries (``n``) a retention removed."""
    return removed.selectExpr(
        "cast(NULL AS bigint) AS id", "'audit_log' AS table_name", "'ETL_LOAD' AS operation_type",
        "cast(NULL AS bigint) AS record_id", "cast(NULL AS string) AS old_values",
        f"to_json(named_struct('action', 'cleanup', 'deleted_rows', n, 'retention_days', {int(days)})) AS new_values",
        "cast(NULL AS array<string>) AS changed_fields", "'system' AS user_id",
        f"cast({quoted(str(anchor))} AS timestamp_ntz) AS `timestamp`",
    )


def retain(log: DataFrame, days: int = 90, anchor: datetime | str = "") -> DataFrame:
    """The log without entries older than ``days`` before ``anchor``, plus one row saying so.

    The summary row is there only when something was removed.
    """
    edge = f"cast({quoted(str(anchor))} AS timestamp_ntz) - make_dt_interval({int(days)})"
    removed = log.where(f"`timestamp` < {edge}").agg(F.expr("cast(count(1) AS bigint)").alias("n")).where("n > 0")
    note = retention_note(removed, days, anchor)
    return log.where(f"coalesce(`timestamp` >= {edge}, true)").unionByName(note.select(*log.columns))


def orphans(children: DataFrame, parents: DataFrame, key: str = "operation_id") -> DataFrame:
    return children.join(parents.select(key), key, "left_anti")


def split_nested(nested: DataFrame, children: dict[str, str], key: str = "operation_id") -> dict[str, DataFrame]:
    """Parent and child tables from nested rows; each child is stamped with its parent's key."""
    tables = {"operations": nested.drop(*children.values())}
    for table, column in children.items():
        tables[table] = nested.select(key, F.explode(column).alias("child")).select(key, "child.*")
    return tables


def sample_cases(cases: DataFrame, size: int, seed: int = 42, key: str = "operation_id") -> DataFrame:
    """A repeatable sample: the cases with the smallest seeded digest."""
    return cases.orderBy(F.expr(f"md5(concat('{int(seed)}:', cast(`{key}` AS string)))"), key).limit(size)


def children_of_sample(children: DataFrame, sample: DataFrame, key: str = "operation_id") -> DataFrame:
    return children.join(sample.select(key), key, "left_semi")
