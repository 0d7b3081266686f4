import json
from datetime import datetime

from conftest import rows
from vigie.operators import changes as C
from vigie.plans import frames as P
from vigie.plans import reports as R

SCHEMA = "operation_id long, cross string, vent_force long, updated_at timestamp_ntz"
T0, T1 = datetime(2020, 1, 1), datetime(2021, 1, 1)


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "Corse", 3, T0), (2, "Corse", 3, T0), (3, "Corse", None, T0), (4, None, 1, T0), (6, "Étel", 2, T0)], SCHEMA)
    new = spark.createDataFrame([(1, "Corse", 3, T1), (2, "Corsen", 4, T0), (3, "Corse", 5, T0), (5, None, None, T0), (6, None, 2, T0)], SCHEMA)
    got = {r["record_id"]: r for r in rows(C.snapshot_diff(old, new, "operation_id"))}
    assert set(got) == {2, 3, 4, 5, 6}  # 1 changed only its bookkeeping time
    assert got[2]["changed_fields"] == ["cross", "vent_force"]
    assert json.loads(got[2]["new_values"]) == {"cross": {"old": "Corse", "new": "Corsen"}, "vent_force": {"old": "3", "new": "4"}}
    assert json.loads(got[3]["new_values"]) == {"vent_force": {"old": None, "new": "5"}}
    assert json.loads(got[6]["new_values"]) == {"cross": {"old": "Étel", "new": None}}
    assert (got[4]["operation_type"], got[4]["old_values"], got[4]["new_values"]) == ("DELETE", '{"pk":4}', None)
    assert (got[5]["operation_type"], got[5]["new_values"], got[5]["changed_fields"]) == ("INSERT", '{"pk":5}', None)


def test_bulk_load_leaves_one_row_a_table(spark):
    old = spark.createDataFrame([(1, "Corse", 3, T0)], SCHEMA)
    new = spark.createDataFrame([(1, "Étel", 3, T0), (2, "Étel", 3, T0)], SCHEMA)
    tables = ({"operations": old}, {"operations": new}, {"operations": "operation_id"})
    assert C.change_log(*tables).count() == 2
    assert [json.loads(r["new_values"]) for r in rows(C.change_log(*tables, bulk_load=True))] == [{"rows_loaded": 2, "type": "full_refresh"}]


def test_upsert(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    delta = spark.createDataFrame([(2, "B", "write"), (3, None, "delete"), (4, "d", "write")], "id long, v string, op string")
    assert sorted((r["id"], r["v"]) for r in rows(C.upsert(base, delta, "id"))) == [(1, "a"), (2, "B"), (4, "d")]


def test_cascade_and_orphans(make_data, spark):
    data = make_data([{"operation_id": i} for i in (1, 2)], [{"operation_id": i} for i in (1, 2, 2, 3)], [{"operation_id": 2}])
    tables = {"operations": data.cases(), "resultats_humain": data.persons(), "flotteurs": data.vessels()}
    left = C.delete_cases(tables, data.cases().where("operation_id = 2"))
    assert {r["table_name"]: r["lignes"] for r in rows(C.table_counts(left))} == {"operations": 1, "resultats_humain": 2, "flotteurs": 0}
    assert [r["operation_id"] for r in rows(C.orphans(data.persons(), data.cases()))] == [3]


LOG = "id long, table_name string, operation_type string, record_id long, old_values string, new_values string, changed_fields array<string>, user_id string, timestamp timestamp_ntz"


def entry(i, when, kind="INSERT", **more):
    return (i, "operations", kind, i, more.get("old"), more.get("new"), more.get("fields"), "u", when)


def test_retention(spark):
    log = spark.createDataFrame([entry(1, datetime(2020, 1, 1)), entry(2, datetime(2020, 3, 1)), entry(3, None)], LOG)
    kept = rows(C.retain(log, 30, "2020-03-15 00:00:00"))
    assert sorted(r["id"] or 0 for r in kept) == [0, 2, 3]
    note = next(r for r in kept if r["id"] is None)
    assert json.loads(note["new_values"]) == {"action": "cleanup", "deleted_rows": 1, "retention_days": 30}
    assert C.retain(log, 900, "2020-03-15 00:00:00").count() == 3  # nothing removed, nothing noted


def test_audit_changes_and_list(spark):
    log = spark.createDataFrame([
        entry(1, T0, "UPDATE", old='{"cross": "Corse"}', new='{"cross": "Étel", "vent_force": 3}', fields=["cross", "vent_force"]),
        entry(2, T0, "UPDATE", fields=[]), entry(3, T0),
    ], LOG)
    got = sorted((r["champ"], r["avant"], r["apres"]) for r in rows(P.audit_changes(log)))
    assert got == [("cross", "Corse", "Étel"), ("vent_force", "-", "3")]


def test_children_are_rows(make_data):
    data = make_data([{"operation_id": 1}, {"operation_id": 2}],
                     [{"operation_id": 1, "nombre": n, "resultat_humain": "Personne secourue"} for n in (1, 2)],
                     [{"operation_id": 1, "numero_ordre": 1}, {"operation_id": 9}])
    got = sorted((r["operation_id"], r["relation"] or "") for r in rows(R.cases_with_children(data)))
    assert got == [(1, "flotteur"), (1, "resultat"), (1, "resultat"), (2, "")]


def test_nested_rows_become_parent_and_child_tables(spark):
    nested = spark.createDataFrame([(1, "Corse", [(2,), (3,)]), (2, None, [])], "operation_id long, cross string, resultats array<struct<nombre:long>>")
    tables = C.split_nested(nested, {"resultats_humain": "resultats"})
    assert tables["operations"].columns == ["operation_id", "cross"] and tables["operations"].count() == 2
    assert sorted((r["operation_id"], r["nombre"]) for r in rows(tables["resultats_humain"])) == [(1, 2), (1, 3)]


def test_sample_is_repeatable_and_sized(spark):
    cases = spark.range(1000).withColumnRenamed("id", "operation_id")
    one = {r[0] for r in C.sample_cases(cases, 50).collect()}
    assert len(one) == 50 and one == {r[0] for r in C.sample_cases(cases.repartition(7), 50).collect()}
    assert one != {r[0] for r in C.sample_cases(cases, 50, seed=1).collect()}
    assert C.sample_cases(cases, 5000).count() == 1000
