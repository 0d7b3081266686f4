"""Figures that follow changes, deltas beside stored tables, months in any order of arrival."""

from datetime import datetime

import pytest

from conftest import PERSON_COLUMNS, frame, rows
from vigie.plans import incremental, views
from vigie.session import work_folder
from vigie.sources import deltas, versions
from vigie.sources.dataset import FolderData
from vigie.streaming import jobs

RESCUED = "Personne secourue"


def case(i, month=1, minutes=60, centre="Corse", day=3):
    start = datetime(2023, month, day, 10)
    return {"operation_id": i, "cross": centre, "date_heure_reception_alerte": start,
            "date_heure_fin_operation": datetime(2023, month, day, 10 + minutes // 60, minutes % 60)}


def person(i, n, outcome=RESCUED):
    return {"operation_id": i, "resultat_humain": outcome, "nombre": n, "dont_nombre_blesse": 0}


def same(a, b):
    return sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(b.columns)).collect()))


# --- incremental refresh ----------------------------------------------------
def test_one_changed_case_rewrites_only_its_groups(spark, make_data):
    root = work_folder(spark, "test")
    cases = [case(i, 1 + i % 12, 30 + i) for i in range(60)]
    people = [person(i, i % 4) for i in range(60) for _ in range(2)]
    old = make_data(cases, people)
    first = incremental.store(old, root)
    moved = [case(7, 2, 200, "Corsen") if c["operation_id"] == 7 else c for c in cases]
    new = make_data(moved, people)
    ids = spark.createDataFrame([(7,), (8,), (7,)], "operation_id long")  # 8 did not change
    version, written = incremental.apply_changes(old, new, ids, root)
    assert len(written["mois"]) <= 2 and written["annees"] == [] and len(written["centres"]) <= 2 and len(written["durees"]) <= 2
    untouched = {n for n in first.places if int(n.split("/")[1]) not in written[n.split("/")[0]]}
    assert untouched and all(version.places[n] == first.places[n] for n in untouched)
    assert same(incremental.monthly_safety(spark, root), views.monthly_safety(new))
    full = work_folder(spark, "test")
    incremental.store(new, full)
    for name in incremental.FIGURES:
        assert same(incremental.read(spark, root, name), incremental.read(spark, full, name)), name
        assert same(incremental.read(spark, root, name, first.number), incremental.read(spark, root, name, 1))
    assert same(incremental.centre_durations(spark, root), views.centre_benchmark(new).select(
        "cross_name", "duree_moyenne_heures", "duree_mediane_heures", "duree_min_heures", "duree_max_heures"))
    again, written = incremental.apply_changes(new, new, ids, root)
    assert again == version and not any(written.values())


def test_groups_come_and_go(spark, make_data):
    root = work_folder(spark, "test")
    one, two = make_data([case(1, 1)], [person(1, 2)]), make_data([case(2, 5)], [person(2, 3)])
    none = make_data([])
    incremental.store(one, root)
    ids = spark.createDataFrame([(1,), (2,)], "operation_id long")
    incremental.apply_changes(one, two, ids, root)
    assert [(r["mois"], r["n"], r["sec"]) for r in rows(incremental.read(spark, root, "mois"))] == [(5, 1, 3)]
    incremental.apply_changes(two, none, ids, root)
    with pytest.raises(ValueError, match="mois"):
        incremental.read(spark, root, "mois")
    incremental.apply_changes(none, one, ids, root)
    assert [(r["mois"], r["sec"]) for r in rows(incremental.read(spark, root, "mois"))] == [(1, 2)]


# --- deltas -----------------------------------------------------------------
def test_deltas_merge_in_their_order(spark):
    root = work_folder(spark, "test")
    cases = spark.createDataFrame([(i, f"v{i}") for i in range(1, 6)], "operation_id long, cross string")
    boats = spark.createDataFrame([(10 * i + k, i) for i in range(1, 6) for k in (0, 1)], "flotteur_id long, operation_id long")
    versions.replace({"operations": cases, "flotteurs": boats}, root)
    reader = FolderData(spark, root)
    assert reader.cases().count() == 5

    def change(**tables):
        deltas.upsert({n: spark.createDataFrame(v, s) for n, (v, s) in tables.items()}, root)

    ops, boat = "operation_id long, cross string, op string", "flotteur_id long, operation_id long, op string"
    change(operations=([(2, "new", "write"), (3, None, "delete"), (9, "nine", "write")], ops), flotteurs=([(90, 9, "write"), (10, None, "delete")], boat))
    change(operations=([(2, "newer", "write"), (3, "back", "write")], ops))
    deltas.delete_cases(spark.createDataFrame([(1,), (9,), (None,)], "operation_id long"), root)
    change(operations=([(9, "again", "write")], ops))

    def now():
        data = FolderData(spark, root)
        return ({r["operation_id"]: r["cross"] for r in rows(data.cases())}, sorted(r["flotteur_id"] for r in rows(data.vessels())))

    want = ({2: "newer", 3: "back", 4: "v4", 5: "v5", 9: "again"}, [20, 21, 30, 31, 40, 41, 50, 51])
    assert now() == want and reader.cases().count() == 5
    base = versions.current(spark, root).places["flotteurs"]
    deltas.compact(spark, root, "operations")
    found = versions.current(spark, root).places
    assert now() == want and found["flotteurs"] == base and not [n for n in found if n.startswith("operations/")]
    with pytest.raises(ValueError, match="twice"):
        change(operations=([(4, "a", "write"), (4, "b", "write")], ops))
    assert now() == want
    versions.replace({"operations": cases, "flotteurs": boats}, root)
    assert now()[0] == {i: f"v{i}" for i in range(1, 6)} and len(now()[1]) == 10


# --- months in any order ----------------------------------------------------
STREAMED = "operation_id long, date_heure_reception_alerte timestamp_ntz, version long"
SIGNED = f"{PERSON_COLUMNS}, sens int"


def monthly(spark, batches):
    """Run batches of (cases, people) through the stream one by one; months with their cases and rescued."""
    root = work_folder(spark, "test")
    for cases, people in batches:
        frame(spark, STREAMED, cases).coalesce(1).write.mode("append").parquet(f"{root}/cases")
        frame(spark, SIGNED, people).coalesce(1).write.mode("append").parquet(f"{root}/people")
        jobs.run_monthly(
            jobs.file_stream(spark, f"{root}/cases"), jobs.file_stream(spark, f"{root}/people"), f"{root}/out", f"{root}/mark",
            "folded", "version", "coalesce(sens, 1)").awaitTermination()
    return {r["mois"]: (r["n"], r["sec"], r["imp"]) for r in rows(jobs.read_monthly(spark, f"{root}/out"))}, root


def dated(i, month, version=0):
    return {"operation_id": i, "date_heure_reception_alerte": month and datetime(2023, month, 5), "version": version}


def test_people_before_with_and_after_their_case_count_alike(spark):
    cases, people = [dated(1, 1), dated(2, 2), dated(3, None)], [person(1, 2), person(1, 3), person(2, 1, "autre"), person(3, 9), person(4, 9)]
    want = {1: (1, 5, 5), 2: (1, 0, 1)}
    orders = [[(cases, people)], [(cases, []), ([], people)], [([], people), (cases, [])], [([], people[:1]), (cases[:1], people[2:]), (cases[1:], people[1:2])]]
    for order in orders:
        assert monthly(spark, order)[0] == want


def test_a_case_delivered_again_moves_with_its_people(spark):
    got, root = monthly(spark, [
        ([dated(1, 1, 1), dated(2, 1, 1)], [person(1, 2), person(2, 4)]),
        ([dated(1, 3, 2)], [person(1, 1)]),
        ([dated(1, 7, 1)], [{**person(2, 4), "sens": -1}]),  # an old delivery that comes late; people taken back
        ([dated(2, None, 5)], []),
    ])
    assert got == {3: (1, 3, 3)}
    jobs.compact_monthly(spark, f"{root}/out", f"{root}/compacted")
    assert [(r["mois"], r["n"]) for r in rows(jobs.read_monthly(spark, f"{root}/compacted"))] == [(3, 1)]


def test_cases_are_followed_in_blocks_of_neighbours(spark):
    root = work_folder(spark, "test")
    ids = range(-300, 300)
    frame(spark, STREAMED, [dated(i, i % 12 + 1) for i in ids]).coalesce(1).write.parquet(f"{root}/cases")
    frame(spark, SIGNED, [person(i, abs(i)) for i in ids for _ in range(2)]).coalesce(1).write.parquet(f"{root}/people")
    stream = jobs.run_monthly(
        jobs.file_stream(spark, f"{root}/cases"), jobs.file_stream(spark, f"{root}/people"), f"{root}/out", f"{root}/mark", "folded", "version")
    stream.awaitTermination()
    got = {r["mois"]: (r["n"], r["imp"]) for r in rows(jobs.read_monthly(spark, f"{root}/out"))}
    assert got == {m + 1: (50, sum(2 * abs(i) for i in ids if i % 12 == m)) for m in range(12)}
    assert stream.lastProgress["stateOperators"][0]["numRowsTotal"] == 4  # not one state for each of 600 cases
