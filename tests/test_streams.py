from datetime import datetime

import pytest

from conftest import PERSON_COLUMNS, frame, rows
from vigie.operators.counters import persons_by_case
from vigie.session import work_folder
from vigie.streaming import jobs


def person(i, n, outcome="Personne secourue"):
    return {"operation_id": i, "resultat_humain": outcome, "nombre": n, "dont_nombre_blesse": 0}


def test_counters_grow_with_new_files_and_survive_a_retry(spark):
    root = work_folder(spark, "test")
    source, out, mark = f"{root}/people", f"{root}/partials", f"{root}/checkpoint"

    def arrive(*people):
        frame(spark, PERSON_COLUMNS, people).coalesce(1).write.mode("append").parquet(source)
        jobs.run_counters(jobs.file_stream(spark, source, 1), out, mark, "folded").awaitTermination()

    arrive(person(1, 2), person(2, 5))
    arrive(person(1, 3), person(3, 1, "Personne décédée"))
    expected = persons_by_case(spark.read.parquet(source), "folded")
    assert sorted(map(str, rows(jobs.read_counters(spark, out)))) == sorted(map(str, rows(expected)))

    # a batch written again replaces itself instead of counting twice
    jobs._write_partial(persons_by_case(frame(spark, PERSON_COLUMNS, [person(1, 2), person(2, 5)]), "folded"), out, 0)
    assert sorted(map(str, rows(jobs.read_counters(spark, out)))) == sorted(map(str, rows(expected)))

    jobs.compact(spark, jobs.read_counters, out, f"{root}/compacted")
    assert sorted(map(str, rows(jobs.read_counters(spark, f"{root}/compacted")))) == sorted(map(str, rows(expected)))


def test_audit_counts_over_several_batches(spark):
    root = work_folder(spark, "test")
    schema = "table_name string, operation_type string, timestamp timestamp_ntz"
    first = [("operations", "INSERT", datetime(2024, 1, 1, h)) for h in (1, 2)]
    second = [("operations", "INSERT", datetime(2024, 1, 1, 23)), ("operations", "DELETE", datetime(2024, 1, 2, 1))]
    for batch in (first, second):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{root}/log")
        log = jobs.file_stream(spark, f"{root}/log")
        jobs.run_audit_counts(log, f"{root}/counts", f"{root}/checkpoint").awaitTermination()
    got = {(str(r["jour"]), r["operation_type"]): r["entrees"] for r in rows(jobs.read_audit_counts(spark, f"{root}/counts"))}
    assert got == {("2024-01-01", "INSERT"): 3, ("2024-01-02", "DELETE"): 1}


def test_audit_days_do_not_depend_on_the_session_zone(spark):
    root = work_folder(spark, "test")
    schema = "table_name string, operation_type string, timestamp timestamp_ntz"
    spark.createDataFrame([("operations", "INSERT", datetime(2024, 1, 1, h, 59)) for h in (0, 23)], schema).write.parquet(f"{root}/log")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Noumea")
        jobs.run_audit_counts(jobs.file_stream(spark, f"{root}/log"), f"{root}/counts", f"{root}/checkpoint").awaitTermination()
        assert [(str(r["jour"]), r["entrees"]) for r in rows(jobs.read_audit_counts(spark, f"{root}/counts"))] == [("2024-01-01", 2)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_old_entries_count_and_a_new_checkpoint_is_refused(spark):
    root = work_folder(spark, "test")
    schema = "table_name string, operation_type string, timestamp timestamp_ntz"
    for turn, day in enumerate((20, 22, 5)):
        spark.createDataFrame([("operations", "INSERT", datetime(2024, 1, day, h)) for h in (1, 2)], schema).write.parquet(f"{root}/log/part{turn}")
        log = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{root}/log")
        jobs.run_audit_counts(log, f"{root}/counts", f"{root}/checkpoint").awaitTermination()
    got = {str(r["jour"]): r["entrees"] for r in rows(jobs.read_audit_counts(spark, f"{root}/counts"))}
    assert got == {"2024-01-20": 2, "2024-01-22": 2, "2024-01-05": 2}
    with pytest.raises(ValueError):
        jobs.run_audit_counts(log, f"{root}/counts", f"{root}/fresh")
