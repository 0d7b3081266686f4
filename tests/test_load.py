"""Versions of tables, headers by file, rows that follow their case, inferred types."""

import pytest

from checks import q_data
from conftest import rows
from vigie.operators import quality as Q
from vigie.plans import etl, registry
from vigie.session import work_folder
from vigie.sources import files, sinks, versions
from vigie.sources.dataset import FolderData


def table(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "operation_id long")


def ids(df):
    return sorted(r["operation_id"] for r in df.collect())


# --- versions ---------------------------------------------------------------
def test_a_failure_after_the_first_table_leaves_the_old_tables(spark):
    root = work_folder(spark, "test")
    names = ["operations", "flotteurs", "resultats_humain"]
    sinks.full_refresh({n: table(spark, 1, 2) for n in names}, root)
    reader = FolderData(spark, root)
    broken = table(spark, 3).selectExpr("raise_error('lost') AS operation_id", "operation_id AS other")
    with pytest.raises(Exception, match="lost"):
        sinks.full_refresh({"operations": table(spark, 9), "flotteurs": broken, "resultats_humain": table(spark, 9)}, root)
    for data in (reader, FolderData(spark, root)):
        assert all(ids(data.table(n)) == [1, 2] for n in names)
    sinks.full_refresh({n: table(spark, 4) for n in names}, root)
    assert ids(FolderData(spark, root).cases()) == [4]
    assert all(ids(reader.table(n)) == [1, 2] for n in names)  # pinned


def test_versions_roll_back_and_are_cleaned_up(spark):
    root = work_folder(spark, "test")
    assert versions.current(spark, root) == versions.Version(0, {}) and versions.numbers(spark, root) == []
    one = versions.replace({"a": table(spark, 1), "b": table(spark, 1)}, root)
    two = versions.replace({"a": table(spark, 2)}, root)
    assert two.places["b"] == one.places["b"] and two.places["a"] != one.places["a"]
    three = versions.roll_back(spark, root, 1)
    assert (three.number, three.places) == (3, one.places)
    four = versions.replace({"a": table(spark, 4)}, root, drop=("b",))
    assert set(four.places) == {"a"} and versions.numbers(spark, root) == [1, 2, 3, 4]
    assert versions.clean_up(spark, root, keep=2) == [two.places["a"]]
    assert versions.clean_up(spark, root, keep=2) == []
    assert ids(spark.read.parquet(two.places["a"])) == [] and ids(FolderData(spark, root, version=3).table("a")) == [1]
    with pytest.raises(ValueError, match="no version 9"):
        versions.current(spark, root, 9)


def test_the_second_of_two_commits_fails(spark):
    root = work_folder(spark, "test")
    before = versions.replace({"a": table(spark, 1)}, root)
    versions.commit(spark, root, {"a": "first"}, before)
    with pytest.raises(versions.CommitConflict):
        versions.commit(spark, root, {"a": "second"}, before)
    assert versions.current(spark, root).places == {"a": "first"}
    # two that passed the check at the same time: everybody sees the same one
    spark.createDataFrame([("a", "third", "0")], versions.ROWS).write.mode("append").parquet(f"{root}/manifests/number=2")
    assert versions.current(spark, root).places == {"a": "third"}


# --- headers ----------------------------------------------------------------
def write_lines(spark, path, *lines):
    spark.createDataFrame([("\n".join(lines),)], "value string").coalesce(1).write.text(path)


def test_headers_of_odd_files(spark):
    root = work_folder(spark, "test")
    write_lines(spark, f"{root}/a.csv", '"id","na""me", note ', '1,"x,y",z')
    write_lines(spark, f"{root}/b.csv", "﻿note,id,id,more", "n,2,3,m", "n2,4,,")
    write_lines(spark, f"{root}/c.csv", "id,na\"me,note")
    spark.createDataFrame([], "value string").write.text(f"{root}/d.csv")
    got = {r["source_file"].split("/")[-2]: r["header"] for r in rows(files.file_headers(spark, f"{root}/*.csv"))}
    assert got == {"a.csv": ["id", 'na"me', "note"], "b.csv": ["note", "id", "id", "more"], "c.csv": ["id", 'na"me', "note"]}
    df, headers = files.read_csv_by_header(spark, f"{root}/*.csv", ["id", 'na"me', "note"])
    assert df.columns == ["id", 'na"me', "note", "more", "source_file"]
    assert sorted((r["id"], r['na"me'], r["note"], r["more"]) for r in rows(df)) == [("1", "x,y", "z", None), ("2", None, "n", "m"), ("4", None, "n2", None)]
    rules = Q.RuleSet(dict.fromkeys(["id", 'na"me', "note"], "str"), strict=True)
    found = sorted((r["source_file"].split("/")[-2], r["column"], r["check"], r["value"]) for r in rows(Q.header_failures(headers, rules)))
    assert found == [
        ("b.csv", "id", "duplicate_column", "2"), ("b.csv", "more", "unexpected_column", "4"), ("b.csv", 'na"me', "missing_column", None)]
    rules.strict = False
    assert {r["check"] for r in rows(Q.header_failures(headers, rules))} == {"duplicate_column", "missing_column"}


def test_no_files_and_empty_files(spark):
    root = work_folder(spark, "test")
    spark.createDataFrame([], "value string").write.text(f"{root}/a.csv")
    df, headers = files.read_csv_by_header(spark, f"{root}/a.csv", ["id"])
    assert df.columns == ["id", "source_file"] and df.count() == 0 and headers.count() == 0


# --- following the case -----------------------------------------------------
def test_children_follow_their_case(spark):
    rules = Q.RuleSet({"operation_id": "int", "cross": "str"}, [Q.type_rule("operation_id", "int"), Q.not_null_rule("cross")], ["operation_id"], )
    cases = spark.createDataFrame([("1", "Corse"), ("2", None), ("3", "Corse"), ("3", "Corse"), ("x", "Corse"), (None, "Corse")], "operation_id string, cross string")
    parent = Q.flag(cases, rules)
    parent = parent.selectExpr("*", "CASE WHEN size(failures) = 0 THEN 'valid' ELSE 'rejected' END AS verdict")
    children = spark.createDataFrame([("1",), ("1.0",), ("2",), ("3",), ("4",), ("x",), (None,)], "operation_id string")
    flagged = Q.flag(children, Q.RuleSet({}, [Q.type_rule("operation_id", "int")]))
    got = {r["operation_id"]: [f["check"] for f in r["failures"]] for r in rows(etl.follow_parent(flagged, parent))}
    assert got == {
        "1": [], "1.0": [], "2": ["parent_rejected(cross:not_null)"], "3": ["parent_rejected(operation_id:unique)"],
        "4": ["parent_missing"], "x": ["type(int)"], None: []}


def test_verdicts_of_keys_with_several_rows(spark):
    failed = "array<struct<column:string,check:string,value:string>>"
    records = [
        ("1", [], "valid"), ("1", [("cross", "not_null", None)], "rejected"), ("2", [("b", "y", "0"), ("a", "x", None)], "rejected"),
        ("2.0", [("a", "x", "9")], "rejected"), ("3", [], "valid"), ("x", [("operation_id", "type(int)", "x")], "rejected"), (None, [], "valid")]
    found = etl.verdict_by_key(spark.createDataFrame(records, f"operation_id string, failures {failed}, verdict string"))
    assert sorted(tuple(r.values()) for r in rows(found)) == [(1, True, "cross:not_null"), (2, False, "a:x;b:y"), (3, True, "")]
    assert found.columns == ["parent_key", "parent_valid", "parent_reasons"]


def test_repeated_keys_are_stored_before_the_rows_are_joined(spark):
    source, out = work_folder(spark, "test"), work_folder(spark, "test")
    names = list(etl.CONFIG["operations_stats"])
    lines = [",".join([key, "true", *["false" if n != "phase_journee" else "nuit" for n in names[2:]]]) for key in ("1", "2", "2", "", "", "3")]
    write_lines(spark, f"{source}/operations_stats.csv", ",".join(names), *lines)
    checked = etl.check_file(spark, f"{source}/operations_stats.csv", "operations_stats", out)
    assert {r["operation_id"] for r in rows(spark.read.parquet(f"{out}/operations_stats/repeated/operation_id"))} == {"2", None}
    unique = sorted((r["operation_id"] or "", any(f["check"] == "unique" for f in r["failures"])) for r in rows(checked))
    assert unique == [("", True), ("", True), ("1", False), ("2", True), ("2", True), ("3", False)]
    few = spark.read.parquet(f"{out}/operations_stats/repeated/operation_id")
    flagged = Q.flag(checked.drop("failures"), Q.RuleSet({}, unique=["operation_id"]), repeated={"operation_id": few})
    assert "hashpartitioning" not in flagged._jdf.queryExecution().executedPlan().toString()  # the rows stay where they are


@pytest.mark.parametrize("kind,values", [
    ("double", {12.0: 12, -0.0: 0, 12.5: None, 1e30: None, float("inf"): None, float("nan"): None, 9007199254740994.0: 9007199254740994}),
    ("float", {3.0: 3, 0.5: None}), ("bigint", {2**62 + 1: 2**62 + 1, -7: -7}), ("int", {5: 5}),
    ("string", {"12": 12, " 7 ": 7, "12.0": 12, "12.": 12, ".5": None, "1e3": 1000, "-0.0": 0, "x.y": None, "": None, "9223372036854775807": 2**63 - 1}),
])
def test_whole_numbers_by_stored_type(spark, kind, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, None])], f"i int, n {kind}")
    found = etl.coerce_integers(df, ["n"])
    assert [r["n"] for r in sorted(rows(found), key=lambda r: r["i"])] == [*values.values(), None]
    if kind != "string":  # numbers are not written as text and read again, which fails for each decimal
        assert "as string" not in found._jdf.queryExecution().analyzed().toString()


def test_loaded_tables_hold_no_orphans_and_serve_every_export(spark, sf_dir):
    target = work_folder(spark, "test")
    source = q_data.source_files(spark, sf_dir, "operation_id % 47 = 0")
    result = etl.staged_load(spark, source, target, loaded_at="2024-05-01 10:00:00")
    data = FolderData(spark, f"{target}/clean")
    for name in ("flotteurs", "resultats_humain"):
        assert data.table(name).join(data.cases("operation_id"), "operation_id", "left_anti").count() == 0
    counts = {r["table_name"]: r for r in rows(result.rejected)}
    for name in ("operations", "operations_stats", "flotteurs", "resultats_humain"):
        read = files.read_csv_text(spark, f"{source}/{name}.csv").count()
        assert counts[name]["valides"] + counts[name]["rejetees"] == read and counts[name]["rejetees"] > 0
    assert data.cases().count() == counts["operations"]["valides"]
    for name in registry.EXPORTS:
        registry.export(data, name).collect()
    vessel = data.vessels().first()
    assert vessel["flotteur_id"] is not None and str(vessel["created_at"]) == "2024-05-01 10:00:00"
    again = etl.staged_load(spark, None, target, schema_only=True)
    assert again.loaded == [] and again.version != result.version


def test_keys_of_all_cases_are_not_broadcast(spark):
    root = work_folder(spark, "test")
    cases = spark.range(1000).selectExpr("id AS operation_id", *[f"'{i}' AS c{i}" for i in range(30)])
    sinks.write_table(cases, f"{root}/operations")
    sinks.write_table(spark.range(990, 1010).selectExpr("id AS operation_id", "id AS flotteur_id"), f"{root}/flotteurs")
    data = FolderData(spark, root)
    found = q_data.with_their_case({n: data.table(n) for n in ("operations", "flotteurs")}, data.cases())
    assert found["operations"].count() == 1000 and ids(found["flotteurs"]) == list(range(990, 1000))
    for df in found.values():
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


# --- inferred types ---------------------------------------------------------
@pytest.mark.parametrize("values,kind", [
    (["1", " 2", "-3"], "bigint"), (["1", None], "double"), (["1", "2.5"], "double"), (["1e5", ".5", "inf"], "double"),
    (["True", "false"], "boolean"), (["True", None], "string"), (["1", "x"], "string"), ([None, None], "double"),
    (["99999999999999999999"], "double"), (["1d"], "string"), (["2024-01-01"], "string"), (["0x10"], "string"),
])
def test_types_follow_the_values(spark, values, kind):
    df = spark.createDataFrame([(v, "z") for v in values], "`the value` string, t string")
    kinds = etl.inferred_types(df, ["the value", "t"])
    assert kinds == {"the value": kind, "t": "string"}
    assert dict(etl.as_inferred(df, kinds).dtypes) == kinds
    assert etl.as_inferred(df, kinds).where("`the value` IS NULL").count() == values.count(None)


def test_raw_tables_change_together(spark):
    source, target = work_folder(spark, "test"), work_folder(spark, "test")
    config = {"a": {"id": {"type": "int", "nullable": False}, "gone": {"type": "str"}}, "b": {"id": {"type": "int"}}}
    write_lines(spark, f"{source}/a.csv", "id,free", "1,x", "NA,y", "3,null")
    write_lines(spark, f"{source}/b.csv", "id", "7")
    got = etl.raw_load(spark, source, target, config)
    assert got["a"].dtypes == [("id", "bigint"), ("free", "string")]
    assert sorted((r["id"], r["free"] or "") for r in rows(got["a"])) == [(1, "x"), (3, "")]
    errors = rows(spark.read.parquet(f"{target}/checks/a/errors"))
    assert sorted((r["column"], r["check"]) for r in errors) == [("gone", "renamed_column"), ("id", "not_null")]
    write_lines(spark, f"{source}/c.csv", "other", "1")
    with pytest.raises(Exception):
        etl.raw_load(spark, source, target, {"a": config["a"], "none": {}})
    assert versions.current(spark, f"{target}/raw").number == 1


def test_headers_are_found_by_one_scan(spark):
    path = work_folder(spark, "test")
    write_lines(spark, f"{path}/a", "x,y", "1,2")
    write_lines(spark, f"{path}/b", "y,x,x", "4,3,0")
    table, headers = files.read_csv_by_header(spark, f"{path}/*", ["x", "y"])
    assert sorted((r["x"], r["y"]) for r in rows(table)) == [("1", "2"), ("3", "4")]
    assert sorted(r["header"] for r in rows(headers)) == [["x", "y"], ["y", "x", "x"]]
    assert headers.inputFiles() == []  # looking at them again reads no file


def test_verdicts_of_a_parent_are_found_once(spark, sf_dir, monkeypatch):
    asked, find = [], etl.verdict_by_key
    monkeypatch.setattr(etl, "verdict_by_key", lambda checked: asked.append(1) or find(checked))
    checked = etl.check_files(spark, q_data.source_files(spark, sf_dir, "operation_id % 47 = 0"), work_folder(spark, "test"))
    assert list(checked) == list(etl.PARENTS) and len(asked) == 1  # three tables follow the cases


def test_quality_rows_are_written_without_a_sort(spark):
    setting, seen = "spark.sql.maxConcurrentOutputFileWriters", []
    before = spark.conf.get(setting)
    flagged = Q.flag(spark.createDataFrame([(i, "x" if i % 3 else None) for i in range(30)], "id long, v string"), Q.RuleSet({}, [Q.not_null_rule("v")]))

    class Writer:
        def parquet(self, path):
            seen.append(int(spark.conf.get(setting)))

    sinks._write_unsorted(Writer(), "", spark)
    assert seen == [max(2, int(before))] and spark.conf.get(setting) == before
    rows_at = sinks.write_quality(flagged, work_folder(spark, "test"), "id")["rows"]
    assert {(r["verdict"], r["count"]) for r in rows(spark.read.parquet(rows_at).groupBy("verdict").count())} == {("valid", 20), ("rejected", 10)}
