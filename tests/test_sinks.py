import pytest

from checks.q_data import damaged, flagged
from conftest import rows
from vigie.operators import quality as Q
from vigie.plans import registry, reports, views
from vigie.session import work_folder, work_root
from vigie.sources import files, sinks, versions
from vigie.sources.dataset import CatalogData, FolderData
from vigie.sources.star import StarData


def same(a, b):
    return sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(b.columns)).collect()))


def test_every_stored_report_equals_its_direct_computation(spark, sf_dir):
    data, root = StarData(spark, sf_dir), work_folder(spark, "test")
    first = registry.refresh(data, root, ["v_kpi_annuel"])
    second = registry.refresh(data, root)
    assert first != second
    for name, report in registry.STORED.items():
        assert same(registry.stored_report(spark, root, name), report(data)), name


def test_a_named_refresh_keeps_the_other_reports(spark, sf_dir):
    data, root = StarData(spark, sf_dir), work_folder(spark, "test")
    first = registry.refresh(data, root, ["v_kpi_annuel", "v_kpi_cross"])
    second = registry.refresh(data, root, ["v_kpi_annuel"])
    found = versions.current(spark, root)
    number, places = found.number, found.places
    assert (number, places["v_kpi_annuel"], places["v_kpi_cross"]) == (2, f"{second}/v_kpi_annuel", f"{first}/v_kpi_cross")
    assert all(places[fact] == f"{second}/{fact}" for fact in ("operations_stats", "case_facts", "category_facts"))
    assert same(registry.stored_report(spark, root, "v_kpi_cross"), registry.STORED["v_kpi_cross"](data))
    with pytest.raises(KeyError):
        registry.refresh(data, root, ["v_inconnue"])
    assert versions.current(spark, root).number == 2


def test_audit_questions_on_folders_and_catalogs(spark, sf_dir):
    data, root = StarData(spark, sf_dir), work_folder(spark, "test")
    data.audit().write.parquet(f"{root}/audit_log")
    spark.sql(f"CREATE TABLE audit_log USING parquet LOCATION '{root}/audit_log'")
    try:
        for handle in (FolderData(spark, root), CatalogData(spark)):
            for question in (reports.audit_entries, reports.audit_summary, reports.audited_tables):
                assert same(question(handle), question(data))
    finally:
        spark.sql("DROP TABLE audit_log")


def test_reports_on_folders_equal_reports_on_the_source(spark, sf_dir):
    data, root = StarData(spark, sf_dir), work_folder(spark, "test")
    sinks.full_refresh({"operations": data.cases(), "flotteurs": data.vessels(), "resultats_humain": data.persons()}, root)
    assert same(views.vessel_analysis(FolderData(spark, root)), views.vessel_analysis(data))


def test_unknown_export_is_refused(spark, sf_dir):
    with pytest.raises(ValueError, match="v_inconnue"):
        registry.export(StarData(spark, sf_dir), "v_inconnue")
    assert len(registry.EXPORTS) == 19 and len(registry.STORED) == 23


def test_quality_outputs_add_up(spark, sf_dir):
    places = sinks.write_quality(flagged(spark, sf_dir), work_folder(spark, "test"), "row_id")
    split = {r["verdict"]: r["n"] for r in rows(spark.read.parquet(places["rows"]).groupBy("verdict").agg({"*": "count"}).toDF("verdict", "n"))}
    assert split["valid"] + split["rejected"] == damaged(spark, sf_dir).count()
    assert spark.read.parquet(places["errors"]).select("row_id").distinct().count() == split["rejected"]


def test_quality_outputs_without_rejects_or_rows(spark):
    df = spark.createDataFrame([(1,)], "id long")
    for frame in (df, df.limit(0)):
        places = sinks.write_quality(Q.flag(frame, Q.RuleSet({}, [Q.not_null_rule("id")])), work_folder(spark, "test"), "id")
        assert spark.read.parquet(places["errors"]).count() == 0


def test_csv_round_trip_keeps_commas_quotes_and_missing_values(spark):
    folder = work_folder(spark, "test")
    df = spark.createDataFrame([(1, 'a,"b"', ["x", "y"]), (2, None, None)], "id long, t string, l array<string>")
    sinks.export_csv(df, folder)
    got = rows(files.read_csv(spark, folder, {"id": "int", "t": "str", "l": "str"}).orderBy("id"))
    assert got == [{"id": 1, "t": 'a,"b"', "l": "x, y"}, {"id": 2, "t": None, "l": None}]


def test_parameters_are_bound(spark):
    df = spark.createDataFrame([("a' OR '1'='1",), ("b",)], "t string")
    assert files.query(spark, "SELECT * FROM {df} WHERE t = :v", {"v": "a' OR '1'='1"}, df=df).count() == 1


def test_tables_bucketed_by_case_join_without_a_shuffle(spark, sf_dir):
    data = StarData(spark, sf_dir)
    sinks.save_by_case(data.cases("operation_id", "evenement"), "cases_by_case", 4)
    sinks.save_by_case(data.persons("operation_id", "nombre"), "persons_by_case", 4)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        per_case = spark.table("persons_by_case").groupBy("operation_id").sum("nombre")
        joined = spark.table("cases_by_case").join(per_case, "operation_id", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert joined.count() == data.cases("operation_id").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("DROP TABLE cases_by_case")
        spark.sql("DROP TABLE persons_by_case")


CATEGORY_REPORTS = [
    views.category_counts, views.category_rescue, views.category_months, views.category_centres, views.official_months,
    views.category_places, views.case_map,
]
VESSEL_REPORTS = [
    views.vessel_analysis, views.vessel_analysis_active, views.vessel_classes, lambda d: views.vessel_classes(d, active=True),
]


def test_facts_by_case_are_neither_shuffled_nor_reduced_again(spark, sf_dir):
    """No exchange below the final groups: vessels and people stay where the refresh put them."""
    data, root = StarData(spark, sf_dir), work_folder(spark, "test")
    registry.refresh(data, root, ["v_kpi_annuel"], buckets=4)
    facts = registry.stored_facts(data, root)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for report in [*CATEGORY_REPORTS, *VESSEL_REPORTS]:
            plan = report(facts)._jdf.queryExecution().executedPlan().toString()
            assert "lineitem" not in plan and "orders" not in plan, plan
            assert not [x for x in plan.splitlines() if "hashpartitioning(operation_id" in x], plan
            assert plan.count("Scan parquet") == plan.count("_facts_"), plan
            below = plan[plan.index("Join"):] if "Join" in plan else ""
            assert "Exchange" not in below and "Broadcast" not in below, plan
            assert same(report(facts), report(data))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_a_case_that_holds_most_rows_is_one_row_a_description_in_its_bucket(spark, make_data):
    people = [{"operation_id": 1, "categorie_personne": "Autre", "resultat_humain": "Personne secourue", "nombre": 1, "dont_nombre_blesse": 0}] * 500
    vessels = [{"operation_id": 1, "numero_ordre": i, "categorie_flotteur": "Pêche"} for i in range(500)]
    data = make_data([{"operation_id": 1}, {"operation_id": 2}, {"operation_id": None}], people, vessels)
    root = work_folder(spark, "test")
    registry.refresh(data, root, ["v_kpi_annuel"], buckets=3)
    stored = registry.stored_facts(data, root).stored
    assert rows(stored["vessel_facts"].select("operation_id", "vessels")) == [{"operation_id": 1, "vessels": 500}]
    assert rows(stored["category_facts"].select("operation_id", "personnes")) == [{"operation_id": 1, "personnes": 500}]
    assert stored["case_facts"].count() == 3


def test_old_facts_leave_the_catalog_with_their_version(spark, make_data):
    data, root = make_data([{"operation_id": 1}]), work_folder(spark, "test")
    for _ in range(3):
        registry.refresh(data, root, ["v_kpi_annuel"], buckets=2)
    def held():
        return {registry._catalog_name(versions.current(spark, root, n).places["case_facts"]) for n in versions.numbers(spark, root)} & {t.name for t in spark.catalog.listTables()}

    assert len(held()) == 3
    registry.clean_up(spark, root, keep=1)
    assert len(held()) == 1
    facts = registry.stored_facts(data, root)
    assert facts.cases().count() == 1
    for name in held():
        spark.sql(f"DROP TABLE {name}")  # a later session: plain files, and none at all for people and vessels
    later = registry.stored_facts(data, root)
    assert later.cases().count() == 1 and views.vessel_analysis(later).count() == 0 and views.category_counts(later).count() == 0


def test_work_folders_follow_the_cluster_setting(spark):
    assert work_root("hdfs://shared/work/", "yarn", "app") == "hdfs://shared/work"
    assert work_root(None, "local[4]", "app") == work_root(None, "local[4]", "app")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_root(None, "yarn", "app")
    assert work_folder(spark, "x") != work_folder(spark, "x")


def test_csv_keeps_text(spark):
    from vigie.sources.files import read_csv

    root = work_folder(spark, "test")
    texts = [" pad ", 'say "yes"', 'a,"b" c', "line\nbreak", "", None, "\\back\\"]
    spark.createDataFrame(list(enumerate(texts)), "k int, t string").transform(lambda df: sinks.export_csv(df, f"{root}/out") or df)
    got = {r["k"]: r["t"] for r in rows(read_csv(spark, f"{root}/out", {"k": "int", "t": "str"}, multi_line=True))}
    assert [got[k] for k in range(len(texts))] == [t or None for t in texts] or [got[k] for k in range(len(texts))] == texts
