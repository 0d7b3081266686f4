"""The plans are the product: what is read, joined and shuffled."""

import pytest

import __spark_entry__ as entry
from checks import catalog, q_data, q_reports, q_views
from vigie.operators.entities import CASE, data_dictionary
from vigie.operators.filters import between_dates
from vigie.plans import view_queries, views
from vigie.session import work_folder
from vigie.sources.dataset import FolderData
from vigie.sources.sinks import full_refresh
from vigie.sources.star import StarData

LAZY = {**q_views.QUERIES, **q_reports.QUERIES, **{k: v for k, v in q_data.QUERIES.items() if k.startswith(("dq_", "cdc_", "join_", "batch_", "fk_", "delete_"))}}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("name", sorted(LAZY))
def test_no_product_joins_and_no_python_rows(spark, sf_dir, name):
    text = plan(LAZY[name](spark, sf_dir))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CollectLimit"):
        assert word not in text, (name, word)


def test_monthly_report_reads_four_line_columns_and_no_customer(spark, sf_dir):
    text = plan(views.monthly_safety(StarData(spark, sf_dir)))
    assert "customer" not in text and "nation" not in text
    assert "l_extendedprice" not in text and "o_totalprice" not in text


def test_unused_counters_are_pruned_down_to_the_scan(spark, sf_dir):
    one = views.monthly_safety(StarData(spark, sf_dir)).select("periode", "total_impliques")
    assert "l_suppkey" not in plan(one)


def test_date_filter_reaches_the_scan(spark, sf_dir):
    orders = StarData(spark, sf_dir).star("orders")
    text = plan(between_dates(orders, "1998-01-01", column="o_orderdate"))
    assert "GreaterThanOrEqual(o_orderdate" in text


def test_persons_are_reduced_before_they_meet_cases(spark, sf_dir):
    """Every join side made of person rows is an aggregate."""
    text = optimized(views.category_centres(StarData(spark, sf_dir)))
    join = text.index("Join Inner")
    assert text.index("Aggregate", join) < text.index("Relation", join)


def test_top_lists_use_a_bounded_heap(spark, sf_dir):
    for name in ("q_top_operations", "q_casualties", "q_search", "qk_carte_operations"):
        assert "TakeOrderedAndProject" in plan(LAZY[name](spark, sf_dir)), name


def test_the_whole_export_is_sorted_by_ranges(spark, sf_dir):
    """No row limit, so no single task: the sort deals rows out by ranges of their order."""
    text = plan(LAZY["q_operations_export"](spark, sf_dir))
    assert "TakeOrderedAndProject" not in text and "SinglePartition" not in text
    assert "rangepartitioning" in text


def test_median_counts_are_computed_once(spark, sf_dir):
    df = views.headline(StarData(spark, sf_dir))
    df.collect()
    assert "ReusedExchange" in plan(df) or plan(df).count("partial_count(1)") <= 2


def test_registry_and_sql_agree_on_names():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert not [n for n in catalog.QUERIES if "pipeline" in n or n.startswith("op") and n[2:3].isdigit()]


def test_case_regrouping_after_the_join_needs_no_shuffle(spark, sf_dir):
    """Persons by case and category, then cases, then by case: three exchanges and the final ones."""
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(views.case_map(StarData(spark, sf_dir)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    top_group = text[: text.index("Join")]
    assert "Exchange" not in top_group


def test_a_year_reaches_the_scan_of_stored_cases(spark, sf_dir):
    data, root = StarData(spark, sf_dir), work_folder(spark, "test")
    full_refresh({"operations": data.cases(), "flotteurs": data.vessels(), "resultats_humain": data.persons()}, root)
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")  # show whole filter lists
    try:
        text = plan(view_queries.latest_months(FolderData(spark, root), year=1998, active=True))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThanOrEqual(date_heure_reception_alerte,1998" in text
    assert "In(cross, [" in text


def test_a_page_is_cut_before_people_are_summed(spark, sf_dir):
    df = q_reports.QUERIES["q_search_default"](spark, sf_dir)
    logical = optimized(df)
    assert "LeftSemi" in logical
    assert logical.index("Aggregate") < logical.index("LeftSemi")  # the sum sits above the cut


def test_quick_dictionary_agrees_on_rows_and_missing_values(spark, sf_dir):
    cases = StarData(spark, sf_dir).cases()

    def counts(exact):
        return {r["champ"]: (r["lignes"], r["manquantes"]) for r in data_dictionary(CASE, cases, exact).collect()}

    assert counts(True) == counts(False)
