"""Registered sources, sinks, quality rules, loading, change capture, joins and streams."""

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie import labels as L
from vigie.functions.measures import named
from vigie.operators import changes as C
from vigie.operators import entities as E
from vigie.operators import quality as Q
from vigie.operators.counters import attach_counters
from vigie.operators.rollup import ALERT, BY_MONTH, active_only, dated_cases, roll_up
from vigie.operators.series import share_of_total, trailing_sums_by_join
from vigie.plans import etl, incremental, registry
from vigie.plans import reports as R
from vigie.plans import views as V
from vigie.session import work_folder
from vigie.sources import daily_log, deltas, files, sinks, versions
from vigie.sources.dataset import FolderData, FrameData
from vigie.sources.star import StarData, audit_projection, person_projection
from vigie.streaming import jobs

# --- damaged text rows, as a careless file would bring them -----------------
DAMAGED = {
    "row_id": "o_orderkey",
    "operation_id": "CASE WHEN o_orderkey % 211 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN concat('x', o_orderkey)"
    " WHEN o_orderkey % 107 = 0 THEN cast(o_orderkey - 1 AS string) ELSE cast(o_orderkey AS string) END",
    "type_operation": "CASE WHEN o_orderkey % 157 = 0 THEN 'XXX' WHEN o_orderkey % 163 = 0 THEN '' ELSE get(array('SAR', 'MAS', 'DIV'), cast(o_orderkey % 3 AS int)) END",
    "cross": "CASE WHEN o_orderkey % 127 = 0 THEN NULL WHEN o_orderkey % 63 = 0 THEN 'Atlantis' ELSE get(array('Corse', 'Corsen', 'Gris-Nez', 'Jobourg'), cast(o_orderkey % 4 AS int)) END",
    "departement": "CASE WHEN o_orderkey % 151 = 0 THEN '12345' ELSE cast(o_orderkey % 95 AS string) END",
    "latitude": "CASE WHEN o_orderkey % 109 = 0 THEN '123.5' WHEN o_orderkey % 50 = 0 THEN NULL ELSE cast((o_orderkey * 37) % 180 - 90 AS string) END",
    "longitude": "CASE WHEN o_orderkey % 83 = 0 THEN NULL ELSE cast((o_orderkey * 91) % 360 - 180 AS string) END",
    "vent_direction_categorie": "CASE WHEN o_orderkey % 131 = 0 THEN 'inconnu' ELSE get(array('nord', 'nord-est', 'est', 'sud-est'), cast(o_orderkey % 4 AS int)) END",
    "vent_force": "CASE WHEN o_orderkey % 113 = 0 THEN '-1' WHEN o_orderkey % 117 = 0 THEN '3.5' WHEN o_orderkey % 119 = 0 THEN 'fort' ELSE cast(o_orderkey % 16 AS string) END",
    "mer_force": "cast(o_orderkey % 11 AS string)",
    "date_heure_reception_alerte": "CASE WHEN o_orderkey % 139 = 0 THEN 'hier' WHEN o_orderkey % 149 = 0 THEN NULL ELSE concat(cast(cast(o_orderdate AS date) AS string), ' 00:00:00') END",
    "systeme_source": "CASE WHEN o_orderkey % 137 = 0 THEN '  ' WHEN o_orderkey % 2 = 0 THEN 'secmarweb' ELSE 'seamis_json' END",
}
COMPASS = L.REFERENCE_LISTS["VENT_DIRECTION_CATEGORIE"]
CONFIG = {
    "operation_id": {"type": "int", "nullable": False, "unique": True},
    "type_operation": {"type": "str"},
    "cross": {"type": "str", "nullable": False},
    "departement": {"type": "str"},
    "latitude": {"type": "float", "check": "(-90 <= x) & (x <= 90)"},
    "longitude": {"type": "float", "check": "(-180 <= x) & (x <= 180)"},
    "vent_direction_categorie": {"type": "str", "checks": [{"isin": COMPASS}]},
    "vent_force": {"type": "float", "check": "x >= 0"},
    "mer_force": {"type": "float", "checks": [{"greater_than": 0}, {"less_than": 10}]},
    "date_heure_reception_alerte": {"type": "datetime", "nullable": False},
    "systeme_source": {"type": "str", "nullable": False, "checks": [{"isin": ["secmarweb", "seamis_json"]}]},
}


def damaged(spark, sf_dir) -> DataFrame:
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return orders.selectExpr(*[f"{e} AS {c}" for c, e in DAMAGED.items()])


def typed_numbers(spark, sf_dir) -> DataFrame:
    numbers = [f"try_cast({c} AS double) AS {c}" for c in ("latitude", "longitude", "vent_force", "mer_force")]
    return damaged(spark, sf_dir).selectExpr("row_id", "departement", *numbers)


def flagged(spark, sf_dir) -> DataFrame:
    return Q.flag(damaged(spark, sf_dir), Q.rules_from_config(CONFIG))


def breaking(source, *rules, unique=(), keys=("row_id",), blocking=True):
    """Failure cases of single rules over a source."""
    return lambda spark, sf_dir: Q.failure_cases(
        Q.flag(source(spark, sf_dir), Q.RuleSet({}, list(rules), list(unique)), blocking), *keys
    )


def vessels(spark, sf_dir) -> DataFrame:
    made = StarData(spark, sf_dir).vessels("operation_id", "numero_ordre", "type_flotteur", "resultat_flotteur")
    return made.withColumn("longueur", F.expr("CASE WHEN numero_ordre % 5 <> 0 THEN cast(numero_ordre AS double) END"))


def persons(spark, sf_dir) -> DataFrame:
    return StarData(spark, sf_dir).persons("operation_id", "categorie_personne", "resultat_humain", "nombre", "dont_nombre_blesse")


def split(spark, sf_dir) -> DataFrame:
    return flagged(spark, sf_dir).selectExpr(
        "row_id", "size(failures) = 0 AS valide",
        "array_join(array_sort(transform(failures, f -> concat(f.column, ':', f.check))), ';') AS echecs",
    )


def fail_fast(spark, sf_dir) -> DataFrame:
    cases = StarData(spark, sf_dir).cases("operation_id", "latitude", "longitude", "vent_force")
    return Q.require_valid(cases, E.case_rules(cases.columns[1:])).select("operation_id")


def projected(spark, sf_dir) -> DataFrame:
    rules = Q.rules_from_config({k: CONFIG[k] for k in ("operation_id", "cross")}, strict=True)
    source = damaged(spark, sf_dir)
    extra = set(Q.unexpected_columns(source, rules))
    return source.select(*[c for c in source.columns if c not in extra])


def entity(source, rules, *keys):
    def run(spark, sf_dir):
        rows = source(spark, sf_dir)
        found = Q.flag(rows, rules(rows.columns))
        return R.grouped(Q.failure_cases(found, *keys), [*keys, "column", "check", "value"], "cast(count(1) AS bigint) AS cas")

    return run


def unknown(spark, sf_dir) -> DataFrame:
    rows = damaged(spark, sf_dir)
    lists = {"type_operation": L.REFERENCE_LISTS["TYPE_OPERATION"], "cross": L.REFERENCE_LISTS["CROSS_VALUES"]}
    return reduce(DataFrame.unionByName, [Q.unknown_values(rows, c, v) for c, v in lists.items()])


def report(spark, sf_dir) -> DataFrame:
    rows = damaged(spark, sf_dir)
    return Q.quality_report(rows, E.field_rules(E.CASE, rows.columns), E.reference_lists(E.CASE, ["type_operation", "cross"]))


QUALITY = {
    "dq_rules_from_config": lambda s, d: flagged(s, d).selectExpr("row_id", "cast(size(failures) AS bigint) AS echecs"),
    "dq_type_check": breaking(damaged, Q.type_rule("operation_id", "int"), Q.type_rule("vent_force", "float"), Q.type_rule(ALERT, "datetime")),
    "dq_not_null": breaking(damaged, Q.not_null_rule("operation_id"), Q.not_null_rule("cross")),
    "dq_unique": breaking(damaged, unique=["operation_id"]),
    "dq_greater_than": breaking(damaged, Q.compare_rule("mer_force", "float", "greater_than", ">", 0)),
    "dq_less_than": breaking(damaged, Q.compare_rule("mer_force", "float", "less_than", "<", 10)),
    "dq_isin": breaking(damaged, Q.isin_rule("vent_direction_categorie", "str", COMPASS)),
    "dq_range_expr": breaking(damaged, Q.expression_rule("latitude", "float", "(-90 <= x) & (x <= 90)")),
    "dq_strict_columns": projected,
    "dq_split": split,
    "dq_failure_cases": lambda s, d: Q.failure_cases(flagged(s, d), "row_id"),
    "dq_failure_summary": lambda s, d: Q.failure_summary(flagged(s, d)),
    "dq_fail_fast": fail_fast,
    "dq_required_non_blank": breaking(damaged, Q.required_rule("systeme_source"), Q.required_rule("operation_id")),
    "dq_min_max_len": lambda s, d: Q.failure_cases(Q.flag(damaged(s, d), E.field_rules(E.CASE, list(DAMAGED))), "row_id"),
    "dq_enum_warning": unknown,
    "dq_enum_strict": breaking(damaged, Q.isin_rule("type_operation", "str", L.REFERENCE_LISTS["TYPE_OPERATION"])),
    "dq_dataframe_report": report,
    "dq_coords_pair": breaking(typed_numbers, Q.coordinates_pair()),
    "dq_coords_zone": breaking(typed_numbers, Q.coordinates_zone(), blocking=False),
    "dq_result_count": breaking(persons, Q.outcome_needs_people(), keys=("operation_id", "resultat_humain")),
    "dq_length_by_type": breaking(vessels, Q.length_fits_type(), keys=("operation_id", "type_flotteur")),
    "dq_beaufort": breaking(typed_numbers, Q.beaufort()),
    "dq_douglas": breaking(typed_numbers, Q.douglas()),
    "dq_departement_format": breaking(typed_numbers, Q.department_format()),
    "dq_entity_operation": entity(damaged, E.case_rules, "row_id"),
    "dq_entity_operation_strict": entity(damaged, lambda c: E.case_rules(c, strict=True), "row_id"),
    "dq_entity_flotteur": entity(vessels, lambda c: E.vessel_rules(c, strict=True), "operation_id"),
    "dq_entity_resultat": entity(persons, E.person_rules, "operation_id"),
}


# --- sources ----------------------------------------------------------------
def csv_scan(spark, sf_dir) -> DataFrame:
    folder = work_folder(spark, "csv")
    cases = StarData(spark, sf_dir).cases("operation_id", "type_operation", "cross", "vent_force", ALERT)
    sinks.export_csv(cases, folder)
    kinds = {"operation_id": "int", "type_operation": "str", "cross": "str", "vent_force": "int", ALERT: "datetime"}
    return files.read_csv(spark, folder, kinds)


def table_scan(spark, sf_dir) -> DataFrame:
    V.yearly(StarData(spark, sf_dir)).createOrReplaceTempView("v_kpi_annuel")
    return files.scan(spark, "v_kpi_annuel")


def bound_query(spark, sf_dir) -> DataFrame:
    cases = StarData(spark, sf_dir).cases("operation_id", "cross", "vent_force")
    text = "SELECT cross, cast(count(*) AS bigint) AS n FROM {cases} WHERE vent_force >= :vent AND cross <> :name GROUP BY cross"
    return files.query(spark, text, {"vent": 6, "name": "d'Ailleurs"}, cases=cases)


# --- sinks ------------------------------------------------------------------
def replace_append(spark, sf_dir) -> DataFrame:
    folder = work_folder(spark, "table")
    rows = StarData(spark, sf_dir).cases("operation_id", "type_operation")
    sinks.write_table(rows, folder)
    sinks.write_table(rows.where("type_operation = 'SAR'"), folder, "append")
    return spark.read.parquet(folder)


def bulk_refresh(spark, sf_dir) -> DataFrame:
    folder, data = work_folder(spark, "clean"), StarData(spark, sf_dir)
    names = sinks.full_refresh({"resultats_humain": data.persons(), "flotteurs": data.vessels(), "operations": data.cases()}, folder)
    loaded = FolderData(spark, folder)
    return C.table_counts({n: loaded.table(n) for n in names})


def rolled_back(spark, sf_dir) -> DataFrame:
    """Two loads and the way back; a reader of the second load keeps it."""
    root, data = work_folder(spark, "versions"), StarData(spark, sf_dir)
    every = {"operations": data.cases("operation_id"), "resultats_humain": data.persons("operation_id", "nombre")}
    first = versions.replace(every, root)
    versions.replace({n: df.where("operation_id % 3 = 0") for n, df in every.items()}, root)
    second = FolderData(spark, root)
    second.cases()
    versions.roll_back(spark, root, first.number)
    versions.clean_up(spark, root, keep=2)
    readers = {"lecteur_2": second, "lecteur_3": FolderData(spark, root), "version_1": FolderData(spark, root, version=1)}
    counts = [C.table_counts({n: d.table(n) for n in every}).withColumn("lecteur", F.lit(r)) for r, d in readers.items()]
    return reduce(DataFrame.unionByName, counts)


def three_outputs(spark, sf_dir) -> DataFrame:
    places = sinks.write_quality(flagged(spark, sf_dir), work_folder(spark, "quality"), "row_id")
    rows = spark.read.parquet(places["rows"]).selectExpr("cast(verdict AS string) AS sortie", "row_id", "'' AS controle")
    return rows.unionByName(spark.read.parquet(places["errors"]).selectExpr("'errors' AS sortie", "row_id", "check AS controle"))


def csv_export(spark, sf_dir) -> DataFrame:
    folder = work_folder(spark, "export")
    sinks.export_csv(StarData(spark, sf_dir).audit("id", "table_name", "operation_type", "changed_fields", "user_id"), folder)
    return files.read_csv_text(spark, folder)


def bundle(spark, sf_dir) -> DataFrame:
    return C.table_counts(registry.export_bundle(StarData(spark, sf_dir)))


def materialized(spark, sf_dir) -> DataFrame:
    root = work_folder(spark, "reports")
    registry.refresh(StarData(spark, sf_dir), root)
    names = [*registry.FACTS, *registry.STORED]
    return C.table_counts({n: registry.stored_report(spark, root, n) for n in names})


def refreshed_by_case(report):
    """A report with its parameters over the bucketed facts of a refresh."""

    def query(spark, sf_dir) -> DataFrame:
        data, root = StarData(spark, sf_dir), work_folder(spark, "facts")
        registry.refresh(data, root, ["v_kpi_annuel"], buckets=int(spark.conf.get("spark.sql.shuffle.partitions")))
        return report(registry.stored_facts(data, root))

    return query


# --- loading ----------------------------------------------------------------
ENRICHED = ["operation_id", "est_jour_ferie", "phase_journee", "maree_coefficient"]


def merged(spark, sf_dir) -> DataFrame:
    data = StarData(spark, sf_dir)
    enrichment = data.cases(*ENRICHED).where("NOT est_jour_ferie")
    return etl.merge_enrichment(data.cases("operation_id", "type_operation"), enrichment)


def sampled(spark, sf_dir) -> DataFrame:
    data = StarData(spark, sf_dir)
    sample = C.sample_cases(data.cases("operation_id"), 10000)
    return C.children_of_sample(data.vessels("operation_id", "numero_ordre", "pavillon"), sample)


def tables(spark, sf_dir) -> dict[str, DataFrame]:
    data = StarData(spark, sf_dir)
    return {"operations": data.cases("operation_id"), "flotteurs": data.vessels("operation_id"), "resultats_humain": data.persons("operation_id")}


def source_files(spark, sf_dir, absent: str = "false") -> str:
    """A folder of CSV files with some bad rows; cases of ``absent`` are in no file of cases."""
    source, data = work_folder(spark, "files"), StarData(spark, sf_dir)
    blank = "cast(NULL AS string)"
    base = data.cases()
    cases = base.where(f"NOT ({absent})").selectExpr(*[
        {"numero_sitrep": "CASE WHEN operation_id % 41 = 0 THEN -1 ELSE operation_id END", "cross": "coalesce(cross, 'Inconnu')",
         "cross_sitrep": "'S'", "fuseau_horaire": "'UTC'", "systeme_source": "CASE WHEN operation_id % 43 = 0 THEN 'papier' ELSE 'secmarweb' END",
         ALERT: f"coalesce({ALERT}, date_heure_fin_operation, timestamp_ntz '2000-01-01 00:00:00')"}.get(c, c if c in base.columns else blank) + f" AS {c}"
        for c in etl.CONFIG["operations"]
    ])
    enrichment = base.selectExpr(*[
        {"concerne_plongee": "false", "implique_wingfoil": "false"}.get(c, c if c in base.columns else blank) + f" AS {c}"
        for c in etl.CONFIG["operations_stats"]
    ])
    boats = data.vessels().selectExpr(*[(c if c in data.vessels().columns else blank) + f" AS {c}" for c in etl.CONFIG["flotteurs"]])
    people = data.persons().selectExpr(*etl.CONFIG["resultats_humain"])
    for name, frame in {"operations": cases, "operations_stats": enrichment, "flotteurs": boats, "resultats_humain": people}.items():
        sinks.export_csv(frame, f"{source}/{name}.csv")
    return source


def staged(spark, sf_dir) -> DataFrame:
    """CSV files with some bad rows go through the whole load; the result is the audit log."""
    target = work_folder(spark, "loaded")
    result = etl.staged_load(spark, source_files(spark, sf_dir), target)
    yearly = registry.stored_report(spark, f"{target}/reports", "v_kpi_annuel")
    return result.audit.select("table_name", "operation_type", "new_values").unionByName(
        yearly.agg(F.expr("cast(sum(total_operations) AS string)").alias("new_values")).selectExpr(
            "'v_kpi_annuel' AS table_name", "'REPORT' AS operation_type", "new_values")
    )


def followed(spark, sf_dir) -> DataFrame:
    """Rows by their verdict, and rejected ones by what their case failed or lacked."""
    target = work_folder(spark, "checked")
    checked = etl.check_files(spark, source_files(spark, sf_dir, "operation_id % 47 = 0"), target)
    verdicts = etl.verdict_counts(checked).selectExpr("table_name", "stack(2, 'valid', valides, 'rejected', rejetees) AS (controle, lignes)")
    parents = [
        R.grouped(spark.read.parquet(f"{target}/{n}/errors").where("check LIKE 'parent%'"), {"controle": "check"}, "cast(count(1) AS bigint) AS lignes").select(
            F.lit(n).alias("table_name"), "controle", "lignes")
        for n in checked
    ]
    return reduce(DataFrame.unionByName, parents, verdicts)


def with_their_case(tables: dict[str, DataFrame], cases: DataFrame) -> dict[str, DataFrame]:
    """The rows of each table whose case is there.

    Keys of all cases are never broadcast: one column of a wide compressed table is taken for far
    smaller than its values are in the driver's memory.
    """
    keys = cases.select("operation_id").hint("merge")
    return {n: df.join(keys, "operation_id", "left_semi") for n, df in tables.items()}


def loaded_tables(spark, sf_dir) -> DataFrame:
    """Rows of the loaded tables that have their key, their case and their bookkeeping times."""
    target = work_folder(spark, "loaded")
    etl.staged_load(spark, source_files(spark, sf_dir), target, loaded_at="2024-01-01 00:00:00")
    data = FolderData(spark, f"{target}/clean")
    keys = {"operations": "operation_id", **etl.TABLE_KEYS}
    rows = with_their_case({n: data.table(n) for n in keys}, data.cases())
    return C.table_counts({n: rows[n].where("created_at = updated_at").dropDuplicates([k]) for n, k in keys.items()})


def headers_of_files(spark, sf_dir) -> DataFrame:
    """Three files of one folder: as declared, with a renamed and an added column, with columns moved and left out."""
    root = work_folder(spark, "headers")
    names = ["row_id", "operation_id", "cross", "vent_force", "mer_force"]
    rows = damaged(spark, sf_dir).select(*names)
    sinks.export_csv(rows.where("row_id % 3 = 0"), f"{root}/a.csv")
    sinks.export_csv(rows.where("row_id % 3 = 1").withColumnRenamed("vent_force", "force du vent").withColumn("note", F.lit("a,b")), f"{root}/b.csv")
    sinks.export_csv(rows.where("row_id % 3 = 2").select("mer_force", "cross", "row_id", "vent_force"), f"{root}/c.csv")
    rules = Q.RuleSet(dict.fromkeys(names, "str"), strict=True)
    table, headers = files.read_csv_by_header(spark, f"{root}/*.csv", names)
    file = "regexp_extract(source_file, '([abc])[.]csv', 1) AS fichier"
    wrong = Q.header_failures(headers, rules).selectExpr(file, "column", "check", "value").distinct()
    known = R.grouped(table.selectExpr("*", file), ["fichier"], "cast(count(1) AS bigint) AS lignes", *[f"cast(count(`{c}`) AS bigint) AS n_{c}" for c in names])
    return known.join(wrong, "fichier", "left")


RAW_CONFIG = {"operations": {"row_id": {"type": "int", "nullable": False}, "mer_force": {"type": "float", "checks": [{"less_than": 10}]}}}


def raw_types(spark, sf_dir) -> DataFrame:
    source = work_folder(spark, "raw")
    rows = damaged(spark, sf_dir).selectExpr(
        "row_id", "operation_id", "latitude", "vent_force", "mer_force", "systeme_source", "row_id % 2 = 0 AS pair",
        "CASE WHEN row_id % 3 = 0 THEN 'NA' ELSE cast(row_id AS string) END AS parfois", "'n/a' AS jamais", "cast(row_id AS string) || '.50' AS montant")
    sinks.export_csv(rows, f"{source}/operations.csv")
    table = etl.raw_load(spark, source, work_folder(spark, "rawtarget"), RAW_CONFIG)["operations"]
    sums = [f"cast(count(`{c}`) AS bigint) AS n_{i}" for i, c in enumerate(table.columns)]
    pairs = ", ".join(f"'{c}', '{k}', n_{i}" for i, (c, k) in enumerate(table.dtypes))
    return table.agg(*map(F.expr, sums)).selectExpr(f"stack({len(table.columns)}, {pairs}) AS (colonne, type, valeurs)")


def instants(spark, sf_dir) -> DataFrame:
    return etl.parse_instants(damaged(spark, sf_dir).select("row_id", ALERT), [ALERT])


# --- change capture ---------------------------------------------------------
def snapshots(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    old = spark.read.parquet(f"{sf_dir}/orders.parquet")
    touched = old.where("o_orderkey % 17 <> 0").withColumn(
        "o_orderpriority", F.expr("CASE WHEN o_orderkey % 10 = 0 THEN '9-NEW' ELSE o_orderpriority END")
    ).withColumn("o_orderstatus", F.expr("CASE WHEN o_orderkey % 30 <> 0 THEN o_orderstatus END"))
    added = old.where("o_orderkey % 23 = 0").withColumn("o_orderkey", F.expr("-o_orderkey - 1"))
    return old, touched.unionByName(added)


def diffed(spark, sf_dir) -> DataFrame:
    return C.snapshot_diff(*snapshots(spark, sf_dir), "o_orderkey").selectExpr(
        "* EXCEPT (changed_fields)", "array_join(changed_fields, ',') AS changed_fields"
    )


def bypassed(spark, sf_dir) -> DataFrame:
    old, new = snapshots(spark, sf_dir)
    return C.change_log({"operations": old}, {"operations": new}, {"operations": "o_orderkey"}, bulk_load=True).select(
        "table_name", "operation_type", "new_values"
    )


def upsert_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    base = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    delta = base.where("o_orderkey % 5 = 0").selectExpr(
        "CASE WHEN o_orderkey % 15 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey", "'U' AS o_orderstatus",
        "o_orderpriority", "CASE WHEN o_orderkey % 10 = 0 AND o_orderkey % 15 <> 0 THEN 'delete' ELSE 'write' END AS op",
    )
    return base, delta


def upserted(spark, sf_dir) -> DataFrame:
    return C.upsert(*upsert_tables(spark, sf_dir), "o_orderkey")


def stored_upsert(spark, sf_dir) -> DataFrame:
    """The same change in two deltas beside a stored table, the later one over the earlier."""
    root = work_folder(spark, "deltas")
    base, delta = upsert_tables(spark, sf_dir)
    versions.replace({"commandes": base}, root)
    keys = {"commandes": "o_orderkey"}
    early = delta.where("o_orderkey % 2 <> 0 OR o_orderkey < 0").withColumn("o_orderstatus", F.lit("X"))
    deltas.upsert({"commandes": early}, root, keys=keys)
    deltas.upsert({"commandes": delta}, root, keys=keys)
    return deltas.merged(spark, versions.current(spark, root), "commandes", "o_orderkey")


def stored_cascade(spark, sf_dir) -> DataFrame:
    """Cases deleted from three stored tables by one delta, a third of them in a first step."""
    root, every = work_folder(spark, "deltas"), tables(spark, sf_dir)
    sinks.full_refresh(every, root)
    for step in ("operation_id % 21 = 0", "operation_id % 7 = 0"):
        deltas.delete_cases(every["operations"].where(step), root)
    deltas.compact(spark, root, "flotteurs")
    data = FolderData(spark, root)
    return C.table_counts({n: data.table(n) for n in every})


def cascaded(spark, sf_dir) -> DataFrame:
    every = tables(spark, sf_dir)
    gone = every["operations"].where("operation_id % 7 = 0")
    return C.table_counts(C.delete_cases(every, gone))


def retained(spark, sf_dir) -> DataFrame:
    log = StarData(spark, sf_dir).audit()
    return C.retain(log, 20, "2024-02-01 00:00:00").select("id", "table_name", "operation_type", "new_values", "timestamp")


def retained_days(spark, sf_dir) -> DataFrame:
    """Two appends of the log by day, then one retention."""
    root, log = work_folder(spark, "log"), StarData(spark, sf_dir).audit()
    daily_log.append(log.where("id % 3 = 0"), root)
    daily_log.append(log.where("id % 3 <> 0"), root)
    daily_log.retain(spark, root, datetime(2024, 2, 1), 20)
    return daily_log.read(spark, root).select("id", "table_name", "operation_type", "new_values", "timestamp")


def orphaned(spark, sf_dir) -> DataFrame:
    data = StarData(spark, sf_dir)
    parents = data.cases("operation_id", "est_dans_stm").where("NOT est_dans_stm")
    return C.orphans(data.vessels("operation_id", "numero_ordre"), parents)


def related(spark, sf_dir) -> DataFrame:
    """Requests that bring a case with a short list of people; the people become rows."""
    requests = spark.read.parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "o_orderkey AS operation_id", "o_orderstatus AS zone_responsabilite",
        "transform(sequence(1L, o_orderkey % 3 + 1), i -> named_struct('categorie_personne',"
        " CASE WHEN i = 1 THEN 'Migrant' ELSE 'Autre' END, 'nombre', i * (o_custkey % 5))) AS resultats",
    )
    return C.split_nested(requests, {"resultats_humain": "resultats"})["resultats_humain"]


# --- joins ------------------------------------------------------------------
def range_join(spark, sf_dir) -> DataFrame:
    data = StarData(spark, sf_dir)
    months = roll_up(data, dated_cases(data), {"periode": BY_MONTH["periode"]}).selectExpr("periode", *named(nb_operations="n", total_personnes="imp"))
    return trailing_sums_by_join(months, ["nb_operations", "total_personnes"])


def left_fill(spark, sf_dir) -> DataFrame:
    data = StarData(spark, sf_dir)
    return attach_counters(data, data.cases("operation_id", "zone_responsabilite")).select(
        "operation_id", "zone_responsabilite", "nombre_impliques", "nombre_blesses"
    )


def scalar_share(spark, sf_dir) -> DataFrame:
    groups = R.grouped(StarData(spark, sf_dir).cases("evenement"), ["evenement"], "cast(count(1) AS bigint) AS n")
    return share_of_total(groups, "n", "part")


def active_semi(spark, sf_dir) -> DataFrame:
    """The centre list as a relation; its eleven rows are known to the planner."""
    names = spark.createDataFrame([(n,) for n in L.ACTIVE_CENTRES], "cross string")
    return StarData(spark, sf_dir).cases("operation_id", "cross").join(names, "cross", "left_semi")


# --- streams ----------------------------------------------------------------
def audit_stream(spark, sf_dir) -> DataFrame:
    out = work_folder(spark, "audit")
    log = audit_projection(jobs.file_stream(spark, f"{sf_dir}/events.parquet"), "table_name", "operation_type", "timestamp")
    jobs.run_audit_counts(log, f"{out}/counts", f"{out}/checkpoint").awaitTermination()
    return jobs.read_audit_counts(spark, f"{out}/counts")


def counter_stream(spark, sf_dir) -> DataFrame:
    out = work_folder(spark, "counters")
    people = person_projection(jobs.file_stream(spark, f"{sf_dir}/lineitem.parquet"))
    jobs.run_counters(people, f"{out}/partials", f"{out}/checkpoint", "folded").awaitTermination()
    return jobs.read_counters(spark, f"{out}/partials")


def monthly_stream(spark, sf_dir) -> DataFrame:
    """Cases and people as two streams; people come in files of their own, before and after their cases."""
    out, data = work_folder(spark, "monthly"), StarData(spark, sf_dir)
    cases = data.case_projection(jobs.file_stream(spark, f"{sf_dir}/orders.parquet"), "operation_id", ALERT)
    people = person_projection(jobs.file_stream(spark, f"{sf_dir}/lineitem.parquet"))
    jobs.run_monthly(cases, people, f"{out}/partials", f"{out}/checkpoint", "folded").awaitTermination()
    return V.monthly_rates(jobs.read_monthly(spark, f"{out}/partials"))


def followed_changes(spark, sf_dir, root: str) -> None:
    """Figures of an older state, brought to today's by the cases that a snapshot comparison names."""
    new = StarData(spark, sf_dir)
    today = new.cases(*incremental.COLUMNS)
    moved = today.where("operation_id % 37 = 0").withColumn(ALERT, F.expr(f"{ALERT} + interval 40 days")).withColumn("cross", F.lit("Ailleurs"))
    gone = today.where("operation_id % 41 = 0").withColumn("operation_id", -F.col("operation_id") - 1)
    before = today.where("operation_id % 29 <> 0 AND operation_id % 37 <> 0").unionByName(moved.where("operation_id % 29 <> 0")).unionByName(gone)
    people = new.persons()
    old = FrameData(spark, {"operations": before, "resultats_humain": people.where("operation_id % 43 <> 0")})
    incremental.store(old, root)
    changed = C.snapshot_diff(before, today, "operation_id").selectExpr("record_id AS operation_id")
    changed = changed.union(people.where("operation_id % 43 = 0").select("operation_id"))
    incremental.apply_changes(old, new, changed, root)


def incremental_months(spark, sf_dir) -> DataFrame:
    root = work_folder(spark, "figures")
    followed_changes(spark, sf_dir, root)
    return incremental.monthly_safety(spark, root)


def incremental_durations(spark, sf_dir) -> DataFrame:
    root = work_folder(spark, "figures")
    followed_changes(spark, sf_dir, root)
    return incremental.centre_durations(spark, root)


DATA = {
    "src_csv_scan": csv_scan,
    "src_table_scan": table_scan,
    "src_sql_params": bound_query,
    "src_column_subset": lambda s, d: files.existing(StarData(s, d).cases(), ["operation_id", "cross", "absente", "latitude"]),
    "sink_table_replace_append": replace_append,
    "sink_bulk_full_refresh": bulk_refresh,
    "sink_versions_rollback": rolled_back,
    "sink_valid_rejected_errors": three_outputs,
    "sink_csv_export": csv_export,
    "sink_view_export": lambda s, d: registry.export(StarData(s, d), "v_kpi_yoy_comparison"),
    "sink_export_bundle": bundle,
    "sink_materialize_refresh": materialized,
    "sink_facts_by_case_vessels": refreshed_by_case(V.vessel_analysis),
    "sink_facts_by_case_map": refreshed_by_case(V.case_map),
    "sink_incremental_refresh": incremental_months,
    "sink_incremental_durations": incremental_durations,
    "etl_merge_stats": merged,
    "etl_coerce_int": lambda s, d: etl.coerce_integers(damaged(s, d).select("row_id", "operation_id", "vent_force"), ["operation_id", "vent_force"]),
    "etl_coerce_int_report": lambda s, d: etl.lost_fractions(damaged(s, d), ["operation_id", "vent_force"]),
    "etl_parse_datetime": instants,
    "etl_blank_to_null": lambda s, d: etl.blank_to_missing(damaged(s, d).select("row_id", "type_operation", "systeme_source")),
    "etl_sample_children": sampled,
    "etl_audit_summary": lambda s, d: C.load_summary(tables(s, d)).select("table_name", "operation_type", "new_values", "user_id"),
    "etl_verify_counts": lambda s, d: C.table_counts(tables(s, d)),
    "etl_staged_load": staged,
    "etl_follow_parent": followed,
    "etl_loaded_tables": loaded_tables,
    "etl_raw_types": raw_types,
    "dq_file_headers": headers_of_files,
    "cdc_snapshot_diff": diffed,
    "cdc_etl_bypass": bypassed,
    "batch_upsert": upserted,
    "batch_upsert_deltas": stored_upsert,
    "delete_cascade": cascaded,
    "delete_cascade_deltas": stored_cascade,
    "audit_retention": retained,
    "audit_retention_days": retained_days,
    "fk_orphans": orphaned,
    "create_with_relations": related,
    "join_range_selfjoin": range_join,
    "join_left_fill": left_fill,
    "join_scalar_cross": scalar_share,
    "join_active_semi": active_semi,
    "data_dictionary": lambda s, d: E.data_dictionary(E.CASE, StarData(s, d).cases()),
    "list_projection": lambda s, d: E.list_projection(E.CASE, StarData(s, d).cases()),
    "stream_audit_counts": audit_stream,
    "stream_stats_refresh": counter_stream,
    "stream_monthly_kpi": monthly_stream,
}

QUERIES = {**QUALITY, **DATA}
