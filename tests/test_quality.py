import pytest

from conftest import rows
from vigie import labels as L
from vigie.operators import entities as E
from vigie.operators import quality as Q
from vigie.plans import etl


def bad(df, *rules, unique=()):
    """Number of failed checks per row, in row order of ``i``."""
    flagged = Q.flag(df, Q.RuleSet({}, list(rules), list(unique)))
    return [r["n"] for r in rows(flagged.orderBy("i").selectExpr("size(failures) AS n"))]


def table(spark, schema, *records):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(records)], "i int, " + schema)


@pytest.mark.parametrize("kind,good,wrong", [
    ("int", "12", "douze"), ("float", "1.5", "x"), ("bool", "true", "peut-être"), ("datetime", "2020-01-01 00:00:00", "hier"),
])
def test_types(spark, kind, good, wrong):
    df = table(spark, "c string", (good,), (wrong,), (None,))
    rules = Q.rules_from_config({"c": {"type": kind}})
    assert bad(df, *rules.rules) == [0, 1, 0]


def test_unknown_type_is_an_error():
    with pytest.raises(KeyError):
        Q.rules_from_config({"c": {"type": "decimal"}})


def test_declared_checks(spark):
    config = {
        "age": {"type": "int", "checks": [{"greater_than": 0}, {"less_than": 100}]},
        "status": {"type": "str", "checks": [{"isin": ["actif", "l'autre"]}]},
        "prix": {"type": "float", "check": "(0 <= x) & (x <= 10)"},
        "nom": {"type": "str", "nullable": False},
    }
    df = table(spark, "age string, status string, prix string, nom string",
               ("25", "actif", "1", "a"), ("0", "l'autre", "10", "b"), ("100", "perdu", "10.5", None), (None, None, None, "c"))
    assert bad(df, *Q.rules_from_config(config).rules) == [0, 1, 4, 0]


def test_duplicates_are_all_marked_missing_values_too(spark):
    df = table(spark, "id string", ("1",), ("2",), ("2",), (None,), (None,), ("3",))
    assert bad(df, unique=["id"]) == [0, 1, 1, 1, 1, 0]


def test_expression_checks_let_only_plain_comparisons_through():
    for text in ("__import__('os')", "x; drop", "exp(x) > 1"):
        with pytest.raises(ValueError):
            Q.expression_rule("c", "float", text)


def test_top_level_isin_is_inert_unless_asked_for():
    config = {"c": {"type": "str", "isin": ["a"]}}
    assert Q.rules_from_config(config).rules == []
    assert len(Q.rules_from_config(config, top_level_isin=True).rules) == 1


def test_split_partitions_the_rows(spark):
    df = table(spark, "id string, nom string", ("1", "Alice"), ("invalid", "Bob"), ("3", "Charlie"))
    rules = Q.rules_from_config({"id": {"type": "int"}, "nom": {"type": "str"}})
    flagged = Q.flag(df, rules)
    assert [r["nom"] for r in rows(Q.valid_rows(flagged).orderBy("i"))] == ["Alice", "Charlie"]
    assert [r["nom"] for r in rows(Q.rejected_rows(flagged))] == ["Bob"]
    assert rows(Q.failure_cases(flagged, "i")) == [{"i": 1, "column": "id", "check": "type(int)", "value": "invalid"}]


def test_a_whole_number_with_a_point_is_an_integer(spark):
    df = table(spark, "id string", ("12.0",), ("12.5",), ("7",))
    flagged = Q.flag(df, Q.rules_from_config({"id": {"type": "int", "check": "x > 10"}}))
    assert [r["id"] for r in rows(Q.valid_rows(flagged))] == ["12.0"]


def test_fail_fast(spark):
    rules = Q.rules_from_config({"i": {"type": "int"}, "age": {"type": "int", "check": "x >= 0"}}, strict=True)
    good = table(spark, "age string", ("1",))
    assert Q.require_valid(good, rules) is good
    with pytest.raises(Q.QualityError, match="age"):
        Q.require_valid(table(spark, "age string", ("1",), ("-1",)), rules)
    with pytest.raises(Q.QualityError, match="unexpected"):
        Q.require_valid(table(spark, "age string, surplus string", ("1", "x")), rules)


def test_required_rejects_blank(spark):
    df = table(spark, "nom string", ("a",), ("  ",), (None,), ("",))
    assert bad(df, Q.required_rule("nom")) == [0, 1, 1, 1]


def test_coordinates(spark):
    pair = table(spark, "latitude double, longitude double", (48.8566, 2.3522), (None, None), (48.8566, None))
    assert bad(pair, Q.coordinates_pair()) == [0, 0, 1]
    zone = table(spark, "latitude double, longitude double", (48.8566, 2.3522), (-21.1151, 55.5364), (40.7128, -74.0060), (None, 2.0), (50.0, None))
    flagged = Q.flag(zone, Q.RuleSet({}, [Q.coordinates_zone()]), blocking=False)
    assert [r["n"] for r in rows(flagged.orderBy("i").selectExpr("size(failures) n"))] == [0, 0, 1, 0, 0]


def test_scales_and_formats(spark):
    wind = table(spark, "vent_force int", (0,), (12,), (13,), (-1,), (None,))
    assert bad(wind, Q.beaufort()) == [0, 0, 1, 1, 0]
    sea = table(spark, "mer_force int", (0,), (9,), (10,), (None,))
    assert bad(sea, Q.douglas()) == [0, 0, 1, 0]
    place = table(spark, "departement string", ("29",), ("974",), ("2A",), ("Finistère",), ("",), (None,))
    assert bad(place, Q.department_format()) == [0, 0, 0, 1, 0, 0]


def test_outcome_needs_people_and_length_fits(spark):
    outcome = table(spark, "resultat_humain string, nombre long", ("Sauvé", 5), ("Sauvé", 0), (None, 0), ("", 0), ("Décédé", None))
    assert bad(outcome, Q.outcome_needs_people()) == [0, 1, 0, 0, 1]
    length = table(spark, "type_flotteur string, longueur double", ("Canoe/Kayak", 4.0), ("Canoe/Kayak", 10.0), ("Jet-ski", None), ("Voilier", 50.0))
    assert bad(length, Q.length_fits_type()) == [0, 1, 0, 0]


def test_unknown_values_are_warnings(spark):
    df = table(spark, "status string", ("actif",), ("inconnu",), ("inconnu",), (None,), ("",))
    assert rows(Q.unknown_values(df, "status", ["actif", "inactif"])) == [{"valeur": "inconnu", "lignes": 2, "colonne": "status"}]


def test_reference_lists_block_only_when_strict(spark):
    df = table(spark, "operation_id string, type_operation string", ("1", "ABC"), ("0", "SAR"))
    assert bad(df, *E.case_rules(df.columns, strict=True).rules) == [1, 1]
    loose = [r for r in E.case_rules(df.columns).rules if r.blocking]
    assert bad(df, *loose) == [0, 1]


def test_field_metadata():
    assert (len(E.CASE.fields), len(E.VESSEL.fields), len(E.PERSON.fields)) == (42, 8, 6)
    assert [f.name for f in E.CASE.listed()] == ["operation_id", "date_heure_reception_alerte", "type_operation", "cross", "departement"]
    assert E.CASE.get("maree_coefficient").low == 20 and E.CASE.get("absent") is None


def test_report_of_a_frame(spark):
    df = table(spark, "operation_id string, departement string, type_operation string", ("1", "29", "SAR"), (None, "29999", "XXX"))
    got = {(r["niveau"], r["colonne"], r["controle"]) for r in rows(Q.quality_report(df, E.field_rules(E.CASE, df.columns), E.reference_lists(E.CASE, df.columns)))}
    assert got == {("error", "operation_id", "required"), ("error", "departement", "max_length(3)"), ("warning", "type_operation", "isin")}


def test_source_declarations():
    assert {k: len(v) for k, v in etl.CONFIG.items()} == {"flotteurs": 7, "operations_stats": 16, "operations": 26, "resultats_humain": 5}
    assert etl.CONFIG["flotteurs"]["resultat_flotteur"]["checks"][0]["isin"][0] == "Difficulté surmontée, reprise de route"
    assert len(etl.CONFIG["flotteurs"]["resultat_flotteur"]["checks"][0]["isin"]) == 16
    assert etl.CONFIG["operations_stats"]["phase_journee"]["isin"][-1] == ""
    assert etl.CONFIG["resultats_humain"]["categorie_personne"]["checks"][0]["isin"] == L.REFERENCE_LISTS["CATEGORIE_PERSONNE"]


def test_integers_and_blanks(spark):
    df = table(spark, "n string, t string", ("12", " "), ("12.0", "a"), ("1.5", None), ("x", ""), ("9007199254740993", "b"), (None, None))
    assert [r["n"] for r in rows(etl.coerce_integers(df, ["n"]).orderBy("i"))] == [12, 12, None, None, 9007199254740993, None]
    assert rows(etl.lost_fractions(df, ["n", "absent"])) == [{"colonne": "n", "non_entiers": 1}]
    assert [r["t"] for r in rows(etl.blank_to_missing(df).orderBy("i"))] == [None, "a", None, None, "b", None]
