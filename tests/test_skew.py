"""A third of all rows on one key: results stay whole and equal to brute force."""

from collections import Counter, defaultdict

import pytest

from conftest import rows
from vigie.operators import changes as C
from vigie.operators import quality as Q
from vigie.operators.counters import case_counters
from vigie.plans import reports as R
from vigie.plans import views as V
from vigie.sources.dataset import FrameData

N = 30000


@pytest.fixture(scope="module")
def skewed(spark):
    ids = spark.range(N)
    key = "CASE WHEN id % 3 = 0 THEN 7L ELSE id % 2000 END"
    persons = ids.selectExpr(
        f"{key} AS operation_id", "concat('c', id % 4) AS categorie_personne",
        "CASE WHEN id % 5 = 0 THEN 'Personne disparue' ELSE 'Personne secourue' END AS resultat_humain",
        "id % 6 AS nombre", "id % 2 AS dont_nombre_blesse",
    )
    vessels = ids.selectExpr(
        f"{key} AS operation_id", "id % 9 AS numero_ordre", "concat('t', id % 3) AS type_flotteur", "'Autre' AS categorie_flotteur",
        "'Français' AS pavillon", "'Assisté' AS resultat_flotteur",
    )
    cases = spark.range(2500).selectExpr(
        "id AS operation_id", "CASE WHEN id % 3 = 0 THEN 'Corse' ELSE concat('n', id % 5) END AS cross", "'SAR' AS type_operation",
        "timestamp_ntz '2020-01-01 00:00:00' + make_dt_interval(cast(id % 700 AS int)) AS date_heure_reception_alerte",
        "timestamp_ntz '2020-01-01 00:00:00' + make_dt_interval(cast(id % 700 AS int), 0, cast(id % 300 AS int)) AS date_heure_fin_operation",
        "1.5D AS latitude", "2.5D AS longitude", "10D AS distance_cote_metres", "1D AS distance_cote_milles_nautiques",
    )
    return FrameData(spark, {"operations": cases, "resultats_humain": persons, "flotteurs": vessels})


def test_counters(skewed):
    expected = defaultdict(lambda: [0, 0])
    for i in range(N):
        key = 7 if i % 3 == 0 else i % 2000
        expected[key][0] += i % 6
        expected[key][1] += (i % 6) * (i % 5 == 0)
    got = {r["operation_id"]: [r["nombre_impliques"], r["nombre_disparus"]] for r in rows(case_counters(skewed))}
    assert len(got) == 2500 and all(got[k] == expected[k] for k in got)


def test_vessels_and_children(skewed):
    groups = rows(V.vessel_analysis(skewed))
    assert sum(g["nb_flotteurs"] for g in groups) == N
    pairs = {(7 if i % 3 == 0 else i % 2000, i % 3) for i in range(N)}
    assert Counter(t for _, t in pairs) == {int(g["type_flotteur"][1]): g["nb_operations"] for g in groups}
    assert R.cases_with_children(skewed).count() == 2 * N + 2500 - len({k for k, _ in pairs})


def test_dominant_category(skewed):
    sums = defaultdict(lambda: defaultdict(int))
    for i in range(N):
        sums[7 if i % 3 == 0 else i % 2000][f"c{i % 4}"] += i % 6
    expected = {k: min(v.items(), key=lambda kv: (-kv[1], kv[0])) for k, v in sums.items()}
    got = {r["operation_id"]: (r["categorie_personne"], r["nb_personnes"]) for r in rows(V.case_map(skewed))}
    assert got == expected


def test_duplicates_and_cascade(skewed, spark):
    persons = skewed.persons()
    flagged = Q.flag(persons, Q.RuleSet({}, [], ["operation_id"]))
    keys = Counter(7 if i % 3 == 0 else i % 2000 for i in range(N))
    assert Q.rejected_rows(flagged).count() == sum(n for n in keys.values() if n > 1)
    left = C.delete_cases({"resultats_humain": persons}, spark.createDataFrame([(7,)], "operation_id long"))
    assert left["resultats_humain"].count() == N - keys[7]
