from datetime import date, datetime

import pytest
from conftest import rows
from vigie.functions.outcomes import LITERAL
from vigie.operators.counters import case_counters
from vigie.plans import frames as P
from vigie.plans import reports as R
from vigie.plans import view_queries as Q
from vigie.plans import views as V

ALERT, END = "date_heure_reception_alerte", "date_heure_fin_operation"


def case(i, when=datetime(2020, 5, 1), **more):
    return {"operation_id": i, ALERT: when, "cross": "Corse", **more}


def person(i, outcome, n, category="Autre", injured=0):
    return {"operation_id": i, "resultat_humain": outcome, "nombre": n, "categorie_personne": category, "dont_nombre_blesse": injured}


def test_counters_cover_cases_without_outcomes_and_both_spellings(make_data):
    data = make_data(
        [case(1), case(2)],
        [person(1, "Personne assistée", 2), person(1, "Personne assistee", 3), person(1, "Personne décédée", 1, injured=1),
         person(1, "Personne indemne", 4), person(9, "Personne secourue", 50)],
    )
    got = {r["operation_id"]: r for r in rows(case_counters(data))}
    assert set(got) == {1, 2}
    assert (got[1]["nombre_assistees"], got[1]["nombre_saines_sauves"], got[1]["nombre_prises_en_compte"]) == (5, 5, 6)
    assert (got[1]["nombre_impliques"], got[1]["nombre_blesses"]) == (10, 1)
    assert all(v == 0 for k, v in got[2].items() if k != "operation_id")


def test_literal_spelling_splits_the_two_families(make_data):
    people = [person(1, "Personne assistée", 2), person(1, "Personne assistee", 3), person(1, "Personne decedee plus tard", 1)]
    data = make_data([case(1)], people, spelling=LITERAL)
    assert rows(case_counters(data))[0]["nombre_assistees"] == 2
    rescue = rows(V.category_rescue(data))[0]
    assert (rescue["nombre_saines_sauves"], rescue["nombre_decedes"]) == (3, 1)


def test_zero_denominator_gives_missing_rates(make_data):
    month = rows(V.monthly_safety(make_data([case(1)])))[0]
    assert (month["nb_operations"], month["taux_saines_sauves"], month["indice_gravite"]) == (1, None, None)


def test_undated_cases_stay_out_of_monthly_reports(make_data):
    assert V.monthly_safety(make_data([case(1, None)])).count() == 0


def test_benchmark_keeps_negative_durations_and_ties(make_data):
    data = make_data([
        case(1, datetime(2020, 1, 1, 10), **{END: datetime(2020, 1, 1, 9)}),
        case(2, datetime(2020, 1, 3, 9), **{END: datetime(2020, 1, 3, 12)}),
        case(3, datetime(2020, 1, 1, 0), cross="Corsen"),
        case(4, datetime(2020, 1, 1, 0), cross="Corsen"),
        case(5, cross=None),
    ])
    got = {r["cross_name"]: r for r in rows(V.centre_benchmark(data))}
    corse, corsen = got["Corse"], got["Corsen"]
    assert (corse["duree_min_heures"], corse["duree_max_heures"], corse["duree_mediane_heures"]) == (-1.0, 3.0, 1.0)
    assert (corse["rank_volume"], corsen["rank_volume"]) == (1, 1)
    assert (corsen["duree_mediane_heures"], corsen["rank_rapidite"]) == (None, 2)
    assert corse["operations_par_jour"] == 1.0  # 1 day and 23 hours count as 1 + 1 days
    assert len(got) == 2


def test_headline_ignores_negative_durations(make_data):
    data = make_data([
        case(1, datetime(2020, 1, 1, 10), **{END: datetime(2020, 1, 1, 9)}),
        case(2, datetime(2020, 1, 1, 10), **{END: datetime(2020, 1, 1, 10, 30)}),
        case(3, cross=None),
    ])
    one = rows(V.headline(data))[0]
    assert (one["duree_mediane"], one["nb_cross"], one["total_operations"]) == (30.0, 1, 3)


def test_a_case_with_two_vessels_counts_its_people_twice(make_data):
    boat = {"operation_id": 1, "type_flotteur": "Voilier", "categorie_flotteur": "Plaisance", "resultat_flotteur": "Assisté"}
    data = make_data([case(1, distance_cote_metres=10.0)], [person(1, "Personne secourue", 3)], [boat, dict(boat)])
    group = rows(V.vessel_analysis(data))[0]
    assert (group["nb_operations"], group["nb_flotteurs"], group["total_saines_sauves"]) == (1, 2, 6)
    assert (group["pct_operations"], group["distance_cote_moyenne_m"], group["personnes_par_operation"]) == (100.0, 10.0, 6.0)


def months(make_data, counts):
    cases, i = [], 0
    for when, n in counts:
        for _ in range(n):
            i += 1
            cases.append(case(i, when))
    return make_data(cases)


def test_alerts_use_calendar_months(make_data):
    counts = [(datetime(2019, 1, 5), 1), (datetime(2019, 2, 5), 3), (datetime(2019, 6, 5), 2), (datetime(2020, 2, 5), 9)]
    got = {r["periode"]: r for r in rows(V.anomalies(months(make_data, counts)))}
    first, second = got[date(2019, 1, 1)], got[date(2019, 2, 1)]
    assert (first["moyenne_operations"], first["zscore_operations"], first["niveau_alerte_operations"]) == (None, None, "NORMAL")
    assert (second["moyenne_operations"], second["zscore_operations"], second["niveau_alerte_operations"]) == (1.0, None, "NORMAL")
    june = got[date(2019, 6, 1)]
    assert (june["moyenne_operations"], june["ecart_operations"], june["zscore_operations"]) == (2.0, 0.0, 0.0)
    # February 2020 looks back to February 2019: January 2019 is out, missing months are not zeros
    last = got[date(2020, 2, 1)]
    assert (last["moyenne_operations"], last["ecart_operations"]) == (2.5, 6.5)
    assert last["niveau_alerte_operations"] == "ALERTE"


def test_alerts_of_one_centre_have_the_short_columns(make_data):
    data = months(make_data, [(datetime(2019, 1, 5), 1), (datetime(2019, 2, 5), 1)])
    assert Q.alerts(data, level="ALERTE", centre="Corse").count() == 2  # the level has no effect
    assert Q.alerts(data, centre="Corse").columns == Q.CENTRE_ALERT_COLUMNS


def test_missing_centre_and_its_literal_label(make_data):
    data = make_data([case(1, cross=None), case(2, cross="Non renseigné"), case(3)])
    assert {r["cross"]: r["total_operations"] for r in rows(R.by_centre(data))} == {"Non renseigné": 2, "Corse": 1}
    grouped_first = rows(P.frame_by_centre(P.case_frame(data, 0)))
    assert sorted((r["cross"], r["total_operations"]) for r in grouped_first) == [("Corse", 1), ("Non renseigné", 1), ("Non renseigné", 1)]


def test_missing_category_is_neither_kept_nor_left_out(make_data):
    data = make_data([case(1)], [
        person(1, "Personne secourue", 2, None), person(1, "Personne secourue", 3, "Migrant"), person(1, "Personne secourue", 5, "Autre"),
    ])
    month = rows(V.official_months(data))[0]
    assert month["total_personnes_sans_clandestins"] == 5
    assert month["total_clandestins_migrants"] == 3
    assert month["total_personnes_avec_clandestins"] == 10


def test_dominant_category_breaks_ties_by_name(make_data):
    data = make_data([case(1, latitude=1.0, longitude=2.0), case(2, latitude=95.0, longitude=2.0)], [
        person(1, "Personne secourue", 2, "Migrant"), person(1, "Personne secourue", 2, "Autre"),
        person(1, "Personne secourue", 2, None), person(2, "Personne secourue", 2),
    ])
    assert [(r["operation_id"], r["categorie_personne"], r["nb_personnes"]) for r in rows(V.case_map(data))] == [(1, "Autre", 2)]


def test_pivots_keep_what_is_beyond_their_columns(spark):
    weather = spark.createDataFrame([(3, 2, 1.0), (3, 12, 2.0), (3, 11, 4.0)], "vent_force long, mer_force long, indice_gravite double")
    row = rows(P.wind_sea_matrix(weather))[0]
    assert (row["mer_2"], row["mer_3"], row["mer_autre"]) == (1.0, None, 3.0)
    people = [("Corse", "Migrant", 2), ("Corse", "Clandestin", 3), ("Corse", "Autre", 4), ("Corse", "Inconnue au bataillon", 5), ("Corse", "Encore une", 6), ("Corse", "Toutes catégories", 20)]
    row = rows(P.centre_category_matrix(spark.createDataFrame(people, "cross_name string, categorie_personne string, total_personnes long")))[0]
    assert row["Migrant"] == 5 and row["Autres catégories"] == 11
    assert sum(v for k, v in row.items() if k != "cross_name") == 20


def test_years_back_needs_its_day(make_data):
    data = make_data([case(1, datetime(2001, 1, 1)), case(2, datetime(2020, 2, 12))])
    assert P.case_frame(data).count() == 2 and P.case_frame(data, 3, anchor="2021-01-01").count() == 1
    with pytest.raises(ValueError, match="anchor"):
        P.case_frame(data, 3)


def test_timeline_fills_empty_bins(make_data):
    data = make_data([case(1, datetime(2020, 1, 30, 23)), case(2, datetime(2020, 2, 12)), case(3, datetime(2020, 2, 12, 5))], [person(2, "Personne secourue", 4)])
    frame = P.case_frame(data, 0)
    weeks = [(r["periode"], r["total_operations"], r["total_personnes"]) for r in rows(P.frame_timeline(frame, "week"))]
    assert weeks == [(date(2020, 2, 2), 1, 0), (date(2020, 2, 9), 0, 0), (date(2020, 2, 16), 2, 4)]
    assert P.frame_timeline(frame, "day").count() == 14
    assert [r["periode"] for r in rows(P.frame_timeline(frame, "fortnight"))] == [date(2020, 1, 1), date(2020, 2, 1)]


def test_an_empty_frame_still_has_figures(make_data):
    frame = P.case_frame(make_data([]), 0)
    one = rows(P.frame_figures(frame))[0]
    assert (one["total_operations"], one["total_personnes"], one["premiere_operation"]) == (0, 0, None)
    assert P.frame_timeline(frame, "day").count() == 0


def test_unknown_ranking_metric_falls_back(make_data):
    data = make_data([case(1), case(2, cross="Corsen")])
    assert rows(Q.ranking(data, "humeur")) == rows(Q.ranking(data, "sauvetage"))


def test_top_cases_are_ranked_after_the_cut(make_data):
    data = make_data([case(i) for i in range(1, 6)], [person(i, "Personne secourue", 3) for i in range(1, 5)])
    got = rows(R.largest_cases(data, 2))
    assert [(r["operation_id"], r["rang"]) for r in got] == [(1, 1), (2, 2)]


def test_search_filters_and_pages(make_data):
    data = make_data([case(i, datetime(2020, 1, i), type_operation="SAR") for i in range(1, 8)],
                     [person(i, "Personne disparue", i) for i in range(1, 8)])
    found = rows(R.search_cases(data, kind="SAR", least_people=3, victims=True, limit=2, offset=1))
    assert [r["operation_id"] for r in found] == [6, 5]
    assert R.search_cases(data, victims=False).count() == 0
    assert rows(R.case_page_with_count(data, 0, 3, kind="SAR"))[0]["total"] == 7


def test_last_day_counts_only_at_midnight(make_data):
    data = make_data([case(1, datetime(2020, 1, 31)), case(2, datetime(2020, 1, 31, 0, 1))])
    assert rows(R.period_figures(data, date(2020, 1, 1), date(2020, 1, 31)))[0]["total_operations"] == 1
