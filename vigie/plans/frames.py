"""Aggregations over an already extracted and filtered case frame, and page tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigie import labels as L
from vigie.functions import temporal as T
from vigie.functions.measures import ROWS, half_up, named, percent, round_even, total
from vigie.functions.outcomes import any_of, quoted
from vigie.operators import filters
from vigie.operators.counters import attach_counters
from vigie.operators.paging import largest, smallest
from vigie.operators.rollup import ALERT, dated_cases, grouped
from vigie.operators.series import fill_bins, share_of_total
from vigie.sources.dataset import RescueData


# --- extracts ---------------------------------------------------------------
def case_frame(data: RescueData, years_back: int = 0, start=None, anchor: date | str | None = None) -> DataFrame:
    """Dated cases with their counters, of all years unless a start is given.

    ``years_back`` counts from the day ``anchor``; an explicit start wins over it.
    """
    cases = dated_cases(data, ALERT, "type_operation", "cross", "departement", "latitude", "longitude", "evenement", "categorie_evenement")
    if start is not None:
        cases = filters.between_dates(cases, start)
    elif years_back > 0:
        if anchor is None:
            raise ValueError("years_back needs the day it counts from: anchor")
        cases = filters.since_years(cases, years_back, anchor)
    return attach_counters(data, cases).select(
        "operation_id", ALERT, "type_operation", "cross", "departement", "latitude", "longitude",
        "evenement", "categorie_evenement", "nombre_impliques", "nombre_saines_sauves",
        "nombre_decedes", "nombre_disparus", "nombre_blesses", "nombre_prises_en_compte",
    )


def light_case_frame(data: RescueData) -> DataFrame:
    return attach_counters(data, dated_cases(data, ALERT, "cross", "type_operation")).select(
        "operation_id", ALERT, "cross", "type_operation", "nombre_impliques",
        "nombre_saines_sauves", "nombre_decedes", "nombre_disparus",
    )


# --- aggregations -----------------------------------------------------------
def frame_figures(frame: DataFrame) -> DataFrame:
    """One row, zeros for an empty frame."""
    pairs = grouped(frame, ["cross", "departement"], *named(
        n=ROWS, imp=total("nombre_impliques"), ss=total("nombre_saines_sauves"),
        dec=total("nombre_decedes"), dis=total("nombre_disparus"), first=f"min({ALERT})", last=f"max({ALERT})",
    ))
    return pairs.agg(*map(F.expr, named(
        total_operations=total("n"), nb_cross="cast(count(DISTINCT cross) AS bigint)",
        nb_departements="cast(count(DISTINCT departement) AS bigint)", total_personnes=total("imp"),
        total_saines_sauves=total("ss"), total_decedes=total("dec"), total_disparus=total("dis"),
        premiere_operation="min(first)", derniere_operation="max(last)",
    )))


def frame_by_centre(frame: DataFrame) -> DataFrame:
    """The label for a missing centre is put on after grouping."""
    groups = grouped(frame, ["cross"], *named(
        total_operations=ROWS, total_personnes=total("nombre_impliques"), nombre_saines_sauves=total("nombre_saines_sauves"),
    ))
    labelled = groups.selectExpr(
        f"coalesce(cross, '{L.UNKNOWN_CENTRE}') AS cross", "total_operations", "total_personnes", "nombre_saines_sauves"
    )
    return labelled.orderBy(largest("total_operations"), "cross")


def frame_by_kind(frame: DataFrame) -> DataFrame:
    groups = grouped(frame, ["type_operation"], f"{ROWS} AS total")
    share = round_even("cast(total AS double) / cast(sum(total) OVER () AS double) * 100D", 2)
    return groups.selectExpr(
        "coalesce(type_operation, 'Autre') AS type_operation", "total", f"{share} AS pourcentage"
    ).orderBy(largest("total"), "type_operation")


STEPS = {"day": "1 day", "week": "7 days", "month": "1 month", "year": "1 year"}


def frame_timeline(frame: DataFrame, granularity: str = "month") -> DataFrame:
    """Every day, week (named by its closing Sunday), month or year, empty ones as 0."""
    unit = granularity if granularity in STEPS else "month"
    period = T.week_closing_sunday(ALERT) if unit == "week" else T.period_start(ALERT, unit)
    binned = grouped(frame, {"periode": period}, *named(
        total_operations=ROWS, total_personnes=total("nombre_impliques")
    ))
    return fill_bins(binned, "periode", STEPS[unit], ["total_operations", "total_personnes"]).orderBy("periode")


def frame_yearly(frame: DataFrame) -> DataFrame:
    return grouped(frame, {"annee": T.year_number(ALERT)}, *named(
        total_operations=ROWS, total_personnes=total("nombre_impliques"),
        nombre_saines_sauves=total("nombre_saines_sauves"), nombre_decedes=total("nombre_decedes"),
    )).orderBy(largest("annee"))


def frame_toll(frame: DataFrame) -> DataFrame:
    return frame.agg(*map(F.expr, named(
        total_saines_sauves=total("nombre_saines_sauves"), total_decedes=total("nombre_decedes"),
        total_disparus=total("nombre_disparus"), total_blesses=total("nombre_blesses"),
        total_impliques=total("nombre_impliques"),
    )))


def frame_toll_by_centre(frame: DataFrame) -> DataFrame:
    groups = grouped(frame, ["cross"], *named(
        saines_sauves=total("nombre_saines_sauves"), decedes=total("nombre_decedes"),
        disparus=total("nombre_disparus"), blesses=total("nombre_blesses"),
    ))
    label = f"coalesce(cross, '{L.UNKNOWN_CENTRE}') AS cross"
    return groups.selectExpr(label, "saines_sauves", "decedes", "disparus", "blesses").orderBy(
        largest("saines_sauves"), "cross"
    )


# --- page tables ------------------------------------------------------------
def severity_heatmap(months: DataFrame) -> DataFrame:
    """Year by month 1 to 12; months without data stay as empty columns."""
    pivot = months.groupBy("annee").pivot("mois", list(range(1, 13))).agg(F.avg("indice_gravite"))
    return pivot.select("annee", *[F.col(str(m)).alias(f"m{m:02d}") for m in range(1, 13)])


def wind_sea_matrix(profile: DataFrame) -> DataFrame:
    """Mean severity by wind force (rows) and sea force 0 to 9 (columns); ``mer_autre`` for other sea forces."""
    mean = half_up("sum(cast(round(indice_gravite * 1000D) AS bigint))", "count(indice_gravite) * 1000", 6)
    known = profile.where("vent_force IS NOT NULL AND mer_force IS NOT NULL AND indice_gravite IS NOT NULL")
    columns = [*map(str, range(10)), "autre"]
    sea = F.when(F.col("mer_force").isin(*range(10)), F.col("mer_force").cast("int").cast("string")).otherwise("autre")
    pivot = known.withColumn("mer", sea).groupBy("vent_force").pivot("mer", columns).agg(F.expr(mean))
    return pivot.select("vent_force", *[F.col(s).alias(f"mer_{s}") for s in columns])


def merge_categories(df: DataFrame, into: str = "Migrant/Clandestin") -> DataFrame:
    """Two names of one population become one."""
    merged = (
        f"CASE WHEN categorie_personne IN ('Clandestin', 'Migrant', 'Migrant/Clandestin')"
        f" THEN {quoted(into)} ELSE categorie_personne END"
    )
    return df.withColumn("categorie_personne", F.expr(merged))


def centre_category_matrix(centres: DataFrame) -> DataFrame:
    """People by centre and category, both names of one population merged, 0 where none.

    Categories beyond the list share the last column, so a row adds up to the people of its centre.
    """
    columns = [x for x in L.REFERENCE_LISTS["CATEGORIE_PERSONNE"] if x not in (L.ALL_CATEGORIES, "Clandestin")]
    columns.append(L.UNKNOWN_CATEGORY)
    merged = merge_categories(centres, "Migrant").where(F.col("categorie_personne") != L.ALL_CATEGORIES)
    listed = F.when(F.col("categorie_personne").isin(columns), F.col("categorie_personne")).otherwise(L.OTHER_CATEGORIES)
    pivot = merged.withColumn("categorie_personne", listed).groupBy("cross_name").pivot(
        "categorie_personne", [*columns, L.OTHER_CATEGORIES]).agg(F.sum("total_personnes"))
    return pivot.fillna(0)


def category_shares(counts: DataFrame) -> DataFrame:
    merged = grouped(merge_categories(counts), ["categorie_personne"], *named(
        total_personnes="cast(sum(total_personnes) AS bigint)", nb_operations="cast(sum(nb_operations) AS bigint)",
    ))
    return share_of_total(merged, "total_personnes", "part").orderBy(largest("total_personnes"), "categorie_personne")


def category_rates(rescue: DataFrame) -> DataFrame:
    """Rates over merged categories; an empty denominator counts as 1."""
    sums = ["nombre_saines_sauves", "nombre_prises_en_compte", "nombre_decedes", "nombre_disparus", "nombre_impliques"]
    merged = grouped(merge_categories(rescue), ["categorie_personne"], *named(
        **{s: f"cast(sum({s}) AS bigint)" for s in sums}
    ))
    handled = "CASE WHEN nombre_prises_en_compte = 0 THEN 1 ELSE nombre_prises_en_compte END"
    rate = round_even(f"cast(nombre_saines_sauves AS double) / cast({handled} AS double) * 100D", 2)
    return merged.selectExpr("*", f"{rate} AS taux_saines_sauves").orderBy("taux_saines_sauves", "categorie_personne")


def leading_category_trend(counts: DataFrame, first: int = 5) -> DataFrame:
    """Yearly series of the categories with most people overall."""
    totals = counts.where(F.col("categorie_personne") != L.ALL_CATEGORIES).groupBy("categorie_personne").agg(
        F.sum("total_personnes").alias("people")
    )
    leaders = totals.orderBy(largest("people"), smallest("categorie_personne")).limit(first)
    return counts.join(leaders, "categorie_personne", "left_semi")


def vessel_hierarchy(analysis: DataFrame, subtotals: bool = False) -> DataFrame:
    """Cases by class, type and fate; ``subtotals`` adds the upper levels.

    Groups with a missing label are left out, as in a drill-down chart.
    """
    keys = ["categorie_flotteur", "type_flotteur", "resultat_flotteur"]
    known = analysis.where(" AND ".join(f"{k} IS NOT NULL" for k in keys))
    level = known.rollup(*keys) if subtotals else known.groupBy(*keys)
    return level.agg(F.expr("cast(sum(nb_operations) AS bigint)").alias("nb_operations"))


def status_levels(df: DataFrame) -> DataFrame:
    """Traffic-light levels of the rescue rate, death rate and severity; unknown counts as 0."""
    return df.selectExpr("*", *named(
        statut_sauvetage="CASE WHEN coalesce(taux_saines_sauves, 0D) >= 98 THEN 'Excellent'"
        " WHEN coalesce(taux_saines_sauves, 0D) >= 95 THEN 'Attention' ELSE 'Critique' END",
        statut_mortalite="CASE WHEN coalesce(taux_mortalite, 0D) <= 1 THEN 'Normal'"
        " WHEN coalesce(taux_mortalite, 0D) <= 3 THEN 'Élevé' ELSE 'Critique' END",
        statut_gravite="CASE WHEN coalesce(indice_gravite, 0D) <= 0.05D THEN 'Faible'"
        " WHEN coalesce(indice_gravite, 0D) <= 0.1D THEN 'Modéré' ELSE 'Élevé' END",
    ))


def alert_counts(months: DataFrame) -> DataFrame:
    def periods(level: str) -> str:
        return f"count_if(niveau_alerte_victimes = '{level}' OR niveau_alerte_operations = '{level}')"

    return months.agg(*map(F.expr, named(
        nb_alertes=f"cast({periods('ALERTE')} AS bigint)", nb_attention=f"cast({periods('ATTENTION')} AS bigint)"
    )))


def radar_scores(benchmark: DataFrame) -> DataFrame:
    """Each centre's figures as a share of the best one; speed loses ten points an hour."""

    def score(column: str) -> str:
        return f"cast({column} AS double) / greatest(max({column}) OVER (), 1) * 100D"

    return benchmark.selectExpr("cross_name", *named(
        volume=score("nb_operations"), personnes=score("total_personnes"),
        saines_sauves=score("total_saines_sauves"), taux="coalesce(taux_saines_sauves, 0D)",
        rapidite="100D - least(coalesce(duree_mediane_heures, 0D) * 10D, 100D)",
    ))


def overview_means(benchmark: DataFrame) -> DataFrame:
    """Plain means over centres, exact in the last published digit."""

    def mean(column: str) -> str:
        return half_up(f"sum(cast(round({column} * 100D) AS bigint))", f"count({column}) * 100", 6)

    return benchmark.agg(*map(F.expr, named(
        nb_cross=ROWS, taux_moyen=mean("taux_saines_sauves"), duree_moyenne=mean("duree_mediane_heures"),
        total_operations=total("nb_operations"),
    )))


def outcome_shares(totals: DataFrame) -> DataFrame:
    """One row per outcome with its share of the people involved (at least one)."""
    parts = {"Saines et Sauves": "total_saines_sauves", "Blessés": "total_blesses", "Décédés": "total_decedes", "Disparus": "total_disparus"}
    pairs = ", ".join(f"{quoted(label)}, coalesce({column}, 0L)" for label, column in parts.items())
    rows = totals.selectExpr("coalesce(total_impliques, 0L) AS involved", f"stack({len(parts)}, {pairs}) AS (categorie, nombre)")
    return rows.selectExpr("categorie", "nombre", f"{percent('nombre', 'greatest(involved, 1L)', 1)} AS pourcentage")


def sport_totals(sports: DataFrame) -> DataFrame:
    sums = sports.agg(*map(F.expr, named(
        total_operations=total("nb_operations"), total_personnes=total("total_personnes"), total_decedes=total("total_decedes"),
    )))
    return sums.selectExpr("*", f"{percent('total_decedes', 'total_personnes')} AS taux_mortalite")


def audit_changes(log: DataFrame) -> DataFrame:
    """One row per changed field of each update: value before and after, '-' when unknown."""
    as_map = "map<string,string>"
    updates = log.where("operation_type = 'UPDATE' AND size(changed_fields) > 0")
    fields = updates.selectExpr(
        "id", f"from_json(old_values, '{as_map}') AS olds", f"from_json(new_values, '{as_map}') AS news",
        "explode(changed_fields) AS champ",
    )
    return fields.selectExpr(
        "id", "champ", "coalesce(try_element_at(olds, champ), '-') AS avant", "coalesce(try_element_at(news, champ), '-') AS apres"
    )


def month_labels(df: DataFrame, column: str = "mois") -> DataFrame:
    return df.withColumn("nom_mois", F.expr(f"coalesce(get(array{any_of(L.MONTH_LABELS)}, cast({column} - 1 AS int)), '')"))


def holiday_labels(df: DataFrame, column: str = "en_vacances") -> DataFrame:
    return df.withColumn("libelle", F.expr(f"CASE WHEN {column} THEN 'Vacances' ELSE 'Hors vacances' END"))
