import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

CASE_COLUMNS = (
    "operation_id long, type_operation string, sous_type_operation string, cross string, departement string,"
    " est_metropolitain boolean, zone_responsabilite string, latitude double, longitude double, evenement string,"
    " categorie_evenement string, vent_direction_categorie string, vent_force long, mer_force long,"
    " date_heure_reception_alerte timestamp_ntz, date_heure_fin_operation timestamp_ntz, est_jour_ferie boolean,"
    " est_vacances_scolaires boolean, phase_journee string, distance_cote_metres double,"
    " distance_cote_milles_nautiques double, est_dans_stm boolean, est_dans_dst boolean, prefecture_maritime string,"
    " maree_coefficient long, maree_categorie string"
)
VESSEL_COLUMNS = (
    "operation_id long, numero_ordre long, type_flotteur string, categorie_flotteur string, pavillon string,"
    " resultat_flotteur string"
)
PERSON_COLUMNS = (
    "operation_id long, categorie_personne string, resultat_humain string, nombre long, dont_nombre_blesse long"
)


@pytest.fixture(scope="session")
def spark():
    from vigie.session import local_session

    session = local_session("tests", 4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def rows(df):
    """Rows as plain dicts."""
    return [r.asDict(recursive=True) for r in df.collect()]


def frame(spark, schema, records):
    """A frame from dicts; columns that a dict leaves out are missing values."""
    names = [part.split()[0] for part in schema.split(",")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], schema)


@pytest.fixture(scope="session")
def make_data(spark):
    from vigie.functions.outcomes import FOLDED
    from vigie.sources.dataset import FrameData

    def build(cases, persons=(), vessels=(), spelling=FOLDED):
        return FrameData(
            spark,
            {
                "operations": frame(spark, CASE_COLUMNS, cases),
                "resultats_humain": frame(spark, PERSON_COLUMNS, persons),
                "flotteurs": frame(spark, VESSEL_COLUMNS, vessels),
            },
            spelling,
        )

    return build
