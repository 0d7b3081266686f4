"""Domain vocabulary: French labels carried by the data, written as they appear there."""

from __future__ import annotations

from itertools import product

# ---------------------------------------------------------------------------
# Texts and thresholds that must match the data to the letter.
# ---------------------------------------------------------------------------
ACTIVE_CENTRES = [
    "Antilles-Guyane",
    "Corse",
    "Corsen",
    "Étel",
    "Etel",
    "Gris-Nez",
    "Jobourg",
    "La Garde",
    "Nouvelle-Calédonie",
    "Polynésie",
    "Sud océan Indien",
]

RESCUED = "Personne secourue"
ASSISTED = "Personne assistée"
FOUND = "Personne retrouvée"
MISSING = "Personne disparue"
DEAD = "Personne décédée"
DEAD_ACCIDENT = "Personne décédée accidentellement"
DEAD_NATURAL = "Personne décédée naturellement"
SELF_RESCUED = "Personne tirée d'affaire seule"
FALSE_ALARM = "Personne impliquée dans fausse alerte"

UNKNOWN_CENTRE = "Non renseigné"
UNKNOWN_CATEGORY = "Non renseigné"
ALL_CATEGORIES = "Toutes catégories"
OTHER_CATEGORIES = "Autres catégories"
NON_OFFICIAL_CATEGORIES = ["Clandestin", "Migrant"]
NO_FILTER = ("Tous", "Tous les CROSS")

WATER_SPORTS = [
    "Kitesurf",
    "Canoe/Kayak",
    "Planche a voile",
    "Jet-ski",
    "Ski nautique",
    "Engin de plage",
]
MAX_LENGTH_BY_TYPE = {
    "Canoe/Kayak": 6.0,
    "Jet-ski": 5.0,
    "Planche a voile": 5.0,
    "Kitesurf": 3.0,
    "Engin de plage": 4.0,
    "Ski nautique": 3.0,
}

# latitude min, latitude max, longitude min, longitude max
FRENCH_ZONES = {
    "metropole": (41, 51, -5, 10),
    "antilles": (14, 18, -64, -60),
    "reunion": (-22, -20, 54, 56),
    "polynesie": (-25, -10, -155, -130),
    "nouvelle_caledonie": (-23, -19, 163, 169),
    "mayotte": (-14, -12, 44, 46),
    "guyane": (2, 6, -55, -51),
}
MAP_ZONES = {
    "France métropolitaine": (41, 51.5, -5.5, 10),
    "Manche / Mer du Nord": (48, 52, -2, 5),
    "Atlantique": (43, 48, -6, 0),
    "Méditerranée": (41, 44, 3, 10),
    "Antilles-Guyane": (2, 18, -64, -50),
    "Réunion / Mayotte": (-25, -10, 40, 60),
    "Polynésie / Nouvelle-Calédonie": (-25, -10, 155, 180),
    "Monde entier": None,
}
MAP_CATEGORY_GROUPS = {
    "Migrant/Clandestin": ["Migrant", "Clandestin", "Migrant/Clandestin"],
    "Plaisancier/Loisirs": ["Plaisancier français", "Pratiquant loisirs nautiques"],
    "Pêcheur": ["Pêcheur français", "Pêcheur amateur"],
    "Commerce": ["Commerce français"],
    "Marin étranger": ["Marin étranger"],
    "Autre/Non renseigné": ["Autre", "Non renseigné", "Toutes catégories"],
}
MONTH_LABELS = ["Jan", "Fév", "Mar", "Avr", "Mai", "Jun", "Jul", "Aoû", "Sep", "Oct", "Nov", "Déc"]
ALERT_LEVELS = (("ALERTE", 2.5), ("ATTENTION", 1.5))
CALM = "NORMAL"

# Reference lists (informative unless a rule set makes them strict)
REFERENCE_LISTS = {
    "TYPE_OPERATION": ["SAR", "MAS", "DIV", "SUR", "POL"],
    "CROSS_VALUES": [
        "Gris-Nez", "Jobourg", "Corsen", "Etel", "La Garde", "Corse",
        "Antilles-Guyane", "Nouvelle-Caledonie", "Polynesie", "Sud ocean Indien",
        "Adge", "La Reunion", "Martinique", "Mayotte", "Soulac",
    ],
    "RESULTAT_HUMAIN": [
        "Personne assistee", "Personne decedee", "Personne disparue",
        "Personne retrouvee", "Personne secourue",
        "Sain et sauf", "Blesse", "Decede", "Disparu", "Retrouve", "Assiste", "Inconnu",
    ],
    "CATEGORIE_PERSONNE": [
        "Autre", "Plaisancier français", "Pratiquant loisirs nautiques", "Migrant",
        "Clandestin", "Commerce français", "Marin étranger", "Pêcheur français",
        "Pêcheur amateur", "Toutes catégories",
    ],
    "RESULTAT_FLOTTEUR": [
        "ASSISTE", "AU_MOUILLAGE", "A_LA_DERIVE", "COULE", "DESECHOUE", "DETRUIT",
        "DIFFICULTE_SURMONTEE_SEUL", "ECHOUE", "FAUSSE_ALERTE", "IMMOBILISE_DANS_ENGIN",
        "INCONNU", "NON_ASSISTE", "NON_RETROUVE", "PERDU_VOLE", "REMORQUE", "RENFLOUE",
        "REPRISE_DE_ROUTE", "RETROUVE_APRES_RECHERCHE", "TIRE_DAFFAIRE_SEUL",
    ],
    "TYPE_FLOTTEUR": [
        "Aeronef", "Canoe/Kayak", "Commerce", "Navire a passagers", "Peche",
        "Plaisance a voile", "Plaisance a moteur", "Ski nautique", "Planche a voile",
        "Kitesurf", "Jet-ski", "Engin de plage", "Annexe", "Voilier", "Autre",
    ],
    "VENT_DIRECTION_CATEGORIE": [
        "nord", "nord-est", "est", "sud-est", "sud", "sud-ouest", "ouest", "nord-ouest",
    ],
    "SYSTEME_SOURCE": ["secmarweb", "seamis_json"],
    "PHASE_JOURNEE": ["Nuit", "Aube", "Matin", "Apres-midi", "Soir", "Crepuscule"],
    "MAREE_CATEGORIE": ["Morte-eau", "Moyenne", "Vive-eau"],
    "PREFECTURE_MARITIME": ["Atlantique", "Manche et mer du Nord", "Mediterranee"],
}
# ---------------------------------------------------------------------------
# End of fixed values
# ---------------------------------------------------------------------------

DEATHS = [DEAD, DEAD_ACCIDENT, DEAD_NATURAL]
SAFE = [RESCUED, ASSISTED, FOUND]
OFFICIAL = [*SAFE, MISSING, *DEATHS]


def plain(text: str) -> str:
    """The spelling without acute accents used by one of the two source systems."""
    return text.replace("é", "e")


def spellings(text: str) -> list[str]:
    """Every spelling of ``text`` that differs only by dropped acute accents."""
    choices = [("é", "e") if ch == "é" else (ch,) for ch in text]
    return ["".join(c) for c in product(*choices)]
