"""Fixed values of the register's data model and of the dashboard's questions.

These must equal what the register and its dashboard use for results to be right; they are
stated here once, as plain text, and imported by the operators and pipelines.
"""

# ---- Fixed values -------------------------------------------------------------------

# administrative status of an active establishment / legal unit
ACTIVE = "A"

# text shown for a missing attribute
MISSING = "N/A"

# separator of the "code - label" display text
CODE_LABEL_SEP = " - "

# length of a valid postal code
POSTAL_LENGTH = 5

# places kept by the clean-and-insert run when none are given
DEFAULT_PLACES = ("MARSEILLE", "AIX-EN-PROVENCE")

# place-name normalisation: characters turned into spaces, then (prefix → name) rules
PLACE_SEPARATORS = "-'"
PLACE_PREFIX_RULES = (
    ("MARSEILLE", "MARSEILLE"),
    ("AIX EN PROVENCE", "AIX-EN-PROVENCE"),
)

# dashboard and notebook questions
GROWTH_YEARS = 3           # revenue growth: latest year against this many years earlier
TOP_SECTORS = 5            # sectors shown by growth and by number of establishments
TOP_UNITS = 5              # units shown by latest revenue
TOP_LABELS = 10            # sector labels in the frequency and mean-revenue charts
TOP_PLACES = 10            # places in the frequency chart
HISTOGRAM_EDGES = 50       # log-spaced edges of the revenue histogram
FIRST_RECENT_YEAR = 2019   # creations "since" year

# register schema: columns kept by the cleaning runs, in this order
ESTABLISHMENT_COLUMNS = (
    "siret", "siren", "etatAdministratifEtablissement", "dateCreationEtablissement",
    "trancheEffectifsEtablissement", "anneeEffectifsEtablissement", "complementAdresseEtablissement",
    "numeroVoieEtablissement", "typeVoieEtablissement", "libelleVoieEtablissement",
    "codePostalEtablissement", "libelleCommuneEtablissement", "coordonneeLambertAbscisseEtablissement",
    "coordonneeLambertOrdonneeEtablissement",
)
LEGAL_UNIT_COLUMNS = (
    "siren", "denominationUniteLegale", "dateCreationUniteLegale", "activitePrincipaleUniteLegale",
    "categorieEntreprise", "anneeCategorieEntreprise", "trancheEffectifsUniteLegale",
    "anneeEffectifsUniteLegale", "etatAdministratifUniteLegale",
)
FINANCIAL_COLUMNS = ("siren", "date_cloture_exercice", "chiffre_d_affaires", "resultat_net")

# the register's interface: output columns → paths in its nested records (dotted paths are
# resolved into structs; a path that does not exist yields a typed null column)
ESTABLISHMENT_FIELDS = {
    c.lower(): ("periode." if c == "etatAdministratifEtablissement" else "adresseEtablissement." if at >= 6 else "") + c
    for at, c in enumerate(ESTABLISHMENT_COLUMNS)
    if c != "libelleCommuneEtablissement"
}
LEGAL_UNIT_FIELDS = {
    c.lower(): c
    for c in (*LEGAL_UNIT_COLUMNS[:-1], "nomenclatureActivitePrincipaleUniteLegale", LEGAL_UNIT_COLUMNS[-1])
}

# the sixteen columns of the merged ratios table
RATIO_COLUMNS = (
    "siren", "date_cloture_exercice", "chiffre_d_affaires", "marge_brute", "ebe", "ebit",
    "resultat_net", "taux_d_endettement", "ratio_de_liquidite", "ratio_de_vetuste",
    "autonomie_financiere", "poids_bfr_exploitation_sur_ca", "categorieEntreprise",
    "trancheEffectifsUniteLegale", "statutDiffusionUniteLegale", "dateCreationUniteLegale",
)

# address parts of the establishment card, in display order
ADDRESS_PARTS = (
    "complementadresseetablissement",
    "numerovoieetablissement",
    "typevoieetablissement",
    "libellevoieetablissement",
    "codepostaletablissement",
    "libellecommuneetablissement",
)
