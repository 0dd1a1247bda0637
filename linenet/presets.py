"""Names, tokens and limits of the pipe-network domain."""

from __future__ import annotations

from dataclasses import dataclass

# Text that stands for a missing value (exact match).
NULL_TOKENS = [
    "INCONNU", "Inconnu", "inconnu", "None", "nan", "nan.0", " ", "", "NULL", "null", "NC", "ND",
]

# Tokens that a recode table may itself return for "unknown".
UNKNOWN_LABELS = ["INCONNU", "inconnu", "None", "nan"]

# The unified attributes of the segment layer.
UNIFIED_ATTRIBUTES = [
    "Nature_effluent", "Diametre", "Longueur", "Materiau", "Age", "File_amont", "File_aval",
    "Cote_TN_am", "Cote_TN_av", "Cote_TN", "Pente", "Prof_Amont", "Prof_Aval",
    "id_regard_am", "id_regard_av", "nom_rue", "id_troncon",
    "X_amont", "Y_amont", "X_aval", "Y_aval", "taux_arbo", "taux_imper",
]

# The attributes that hold measures.
NUMERIC_ATTRIBUTES = [
    "Longueur", "File_amont", "File_aval", "Cote_TN_am", "Cote_TN_av", "Cote_TN", "Pente",
    "Prof_Amont", "Prof_Aval", "X_amont", "Y_amont", "X_aval", "Y_aval", "taux_arbo", "taux_imper",
]

# Measures where zero is a true reading.
ZERO_IS_VALID = ["taux_arbo", "taux_imper", "Pente"]

# Columns left out of the finished segment table.
DROPPED_ATTRIBUTES = ["id_troncon", "nom_rue", "Longueur", "Age", "Diametre"]

# Derived columns of the finished segment table.
DERIVED_COLUMNS = [
    "Ville", "Profondeur_finale", "Age_extracted", "longueur_calc", "classe_age",
    "Diametre_clean", "classe_profondeur", "X_centroid", "Y_centroid",
]

# Limits of plausible measures.
MIN_LINE_LENGTH = 0.001
MIN_SEGMENT_LENGTH = 1.0
NODE_DISTANCE = 2.0
DIAMETER_RANGE = (100.0, 1500.0)
MAX_RATE = 100.0
MAX_DEPTH = 10.0
MAX_SLOPE = 10.0
SLOPE_TOLERANCE = 0.01
YEAR_FLOOR = 1880
BUFFER_RADIUS = 5.0
EXTREME_AGE_CLASSES = ["1", "6"]
EXTREME_DEPTH_CLASSES = ["1", "5"]
COMMON_SRID = 2154

# Texts the plausibility and depth rules write.
FLAG_SLOPE = "PENTE_NEGATIVE; "
FLAG_GROUND_UP = "TN<RADIER_AMONT; "
FLAG_GROUND_DOWN = "TN<RADIER_AVAL; "
METHOD_DEPTHS = "MOYENNE_PROFONDEURS"
METHOD_LEVELS = "CALCUL_TN_RADIER"
METHOD_DOUBT = "_DONNEES_DOUTEUSES"

# Labels of coded classes.
AGE_RANGES = {2: "1950-1970", 3: "1970-1990", 4: "1990-2010", 5: "2010-2025"}
TARGET_VALUES = [1, 2, 3, 4]
FILLED_CATEGORY = "INCONNU"
SOURCE_ORIGINAL = "original"
SOURCE_PREDICTED = "predit_"
SOURCE_EXCLUDED = "non_predit_incomplet"

# Learning settings.
NEIGHBOURS_IMPUTE = 7
NEIGHBOURS_SMOTE = 5
TEST_SHARE = 0.2
VALIDATION_SHARE = 0.15
FOLDS = 3
SEED = 42
COMPLETE_MATERIAL = 0.7
COMPLETE_STATE = 0.5
MIN_LABEL_CONFIDENCE = 0.70


@dataclass(frozen=True)
class StateLevel:
    """One way of grouping the condition states 1..4."""

    name: str
    column: str
    labels: tuple[str, ...]
    offset: int  # added to a predicted code to give the written value


STATE_LEVELS = (
    StateLevel("niveau_1_multiclasse", "EDS_n1", ("Bon", "Moyen", "Mauvais", "Tres mauvais"), 1),
    StateLevel("niveau_2_isolation_4", "EDS_n2", ("Non critique", "Tres mauvais"), 0),
    StateLevel("niveau_3_bon_vs_degrade", "EDS_n3", ("Bon", "Degrade"), 0),
)

# Search spaces of the learners, in the names of Spark's own parameters.
# Depth 30 is the deepest tree Spark grows, so deeper or unlimited depths map to it.
SEARCH_SPACES = {
    "forest": {
        "numTrees": [200, 400, 800, 1200, 1600],
        "maxDepth": [20, 30],
        "minInstancesPerNode": [1, 2, 3],
        "featureSubsetStrategy": ["sqrt", "0.3", "0.4"],
        "subsamplingRate": [0.8, 0.9, 1.0],
    },
    "extra_trees": {
        "numTrees": [800, 1200, 1600, 2000],
        "maxDepth": [20, 30],
        "minInstancesPerNode": [1, 2, 3],
        "featureSubsetStrategy": ["sqrt", "0.2", "0.3", "0.4"],
    },
    "boosting": {
        "maxIter": [500, 1000, 2000, 3000],
        "stepSize": [0.01, 0.03, 0.05, 0.1],
        "maxDepth": [4, 6, 8, 10],
        "subsamplingRate": [0.7, 0.8, 0.9],
    },
    "adaboost": {
        "rounds": [20, 40, 60, 100, 200, 500, 1000],
        "learningRate": [0.01, 0.05, 0.1, 0.5, 1.0],
    },
    "tree": {
        "maxDepth": [5, 10, 15, 20, 30],
        "minInstancesPerNode": [1, 2, 5, 10, 20],
        "impurity": ["gini", "entropy"],
    },
}
