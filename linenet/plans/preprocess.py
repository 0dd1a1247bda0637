"""From raw segments and manholes of many cities to one clean segment table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import presets as P
from ..functions import geometry as geo
from ..functions import values as val
from ..operators import cleaning as cl
from ..operators import lookups as lk
from ..operators import rules as ru
from ..operators.nearest import attach_endpoints
from ..operators.schema import dedupe_columns, keep_columns


@dataclass(frozen=True)
class Lookups:
    """Recode tables ``(key, value)`` and class edges."""

    material: DataFrame
    effluent: DataFrame
    diameter: DataFrame
    age_edges: Sequence[float]
    age_labels: Sequence[str]
    depth_edges: Sequence[float]
    depth_labels: Sequence[str]


def node_depths(segments: DataFrame, manholes: DataFrame, key: str, partition: Sequence[str] = ()) -> DataFrame:
    """Levels of the nearest manholes, the plausibility tests and the mean depth."""
    fields = {"radier": "invert", "tn": "ground", "prof": "depth"}
    near = attach_endpoints(
        segments, manholes, fields, key, "mh_id", P.NODE_DISTANCE, numeric=list(fields), partition=partition
    )
    tested = ru.plausibility(near, "radier", "tn")
    return ru.mean_depth(tested, "prof", "radier", "tn", out="profondeur_moy", method="methode_calcul")


def clean_segments(df: DataFrame, lookups: Lookups) -> DataFrame:
    """Clean, recode, classify and repair unified segments.

    ``df`` has the unified attributes, ``geom``, ``Ville``, ``profondeur_moy`` and the
    node levels ``radier_up/down`` and ``tn_up/down``. Everything but the recodes, which
    join small tables, is one pass of column work without a shuffle.
    """
    out = df.withColumn("longueur_calc", F.round(geo.line_length(F.col("geom")), 3))
    out = out.filter(F.col("longueur_calc") >= P.MIN_SEGMENT_LENGTH)
    out = cl.coerce_numeric(out, P.NUMERIC_ATTRIBUTES)
    out = out.withColumns(
        {
            "X_centroid": val.mean_strict(F.col("X_amont"), F.col("X_aval")),
            "Y_centroid": val.mean_strict(F.col("Y_amont"), F.col("Y_aval")),
        }
    )
    texts = [c for c in ("Materiau", "Nature_effluent", "Diametre", "Age", "nom_rue", "id_regard_am", "id_regard_av")]
    out = cl.nullify_tokens(out, P.NULL_TOKENS, texts)
    for c, lookup in (("Materiau", lookups.material), ("Nature_effluent", lookups.effluent)):
        out = cl.nullify_tokens(lk.recode(out, c, lookup), P.UNKNOWN_LABELS, [c])
    # Trimmed text and number are columns of their own, so that each is worked out once.
    out = out.withColumns({"_text0": val.trim_text(F.col("Diametre")), "_number": val.to_double(F.col("Diametre"))})
    shortest = val.number_text(F.col("_text0"), F.col("_number"), P.NULL_TOKENS)
    out = out.withColumn("Diametre", shortest).drop("_text0", "_number")
    out = lk.recode(cl.nullify_tokens(out, P.NULL_TOKENS, ["Diametre"]), "Diametre", lookups.diameter, "_raw")
    out = out.withColumn("_mm", val.to_double(F.col("_raw"))).drop("_raw")
    out = out.withColumn("Diametre_clean", val.within(F.col("_mm"), *P.DIAMETER_RANGE)).drop("_mm")
    out = cl.zero_to_null(out, P.NUMERIC_ATTRIBUTES, keep=P.ZERO_IS_VALID)
    out = out.withColumn("taux_arbo", val.within(F.col("taux_arbo"), high=P.MAX_RATE))
    out = ru.age_class(out, "Age", lookups.age_edges, lookups.age_labels, "Age_extracted", "classe_age")
    out = ru.depth_fallback(
        out, lookups.depth_edges, lookups.depth_labels, "profondeur_moy", ("Prof_Amont", "Prof_Aval"),
        ("File_amont", "File_aval"), "Cote_TN", ("Cote_TN_am", "Cote_TN_av"), "Profondeur_finale", "classe_profondeur",
    )
    out = ru.slope_rules(out, "File_amont", "File_aval", "Pente", "Longueur", fill=("radier_up", "radier_down"))
    out = cl.labels_to_null(out, "classe_age", P.EXTREME_AGE_CLASSES)
    out = cl.labels_to_null(out, "classe_profondeur", P.EXTREME_DEPTH_CLASSES)
    return out


def network_nodes(cleaned: DataFrame, key: str) -> DataFrame:
    """Manholes the segments name, first mention first, with a dense index."""
    return ru.extract_nodes(
        cleaned,
        {"id_node": "id_regard_am", "tn": "tn_up", "radier": "radier_up", "x": "X_amont", "y": "Y_amont"},
        {"id_node": "id_regard_av", "tn": "tn_down", "radier": "radier_down", "x": "X_aval", "y": "Y_aval"},
        key,
    )


def finished(cleaned: DataFrame, key: str) -> DataFrame:
    """The columns of the finished segment table."""
    kept = [a for a in P.UNIFIED_ATTRIBUTES if a not in P.DROPPED_ATTRIBUTES]
    return dedupe_columns(keep_columns(cleaned, [key, *kept, *P.DERIVED_COLUMNS, "geom"]))


def preprocess_segments(
    segments: DataFrame, manholes: DataFrame, lookups: Lookups, key: str, partition: Sequence[str] = ()
) -> DataFrame:
    """The whole chain as one lazy plan: valid lines, node levels and depths, cleaning.

    ``finished`` and ``network_nodes`` both start from its result; write it first if both
    are wanted.
    """
    valid = cl.filter_valid_lines(segments, P.MIN_LINE_LENGTH)
    cleaned = clean_segments(node_depths(valid, manholes, key, partition), lookups)
    # Repeated vertices change neither ends nor length, so shapes are tidied last and once.
    return cleaned.withColumn("geom", geo.clean_vertices(F.col("geom")))
