"""Consistency rules for levels, depths, slopes and ages; the order of steps matters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import presets as P
from ..functions import values as val
from ..session import scratch_path
from ..sources.tables import checkpoint_table
from .ordering import dense_index, first_by


def _less(a: str, b: str):
    """Strictly less, false where either side is missing."""
    return F.coalesce(F.col(a) < F.col(b), F.lit(False))


def plausibility(df: DataFrame, invert: str = "invert", ground: str = "ground") -> DataFrame:
    """Three test flags and the text of the failed tests."""
    iu, idn, gu, gd = f"{invert}_up", f"{invert}_down", f"{ground}_up", f"{ground}_down"
    have_invert = {iu, idn} <= set(df.columns)
    have_ground = have_invert and {gu, gd} <= set(df.columns)
    slope_bad = _less(iu, idn) if have_invert else F.lit(False)
    up_bad = _less(gu, iu) if have_ground else F.lit(False)
    down_bad = _less(gd, idn) if have_ground else F.lit(False)
    return df.withColumns(
        {
            "test_invert": ~slope_bad,
            "test_ground": ~(up_bad | down_bad),
            "test_depth": F.lit(True),
            "alert": val.flag_text(
                [(slope_bad, P.FLAG_SLOPE), (up_bad, P.FLAG_GROUND_UP), (down_bad, P.FLAG_GROUND_DOWN)]
            ),
        }
    )


def mean_depth(
    df: DataFrame, depth: str = "depth", invert: str = "invert", ground: str = "ground",
    out: str = "mean_depth", method: str = "method",
) -> DataFrame:
    """Depth from both node depths, else from both level differences; null if a test failed."""
    missing = F.lit(None).cast("double")

    def field(name: str):
        return F.col(name) if name in df.columns else missing

    both = val.mean_strict(field(f"{depth}_up"), field(f"{depth}_down"))
    levels = val.mean_strict(
        field(f"{ground}_up") - field(f"{invert}_up"), field(f"{ground}_down") - field(f"{invert}_down")
    )
    passed = F.col("test_invert") & F.col("test_ground")
    name = F.when(both.isNotNull(), F.lit(P.METHOD_DEPTHS)).when(levels.isNotNull(), F.lit(P.METHOD_LEVELS)).otherwise(F.lit(""))
    return df.withColumns(
        {
            out: F.when(passed, F.coalesce(both, levels)),
            method: F.concat(name, F.when(passed, F.lit("")).otherwise(F.lit(P.METHOD_DOUBT))),
        }
    )


def depth_fallback(
    df: DataFrame, edges: Sequence[float], labels: Sequence[str], measured: str, own: tuple[str, str],
    water: tuple[str, str], ground: str, ground_ends: tuple[str, str],
    out: str = "depth_final", klass: str = "depth_class",
) -> DataFrame:
    """First depth available, its class, and only then the range check."""
    level = val.mean_strict(F.col(water[0]), F.col(water[1]))
    ends = val.mean_strict(F.col(ground_ends[0]), F.col(ground_ends[1]))
    chain = F.coalesce(
        F.col(measured), val.mean_skip_null(F.col(own[0]), F.col(own[1])), F.col(ground) - level, ends - level
    )
    with_depth = df.withColumn(out, chain)
    return with_depth.withColumn(klass, val.cut(F.col(out), edges, labels, right=True)).withColumn(
        out, val.within(F.col(out), 0.0, P.MAX_DEPTH, low_open=True)
    )


def slope_rules(
    df: DataFrame, up: str, down: str, slope: str, length: str, fill: tuple[str, str] | None = None
) -> DataFrame:
    """Repair slopes against the levels at both ends.

    A slope that is one level over the length is a failed computation and dropped; then
    missing slopes are computed, signs follow the fall, and extremes are dropped.
    """
    if fill:
        df = df.withColumns({up: F.coalesce(F.col(up), F.col(fill[0])), down: F.coalesce(F.col(down), F.col(fill[1]))})
    a, b, s, n = F.col(up), F.col(down), F.col(slope), F.col(length)
    long = n > 0

    def failed(level, other):
        theory = F.abs(level / val.zero_to_null(n) * 100)
        return s.isNotNull() & level.isNotNull() & (other.isNull() | (other == 0)) & long & (
            F.abs(F.abs(s) - theory) < P.SLOPE_TOLERANCE
        )

    for cond, value in (
        (failed(a, b), F.lit(None).cast("double")),
        (failed(b, a), F.lit(None).cast("double")),
        (s.isNull() & a.isNotNull() & b.isNotNull() & (b != 0) & long, (a - b) / val.zero_to_null(n) * 100),
        ((a > b) & (s < 0), F.abs(s)),
        ((a < b) & (s > 0), -F.abs(s)),
        (F.abs(s) > P.MAX_SLOPE, F.lit(None).cast("double")),
    ):
        df = df.withColumn(slope, F.when(cond, value).otherwise(s))
    return df


def age_class(
    df: DataFrame, source: str, edges: Sequence[float], labels: Sequence[str],
    year: str = "install_year", klass: str = "age_class",
) -> DataFrame:
    """Installation year from mixed text and its class, left-closed."""
    text = val.nullify(val.trim_text(F.col(source)), P.NULL_TOKENS)
    dated = df.withColumn("_text", text).withColumn(year, val.year_of_date(F.col("_text"))).drop("_text")
    return dated.withColumn(klass, val.cut(F.col(year), edges, labels, right=False))


def stack_ends(df: DataFrame, up: dict[str, str], down: dict[str, str], order: str) -> DataFrame:
    """Both ends of every segment as rows, upstream ends first, in one scan."""
    ends = [
        F.struct(F.lit(i).alias("_side"), *[F.col(c).alias(name) for name, c in cols.items()])
        for i, cols in enumerate((up, down))
    ]
    return df.select(F.col(order).alias("_order"), F.inline(F.array(*ends)))


def extract_nodes(df: DataFrame, up: dict[str, str], down: dict[str, str], order: str, index: str = "node_index") -> DataFrame:
    """First row per node id, upstream ends before downstream ones, with a dense index."""
    stacked = stack_ends(df, up, down, order).filter(F.col("id_node").isNotNull())
    nodes = first_by(stacked, ["id_node"], [F.asc("_side"), F.asc("_order")]).drop("_side", "_order")
    # Written once: the index reads its input twice, and this one ends a long chain.
    nodes = checkpoint_table(nodes.withColumn("id_node", F.col("id_node").cast("string")), scratch_path(df.sparkSession, "nodes"))
    return dense_index(nodes, "id_node", index)
