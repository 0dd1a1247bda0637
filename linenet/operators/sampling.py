"""Seeded splits with exact class counts, and synthetic minority rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.tables import checkpoint_table
from .neighbours import nearest_rows
from .profiles import class_counts

# Rows of a class are put in the order of a hash of their id. The hash is even, so its
# first three hex digits cut any class, however large, into 4096 equal buckets.
DIGITS = 3


def row_hash(seed: int, id_col: str) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string")))


def hash_cuts(
    df: DataFrame, label: str, id_col: str, seed: int, ranks: Sequence[Column], plan: DataFrame | None = None
) -> DataFrame:
    """Per class, the hash and id at which each wanted rank is reached, as ``cut_0``, ``cut_1``, ...

    A rank is an expression over the class size ``n`` and, if given, the columns of a
    plan that has one row per class, the class named ``_pl``. Counting per bucket finds the
    bucket a rank falls in; only the rows of those buckets are put in order. A row is
    then placed by comparing its hash with the cuts. Buckets and cuts are written: both are a few rows
    per class, and a join that knows their size need not gather all rows of a class in one task.
    """
    spark = df.sparkSession
    keyed = df.select(F.col(label).alias("_label"), row_hash(seed, id_col).alias("_h"), F.col(id_col).cast("string").alias("_id"))
    keyed = keyed.withColumn("_bucket", F.substring("_h", 1, DIGITS))
    counts = keyed.groupBy("_label", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    whole, upto = Window.partitionBy("_label"), Window.partitionBy("_label").orderBy("_bucket")
    placed = counts.select(
        "_label", "_bucket", "_n", F.sum("_n").over(whole).alias("n"),
        (F.sum("_n").over(upto) - F.col("_n")).alias("_before"),
    )
    if plan is not None:
        placed = placed.join(plan, F.col("_label") == F.col("_pl"))
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), r.cast("bigint").alias("r")) for i, r in enumerate(ranks)])
    falls = placed.withColumn(
        "_want", F.filter(wanted, lambda w: (w["r"] > F.col("_before")) & (w["r"] <= F.col("_before") + F.col("_n")))
    ).filter(F.size("_want") > 0)
    falls = falls.select(F.col("_label").alias("_fl"), F.col("_bucket").alias("_fb"), "_before", "_want")
    falls = checkpoint_table(falls, scratch_path(spark, "falls"))
    near = keyed.join(falls, F.col("_label").eqNullSafe(F.col("_fl")) & (F.col("_bucket") == F.col("_fb")))
    order = Window.partitionBy("_label", "_bucket").orderBy("_h", "_id")
    ranked = near.withColumn("_rank", F.row_number().over(order) + F.col("_before"))
    hits = ranked.select("_label", "_rank", F.struct("_h", "_id").alias("_cut"), F.explode("_want").alias("_w"))
    hits = hits.filter(F.col("_w.r") == F.col("_rank"))
    cuts = hits.groupBy("_label").agg(
        *[F.max(F.when(F.col("_w.i") == i, F.col("_cut"))).alias(f"cut_{i}") for i in range(len(ranks))]
    )
    return checkpoint_table(cuts, scratch_path(spark, "cuts"))


def _placed(df: DataFrame, label: str, id_col: str, seed: int, cuts: DataFrame) -> DataFrame:
    mine = F.struct(row_hash(seed, id_col).alias("_h"), F.col(id_col).cast("string").alias("_id"))
    return df.withColumn("_mine", mine).join(cuts, F.col(label).eqNullSafe(F.col("_label")), "left")


def stratified_split(df: DataFrame, label: str, share: float, id_col: str, seed: int, out: str = "is_test") -> DataFrame:
    """Flag ``round(share * n)`` rows of every class."""
    cuts = hash_cuts(df, label, id_col, seed, [F.round(F.col("n") * share)])
    placed = _placed(df, label, id_col, seed, cuts)
    return placed.withColumn(out, F.coalesce(F.col("_mine") <= F.col("cut_0"), F.lit(False))).select(*df.columns, out)


def stratified_folds(df: DataFrame, label: str, k: int, id_col: str, seed: int, out: str = "fold") -> DataFrame:
    """Fold 0..k-1 of every row, each class cut into k parts of equal size."""
    cuts = hash_cuts(df, label, id_col, seed, [F.floor(F.col("n") * j / k) for j in range(1, k)])
    fold = sum((F.coalesce(F.col("_mine") > F.col(f"cut_{j}"), F.lit(True)).cast("int") for j in range(k - 1)), F.lit(0))
    return _placed(df, label, id_col, seed, cuts).withColumn(out, fold).select(*df.columns, out)


def smote_plan(df: DataFrame, label: str, targets: Mapping | None = None) -> DataFrame:
    """Rows to make per class: ``each`` for every row, and one more for the first ``extra`` rows.

    Without targets every class is raised to the largest one. Classes of a single row
    have no neighbour and stay as they are.
    """
    counts = class_counts(df, label)
    if targets is None:
        goal = counts.agg(F.max("n").alias("m")).scalar()
    else:
        goal = F.col("n")
        for cls, wanted in targets.items():
            goal = F.when(F.col(label) == F.lit(cls), F.lit(int(wanted))).otherwise(goal)
    plan = counts.withColumn("make", F.when(F.col("n") > 1, F.greatest(goal - F.col("n"), F.lit(0))).otherwise(F.lit(0)))
    return plan.select(
        label, "n", F.col("make").cast("bigint").alias("make"),
        F.floor(F.col("make") / F.col("n")).alias("each"), (F.col("make") % F.col("n")).cast("bigint").alias("extra"),
    )


def smote(
    df: DataFrame, label: str, cols: Sequence[str], id_col: str, k: int, seed: int, targets: Mapping | None = None
) -> DataFrame:
    """Synthetic rows ``(base_id, copy, label, features)`` between a row and one of its neighbours.

    Draws are spread evenly over the rows of a class, so a row knows its own copies and
    no join by random position is needed. Neighbour and gap come from a hash of seed, row
    and copy: the same input always gives the same rows.
    """
    plan = smote_plan(df, label, targets).filter("make > 0")
    todo = plan.select(F.col(label).alias("_pl"), "each", "extra")
    minority = df.join(plan.select(label), label, "left_semi")
    cuts = hash_cuts(minority, label, id_col, seed, [F.col("extra")], todo)
    placed = _placed(minority, label, id_col, seed, cuts).join(todo, F.col(label) == F.col("_pl"))
    bonus = F.coalesce(F.col("_mine") <= F.col("cut_0"), F.lit(False)).cast("bigint")
    bases = placed.withColumn("_copies", F.col("each") + bonus).filter("_copies > 0").select(id_col, label, *cols, "_copies")
    around = nearest_rows(bases, minority, cols, k, id_col, group=label)
    # At most k neighbours per row.
    packed = around.groupBy(F.col("query_id").alias("_q")).agg(
        F.sort_array(F.collect_list(F.struct("rank", "features"))).alias("_near")
    )
    block = F.col("_block") * 1000
    copies = (
        bases.join(packed, F.col(id_col) == F.col("_q"))
        .withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_copies") - 1) / 1000))))
        .withColumn("copy", F.explode(F.sequence(block, F.least(block + 999, F.col("_copies") - 1))))
    )
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string"), F.col("copy").cast("string")))

    def number(at: int) -> Column:
        return F.conv(F.substring(draw, at, 7), 16, 10).cast("bigint")

    chosen = copies.withColumn("_to", F.get("_near", (number(1) % F.size("_near")).cast("int"))["features"])
    chosen = chosen.withColumn("_gap", number(9) / float(16**7))
    return chosen.select(
        F.col(id_col).alias("base_id"), "copy", label,
        *[(F.col(c) + F.col("_gap") * (F.get("_to", F.lit(i)) - F.col(c))).alias(c) for i, c in enumerate(cols)],
    )
