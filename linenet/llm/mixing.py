"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linenet.llm.scratch import written

MAX_RATE = 2.0
LEVELS, BINS = 4, 256


def size_of(text: Column) -> Column:
    """The number of words; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def source_targets(totals: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """Add ``target`` to one row for each source with its ``source_size``.

    Sources in order of code points, null last, weigh ``weights`` in turn and share ``share`` of all sizes; no
    target is above twice its source's size, and what is cut off goes to the others by weight until none is
    above. The level this ends at is found from running sums over the sources in order of size per
    weight, so it takes no rounds. It is one ordered pass over the table of sources, one row each.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    wheel = F.array(*[F.lit(float(w)) for w in weights])
    told = totals.withColumn("weight", F.element_at(wheel, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    told = told.withColumn("limit", F.col("source_size") * MAX_RATE)
    rising = Window.orderBy((F.col("limit") / F.col("weight")), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    told = (
        told.withColumn("budget", F.sum("source_size").over(everything) * share)
        .withColumn("before", F.sum("limit").over(rising.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("limit"))
        .withColumn("left", F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("before")) / F.col("left"))
    )
    # The first source, in this order, whose limit is not met gives the common level.
    free = F.col("limit") > F.col("level") * F.col("weight")
    told = told.withColumn("place", F.row_number().over(rising))
    common = F.min(F.when(free, F.struct("place", "level"))).over(everything).getField("level")
    return told.withColumn("common", common).select(
        "source", "source_size", F.when(F.col("common").isNull(), F.col("limit")).otherwise(F.least("limit", F.col("common") * F.col("weight"))).alias("target")
    )


def _rate(tilt: Column, x: Column) -> Column:
    """A document's rate: the exponential tilt with a rate of at most two, one without a tilt."""
    return F.lit(MAX_RATE) / (1 + F.exp(-tilt * x))


def tilts(histogram: DataFrame, targets: DataFrame, rounds: int = 60, near: float = 1e-6) -> DataFrame:
    """``source`` key and ``tilt``: the solution of the convex dual, one number for each source.

    A document of size n in a source of mean size m gets the rate 2 / (1 + exp(-tilt * x)) with x = n / m
    (the exponential tilt under the bound that no document is taken more than twice); the dual's gradient
    is what these rates take less than the target. Each round is one join of the table of tilts with the distinct
    sizes of the sources and one sum for each source, and takes a Newton step kept inside a bracket
    that halves whenever the step would leave it. Rounds stop when every source is within ``near``.
    """
    histogram = histogram.where("size > 0")
    mean = histogram.groupBy("key").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = targets.join(mean, "key").select("key", "target", "mean", F.lit(0.0).alias("tilt"), F.lit(-60.0).alias("low"), F.lit(60.0).alias("high"))
    state = written(state, "tilts")
    for _ in range(rounds):
        x = F.col("size") / F.col("mean")
        rate = _rate(F.col("tilt"), x)
        sums = histogram.join(state, "key").groupBy("key").agg(
            F.sum(rate * F.col("size") * F.col("n")).alias("taken"),
            F.sum(rate * (1 - rate / MAX_RATE) * x * F.col("size") * F.col("n")).alias("slope"),
        )
        miss = F.col("target") - F.col("taken")
        step = F.col("tilt") + F.try_divide(miss, F.col("slope"))
        low = F.when(miss > 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(miss > 0, F.col("high")).otherwise(F.col("tilt"))
        told = state.join(sums, "key").withColumn("low2", low).withColumn("high2", high).withColumn("miss", miss / F.greatest("target", F.lit(1.0)))
        inside = F.coalesce((step > F.col("low2")) & (step < F.col("high2")), F.lit(False))
        done = F.abs("miss") <= near
        next_ = F.when(done, F.col("tilt")).when(inside, step).otherwise((F.col("low2") + F.col("high2")) / 2)
        told = told.select("key", "target", "mean", next_.alias("tilt"), F.col("low2").alias("low"), F.col("high2").alias("high"), done.alias("done"))
        told = written(told, "tilts")
        state = told.drop("done")
        if told.where(~F.col("done")).isEmpty():
            break
    return state.select("key", "mean", "tilt")


def _sized(docs: DataFrame) -> DataFrame:
    """Add size, hash and source key of every row; a null source has a key of its own."""
    spread = F.xxhash64("doc_id", "source", "text").bitwiseAND(F.lit((1 << 52) - 1))
    return docs.withColumns({
        "_size": size_of(F.col("text")),
        "_u": (spread + F.lit(0.5)) / float(1 << 52),
        "_key": F.concat(F.when(F.col("source").isNull(), F.lit("0")).otherwise("1"), F.coalesce("source", F.lit(""))),
    })


def _rated(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Add the columns of the plan, the rate, its whole part and the place among those that may get one more copy."""
    x = F.col("_size") / F.when(F.col("_mean") > 0, F.col("_mean")).otherwise(1.0)
    rate = F.when(F.col("_tilt").isNull(), F.lit(MAX_RATE)).otherwise(_rate(F.col("_tilt"), x))
    rated = sized.join(plan, "_key").withColumn("_rate", rate).withColumn("_whole", F.floor("_rate"))
    part = F.col("_rate") - F.col("_whole")
    return rated.withColumn("_place", F.when(part > 0, (1 + F.col("_u") - part) / 2))


def solve(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """One row for each source: ``_key``, ``_source_size``, ``_target``, ``_mean``, ``_tilt`` and ``_cut``.

    A source taken at twice its size has no tilt: all its rates are two. The cut is where the documents in order of
    their place stop getting one more copy.
    """
    sized = written(_sized(docs).select("_key", "_size", "_u"), "sizes")
    histogram = written(sized.groupBy(F.col("_key").alias("key"), F.col("_size").alias("size")).agg(F.count("*").alias("n")), "size-counts")
    totals = histogram.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    named = totals.withColumn("source", F.when(F.col("key").startswith("1"), F.substring("key", 2, 1 << 30)))
    targets = source_targets(named, weights, share).withColumn("key", F.concat(F.when(F.col("source").isNull(), "0").otherwise("1"), F.coalesce("source", F.lit(""))))
    targets = written(targets.drop("source"), "targets")
    tilted = targets.where(F.col("target") < F.col("source_size") * MAX_RATE)
    plan = targets.join(tilts(histogram, tilted), "key", "left").select(*[F.col(c).alias(f"_{c}") for c in ("key", "source_size", "target", "mean", "tilt")])
    plan = written(plan, "plan")
    cut = cuts(written(_rated(sized, plan).select("_key", "_target", "_whole", "_size", "_place"), "rates"))
    return written(plan.join(cut, "_key", "left"), "plan")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """All columns of every row, and ``_size``, ``_source_size``, ``_target``, ``_rate`` and ``_copies``.

    Rates solve the entropy balance of each source; a document is taken as often as the whole part of
    its rate, and once more if its hash comes before the source's cut. The cut is found in levels of a histogram,
    so that a source's words end within half of one document (or of rows that repeat one) of its
    target. A document without a word counts nothing in its source and has the rate of a tilt of zero, one
    (two where all rates are two); a null text is such a document. A null source is a source
    like any other, last in order. Hashes take ``doc_id``, text and source, so reruns agree and repeated rows are
    taken alike. No rows give no rows. Other columns stay; names that begin with an underscore are reserved.
    """
    rated = _rated(_sized(docs), solve(docs, weights, share))
    more = F.coalesce((F.col("_place") < F.col("_cut")).cast("long"), F.lit(0))
    return rated.withColumn("_copies", (F.col("_whole") + more).cast("long")).select(*docs.columns, "_size", "_source_size", "_target", "_rate", "_copies")


def cuts(rated: DataFrame) -> DataFrame:
    """``_key`` and ``_cut``: where the sizes before it come nearest to what whole copies leave open.

    Each level sums sizes in 256 bins of the interval still open in each source and keeps the bin where
    the sum passes the open words; only sums leave the tasks.
    """
    open_ = rated.groupBy("_key").agg((F.max("_target") - F.sum(F.col("_whole") * F.col("_size"))).alias("open"))
    state = written(open_.withColumn("low", F.lit(0.0)), "cuts")
    width = 1.0
    rows = rated.where("_place is not null").select("_key", "_place", "_size")
    for _ in range(LEVELS):
        width /= BINS
        bin_ = F.floor((F.col("_place") - F.col("low")) / width)
        sums = rows.join(state, "_key").withColumn("bin", bin_).where(F.col("bin").between(0, BINS - 1)).groupBy("_key", "bin").agg(F.sum("_size").alias("sum"))
        upto = Window.partitionBy("_key").orderBy("bin")
        passed = sums.join(state, "_key").withColumn("before", F.sum("sum").over(upto) - F.col("sum"))
        # The bin in which the open words run out, or else the last one with rows.
        chosen = passed.where("before < open").groupBy("_key").agg(F.max(F.struct("bin", "before", "sum")).alias("at"))
        state = state.join(chosen, "_key", "left").select(
            "_key",
            (F.col("open") - F.coalesce("at.before", F.lit(0))).alias("open"),
            (F.col("low") + F.coalesce("at.bin", F.lit(0)) * width).alias("low"),
            F.coalesce("at.sum", F.lit(0)).alias("last"),
        )
        state = written(state, "cuts")
    return state.select("_key", (F.col("low") + F.when(F.col("open") * 2 >= F.col("last"), F.lit(width)).otherwise(0.0)).alias("_cut"))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    told = mix(docs, weights, share).where("_copies > 0")
    return told.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*docs.columns)
