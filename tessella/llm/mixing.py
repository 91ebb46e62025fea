"""Mix sources to target weights by weighted sampling with exponential keys; all native."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessella.llm.common import WORD, broadcast_checked, cut, prefix_sums


def words(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def sampling_key(doc_id: Column, weight: Column, seed: int) -> Column:
    """Efraimidis-Spirakis key: an exponential draw, fixed by id and seed, over the weight.
    A weight that is null, not positive or not a number counts as 1."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("none"))).cast("binary"))
    draw = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(2**52))
    usable = F.when((weight > 0) & ~F.isnan(weight), weight).otherwise(F.lit(1.0))
    return -F.log(draw) / usable


def source_targets(sizes: DataFrame, cycle: tuple[float, ...], total: float, most: float) -> DataFrame:
    """``source, source_size, target`` from ``sizes (source, source_size)``.

    Sources in code-point order, null last, weigh as ``cycle`` says, repeating.  They share
    ``total`` times the sum of all sizes by weight; no target exceeds ``most`` times its source,
    and what is above goes to the others by weight.  The level at which that settles is found in
    one pass over the sources, sorted by how soon they are full.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, cycle)), (F.col("nth") % len(cycle) + 1).cast("int"))
    ranked = sizes.withColumn("nth", F.row_number().over(place) - 1).withColumn("w", weight.cast("double"))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    full = Window.orderBy(F.col("cap") / F.col("w"), "nth")
    before, everything = full.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (
        F.lit(float(total)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    ) / (F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    levels = ranked.withColumn("level", level)
    # the first source that the level before it does not fill sets the level of all that follow
    settled = F.min(F.when(F.col("level") * F.col("w") < F.col("cap"), F.struct("nth_full", "level"))).over(everything)
    levels = levels.withColumn("nth_full", F.row_number().over(full)).withColumn("at", settled["level"])
    target = F.when(F.col("at").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("at") * F.col("w")))
    return levels.select("source", "source_size", target.alias("target"))


def mixing_plan(rows: DataFrame, cycle: tuple[float, ...] = (3, 1, 2), total: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source from ``rows (doc_id, source, size, key)``: ``source, source_size,
    target, epochs, last``.

    ``epochs`` complete passes come first.  What the target leaves is drawn in order of the keys
    until the budget is met: a document belongs to the draw while at least half of it fits, so
    the sum misses the target by half a document at most.  ``last`` is the last document drawn;
    all up to it, in order of (key, doc_id, size), are drawn.  Equal rows share a place: they are
    drawn together.
    """
    groups = cut(rows.groupBy("source", "key", "doc_id", "size").agg(F.count("*").alias("copies")))
    mass = F.col("size") * F.col("copies")
    sizes = groups.groupBy("source").agg(F.sum(mass).alias("source_size"))
    targets = cut(source_targets(sizes, cycle, total, most))
    start = Window.orderBy(F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(1))
    targets = targets.withColumn("epochs", epochs.cast("long")).withColumn(
        "rest", F.col("target") - F.col("epochs") * F.col("source_size")
    ).withColumn("start", F.coalesce(F.sum("source_size").over(start), F.lit(0)))
    known = broadcast_checked(targets.select(F.col("source").alias("s"), "rest", "start"))
    order = [F.col("source").asc_nulls_last(), F.col("key"), F.col("doc_id"), F.col("size"), F.col("copies")]
    placed = prefix_sums(groups, order, {"before": mass}).join(known, F.col("source").eqNullSafe(F.col("s")))
    drawn = placed.where((F.col("rest") > 0) & (F.col("before") - F.col("start") + mass / 2 <= F.col("rest")))
    last = drawn.groupBy("source").agg(F.max(F.struct("key", "doc_id", "size")).alias("last"))
    last = last.withColumnRenamed("source", "s")
    return targets.join(last, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "source_size", "target", "epochs", "last"
    )


def apply_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with ``source_size, target, passes``: how often the mix takes each document."""
    plan = broadcast_checked(plan.withColumnRenamed("source", "_source"))
    here = F.struct("key", "doc_id", "size")
    drawn = F.when(F.col("last").isNotNull() & (here <= F.col("last")), 1).otherwise(0)
    return (
        rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("passes", (F.col("epochs") + drawn).cast("long"))
        .drop("_source", "epochs", "last")
    )


def keyed(docs: DataFrame, weights: DataFrame, seed: int = 1) -> DataFrame:
    """``docs`` with ``size`` and ``key``; ``weights (doc_id, weight)`` has a row per id at most."""
    weights = weights.select(F.col("doc_id").alias("_id"), F.col("weight").alias("_weight"))
    joined = docs.withColumn("size", words(F.col("text"))).join(weights, F.col("doc_id") == F.col("_id"), "left")
    key = sampling_key(F.col("doc_id"), F.col("_weight"), seed)
    return joined.withColumn("key", key).drop("_id", "_weight")


def quality_weights(labels: DataFrame) -> DataFrame:
    """``doc_id, weight``: 2 for documents labelled good, 0.5 for bad ones; others weigh 1."""
    good = F.max("quality")
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.when(good == 1, 2.0).when(good == 0, 0.5).otherwise(1.0).alias("weight")
    )


def mix(docs: DataFrame, weights: DataFrame, seed: int = 1, **shares) -> DataFrame:
    """``doc_id, source, size, source_size, target, passes, taken`` for every row of ``docs
    (doc_id, source, text)``.

    Null text has size 0; null sources form a source of their own; null ids and ids without a
    weight are drawn with weight 1; documents without words have ``taken`` 0.  Equal ids with equal
    sizes in a source are taken alike.  An empty table gives an empty result.  Only the three
    columns are read, so other columns may have any name.
    """
    rows = cut(keyed(docs.select("doc_id", "source", "text"), weights, seed).select("doc_id", "source", "size", "key"))
    return apply_plan(rows, mixing_plan(rows, **shares)).withColumn("taken", F.col("passes") * F.col("size")).drop("key")
