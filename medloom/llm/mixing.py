"""Mixing sources to target weights by Efraimidis-Spirakis keys and prefix sums; DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medloom.llm.shared import drop_stored, small_or_hashed, store

#: No source is taken more often than this.
MOST_EPOCHS = 3
#: Cells of the keys between one power of two and the next: one holds some thousandth of a source at most, whatever the
#: quality weights are.
CELLS = 256


def word_count(text: str) -> Column:
    """Runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint"), F.lit(0).cast("bigint"))


def targets(sources: DataFrame, share: float = 1.0, most: float = MOST_EPOCHS) -> DataFrame:
    """``sources`` (source, source_size, weight) with target: ``share`` of all sizes dealt by weight, no source above
    ``most`` times its own; what is over is dealt anew by weight among the others until no source is above.

    Sources reach their bound in the order of bound / weight.  So with the first k at theirs, the others get their weight
    times (budget - those bounds) / (weights left); the first whose bound is not below that fixes the rate for all that
    follow.  The running sums are over the table of sources, one row each.
    """
    bound = F.col("source_size") * F.lit(float(most))
    ordered = sources.withColumn("bound", bound).withColumn("reach", F.when(F.col("weight") > 0, F.col("bound") / F.col("weight")).otherwise(F.lit(float("inf"))))
    everyone = Window.partitionBy(F.lit(0))
    ascending = everyone.orderBy("reach", F.col("source").asc_nulls_last())
    earlier = ascending.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("weight").over(everyone) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    budget = F.sum("source_size").over(everyone) * F.lit(float(share)) - F.coalesce(F.sum("bound").over(earlier), F.lit(0.0))
    rated = ordered.withColumn("at", F.row_number().over(ascending)).withColumn("rate", F.when(left > 0, budget / left))
    rated = rated.withColumn("rate", F.min(F.when(F.col("reach") >= F.col("rate"), F.struct("at", "rate"))).over(everyone)["rate"])
    return rated.select("source", "source_size", "weight", F.coalesce(F.least("bound", F.greatest(F.col("rate"), F.lit(0.0)) * F.col("weight")), F.col("bound")).alias("target"))


def one_two_three(place: Column) -> Column:
    """Weights 1, 2, 3, 1, 2, 3 and so on by the place of a source, from 0."""
    return (place % 3 + 1).cast("double")


def mix(docs: DataFrame, weights: Callable[[Column], Column] = one_two_three, keep: tuple[str, ...] = ("doc_id",), source: str = "source", text: str = "text", quality: DataFrame | None = None, on: str = "doc_id", seed: int = 7, share: float = 1.0) -> DataFrame:
    """``keep`` columns, size, source_size, target, taken and times of every document.

    ``weights`` gives the weight of a source by its place, from 0, in the order of code points with null last.  A source
    whose target is e times its size and a rest takes all of its documents e times, and for the rest documents by
    ascending key -ln(u) / quality until the rest is used up: u is a hash of seed, source and document, so reruns agree.
    The document that crosses the end is taken if that comes nearer to the target, the later one if not.  ``quality`` has
    a positive weight (quality) by ``on``, one of the ``keep`` columns; null, not positive or none: 1.  Rows that repeat
    have equal keys and are told apart by no more than their order.

    Prefix sums need no source in one task: sizes are summed in cells of the key's range, the cell in which the rest ends
    is found from these sums, and only that cell's documents are sorted.  Nothing reaches the driver; the windows over
    sources alone hold one row for each.
    """
    u = (F.pmod(F.xxhash64(F.lit(seed), source, *keep, text), F.lit((1 << 40) - 1)) + F.lit(0.5)) / F.lit(float((1 << 40) - 1))
    tie = F.xxhash64(F.lit(seed + 1), source, *keep, text)
    rows = docs.select(F.struct(*keep).alias("kept"), F.col(source).cast("string").alias("source"), word_count(text).alias("size"), u.alias("u"), tie.alias("tie"))
    if quality is None:
        rows = rows.withColumn("q", F.lit(1.0))
    else:
        rows = rows.withColumn("on", F.col("kept")[on]).join(quality.select(F.col(on).alias("on"), F.col("quality").cast("double").alias("q")), "on", "left").drop("on")
    q = F.coalesce(F.col("q"), F.lit(1.0))
    rows = store(rows.select("kept", "source", "size", "tie", (-F.log("u") / F.when((q > 0) & ~F.isnan(q), q).otherwise(F.lit(1.0))).alias("draw")), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").cast("bigint").alias("source_size"))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    goals = targets(sizes.withColumn("weight", weights(place).cast("double")), share)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    goals = goals.withColumn("epochs", epochs)
    goals = store(goals.select(F.col("source").alias("s"), "source_size", "target", "epochs", F.greatest(F.lit(0.0), F.col("target") - F.col("epochs") * F.col("source_size")).alias("rest")), "goals")
    cell = F.floor(F.log2("draw") * CELLS).cast("int").alias("cell")
    sums = rows.groupBy("source", cell).agg(F.sum("size").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1))
    cells = sums.withColumn("before", F.coalesce(before, F.lit(0))).join(small_or_hashed(goals.select("s", "rest"), goals), F.col("source").eqNullSafe(F.col("s")))
    ends = cells.where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("n") >= F.col("rest")))
    ends = store(ends.groupBy("s").agg(F.min("cell").alias("end"), F.min_by("before", "cell").alias("before")), "ends")
    plan = store(goals.join(ends.withColumnRenamed("s", "t"), F.col("s").eqNullSafe(F.col("t")), "left").drop("t"), "plan")
    drop_stored(goals, ends)
    rows = rows.join(small_or_hashed(plan), F.col("source").eqNullSafe(F.col("s"))).withColumn("cell", cell)
    sure = rows.where("end is null or cell <> end").withColumn("more", F.coalesce(F.col("cell") < F.col("end"), F.lit(False)).cast("int"))
    # within the last cell: the order of keys, ties by hash, then by size
    w = Window.partitionBy("source").orderBy("draw", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    edge = rows.where("cell = end").withColumn("sum", F.col("before") + F.coalesce(F.sum("size").over(w), F.lit(0)))
    edge = edge.withColumn("more", (F.col("sum") + F.col("size") / 2 <= F.col("rest")).cast("int"))
    columns = ["kept", "size", "source_size", "target", "epochs", "more"]
    out = sure.select(*columns).unionByName(edge.select(*columns))
    times = F.least(F.col("epochs") + F.col("more"), F.lit(MOST_EPOCHS))
    return out.select("kept.*", "size", "source_size", "target", (F.col("size") * times).cast("bigint").alias("taken"), times.cast("int").alias("times"))
