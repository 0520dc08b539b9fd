"""Citation counts, per-year percentile cut-offs and the bands that are selected with them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_references(references: DataFrame) -> DataFrame:
    """References counted by cited id and type; aggregation comes before any join."""
    return references.groupBy("reference", "reference_type").agg(F.count("reference").alias("citationcount"))


def records_with_counts(records: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per record, year and count; a record that is never cited has 0.  Records' ids are cast, not the text."""
    joined = records.withColumn("reference", F.col("identifier").cast("string")).join(counts, "reference", "left")
    return joined.select("identifier", F.coalesce("citationcount", F.lit(0)).cast("int").alias("citationcount"), "year").distinct()


def percentiles(counts: DataFrame, group: str = "year", value: str = "citationcount", steps: int = 100) -> DataFrame:
    """The value at position p * (n div steps) of each group in descending order, for p from 0 to steps - 1.

    A group of n rows holds few distinct values, so positions are found on the histogram (group, value, count): the
    position lies in the one bar whose running total passes it.  Only bars are windowed, never rows, so a group of any
    size needs no sort of its rows in one task.  Null groups are left out.
    """
    bars = counts.where(F.col(group).isNotNull()).groupBy(group, value).agg(F.count("*").alias("bar"))
    w = Window.partitionBy(group)
    running = w.orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = bars.withColumn("upto", F.sum("bar").over(running)).withColumn("step", F.floor(F.sum("bar").over(w) / steps))
    first = F.col("upto") - F.col("bar")
    # positions p * step within [first, upto); step 0 puts all of them at the first row
    low = F.when(F.col("step") > 0, F.ceil(first / F.col("step"))).otherwise(F.when(first == 0, F.lit(0)).otherwise(F.lit(steps)))
    high = F.when(F.col("step") > 0, F.least(F.ceil(F.col("upto") / F.col("step")) - 1, F.lit(steps - 1))).otherwise(F.lit(steps - 1))
    spans = placed.withColumn("low", low.cast("int")).withColumn("high", high.cast("int")).where("low <= high")
    return spans.select(group, value, F.explode(F.sequence("low", "high")).alias("percentile"))


def percent_ranks(counts: DataFrame) -> DataFrame:
    """PERCENT_RANK of the count within its year, from the histogram of counts: (rows before) / (n - 1)."""
    bars = counts.groupBy("year", "citationcount").agg(F.count("*").alias("bar"))
    w = Window.partitionBy("year")
    before = F.coalesce(F.sum("bar").over(w.orderBy("citationcount").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    total = F.sum("bar").over(w)
    ranks = bars.select("year", "citationcount", F.when(total > 1, before / (total - 1)).otherwise(F.lit(0.0)).alias("percent_rank"))
    return counts.join(ranks.withColumnsRenamed({"year": "y", "citationcount": "c"}), F.col("year").eqNullSafe(F.col("y")) & (F.col("citationcount") == F.col("c"))).drop("y", "c")


def cutoffs(table: DataFrame, percentile: int) -> DataFrame:
    return table.where(F.col("percentile") == percentile).select(F.col("year").alias("cut_year"), F.col("citationcount").alias("cut"))


def above_any_cutoff(counts: DataFrame, table: DataFrame, percentile: int) -> DataFrame:
    """A row for each record and each year whose cut-off the record reaches: one row per year is broadcast."""
    cut = cutoffs(table, percentile)
    return counts.join(F.broadcast(cut), F.col("cut") <= F.col("citationcount"))


def above_own_cutoff(counts: DataFrame, table: DataFrame, percentile: int) -> DataFrame:
    cut = cutoffs(table, percentile)
    return counts.join(F.broadcast(cut), (F.col("cut_year") == F.col("year")) & (F.col("cut") <= F.col("citationcount")))


def band(counts: DataFrame, table: DataFrame, year: int, low: int, high: int) -> DataFrame:
    """Records of a year between the counts of two criteria; the criterion counts from the top (100 - criterion is
    looked up, and a missing one gives 0), and ``low`` <= ``high``."""
    if low > high:
        raise ValueError("the lower criterion is above the higher one")

    def bound(criterion: int, name: str) -> DataFrame:
        row = table.where((F.col("year") == year) & (F.col("percentile") == 100 - criterion))
        return row.agg(F.coalesce(F.max("citationcount"), F.lit(0)).alias(name))

    bounds = bound(low, "lower").join(bound(high, "upper"))  # one row each
    chosen = counts.where(F.col("year") == year).join(F.broadcast(bounds))
    return chosen.where(F.col("citationcount").between(F.col("lower"), F.col("upper"))).select("identifier", "citationcount", "year")


def not_logged(chosen: DataFrame, log: DataFrame, key: str = "identifier") -> DataFrame:
    """Those not in the log yet, most cited first."""
    return chosen.join(log.select(key), key, "left_anti").orderBy(F.desc("citationcount"), key)
