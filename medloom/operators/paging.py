"""Tables in pages and partitions of bounded size, by ranges of their key instead of deep offsets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a page, and ids of a partition, as usual.
PAGE, IDS = 10_000, 500
#: Where a row stands inside its task, in the lower bits of the running id.
_WITHIN = (1 << 33) - 1


def numbered(rows: DataFrame, keys: list[str], folder: str, rank: str = "rank") -> DataFrame:
    """``rows`` with their rank (from 0) in the order of ``keys``, nulls first, as a table in ``folder``; ties in any order.

    Rows are dealt out by ranges of the key, which Spark cuts at sampled quantiles, and sorted in their tasks; a row's
    rank is its place there and the number of rows in the tasks before it.  One number a task reaches the driver."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    placed.select("*", F.spark_partition_id().alias("__task"), F.monotonically_increasing_id().bitwiseAND(F.lit(_WITHIN)).alias("__place")).write.parquet(folder)
    kind = T.StructType([*rows.schema.fields, T.StructField("__task", T.IntegerType()), T.StructField("__place", T.LongType())])
    stored = spark.read.schema(kind).parquet(folder)
    counts = {r["__task"]: r["n"] for r in stored.groupBy("__task").agg(F.count("*").alias("n")).collect()}
    before, total = [], 0
    for task in range(max(counts, default=-1) + 1):
        before.append(total)
        total += counts.get(task, 0)
    offset = F.get(F.split(F.lit(",".join(map(str, before or [0]))), ",").cast("array<bigint>"), F.col("__task"))
    return stored.withColumn(rank, offset + F.col("__place")).drop("__task", "__place")


def partitions(rows: DataFrame, keys: list[str], folder: str, most: int = IDS, name: str = "partition") -> DataFrame:
    """``rows`` with the number (from 0) of a partition of at most ``most`` rows that follow each other by key."""
    return numbered(rows, keys, folder, "__rank").withColumn(name, F.floor(F.col("__rank") / most)).drop("__rank")


def _at_least(keys: list[str], low: tuple) -> Column:
    """That a row's key is ``low`` or comes behind it, nulls first; said so that a reader can skip what is before."""
    out = None
    for k, value in reversed(list(zip(keys, low, strict=True))):
        c = F.col(k)
        if value is None:
            out = F.lit(True) if out is None else c.isNotNull() | out
        else:
            out = c >= F.lit(value) if out is None else (c >= F.lit(value)) & ((c > F.lit(value)) | out)
    return out


def _before(keys: list[str], high: tuple) -> Column:
    """That a row's key comes before ``high``, nulls first."""
    out = None
    for k, value in reversed(list(zip(keys, high, strict=True))):
        c = F.col(k)
        if value is None:
            out = F.lit(False) if out is None else c.isNull() & out
        else:
            less = (c < F.lit(value)) | c.isNull()
            out = less if out is None else ((c <= F.lit(value)) | c.isNull()) & (less | out)
    return out


@dataclass
class Pages:
    """Pages of a table that has a unique key: ``bounds`` has page, its first key and n, its rows."""

    rows: DataFrame
    keys: list[str]
    size: int
    bounds: DataFrame

    def page(self, number: int) -> DataFrame:
        """Rows of a page, in order: those between its first key and the next page's, wherever they lie."""
        found = {r["page"]: tuple(r[k] for k in self.keys) for r in self.bounds.where(F.col("page").isin(number, number + 1)).collect()}
        if number not in found:
            return self.rows.limit(0)
        out = self.rows.where(_at_least(self.keys, found[number]))
        if number + 1 in found:
            out = out.where(_before(self.keys, found[number + 1]))
        return out.orderBy(*self.keys)

    def number(self) -> int:
        return self.bounds.count()

    def checked(self) -> DataFrame:
        """page, n (rows that lie in the page's range) and first; raises where one is not as large as it has to be."""
        wrong = F.raise_error(F.concat(F.lit("page "), F.col("page").cast("string"), F.lit(" has "), F.col("n").cast("string"), F.lit(" rows: the key is not unique")))
        return self.bounds.select("page", F.when((F.col("n") > self.size) | F.col("repeats"), wrong.cast("bigint")).otherwise(F.col("n")).alias("n"), *self.keys)


def pages(rows: DataFrame, keys: list[str], folder: str, size: int = PAGE) -> Pages:
    """Cut ``rows`` in pages of ``size`` by their unique key.  Only keys are sorted and stored; a page is read by its
    range, from the table itself."""
    spark = rows.sparkSession
    order = numbered(rows.select(*keys), keys, f"{folder}/keys", "__rank")
    found = order.groupBy(F.floor(F.col("__rank") / size).alias("page")).agg(F.min_by(F.struct(*keys), "__rank").alias("k"), F.count("*").alias("n"), F.count_distinct(F.struct(*keys)).alias("own"))
    found.select("page", "k.*", "n", (F.col("own") < F.col("n")).alias("repeats")).write.parquet(f"{folder}/bounds")
    kinds = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    return Pages(rows, keys, size, spark.read.schema(f"page bigint, {kinds}, n bigint, repeats boolean").parquet(f"{folder}/bounds"))
