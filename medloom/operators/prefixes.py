"""Names for addresses by the longest namespace that they begin with, for tables of namespaces of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def encode(rows: DataFrame, uri: str, namespaces: DataFrame, name: str = "name") -> DataFrame:
    """``rows`` with ``name``: ``prefix:rest`` by the longest of ``namespaces`` (prefix, namespace) that the address begins
    with, else the address; of several prefixes of a namespace the least.  A null address has no name.

    Each distinct address is cut at every length that a namespace has, and what stands before the cut is looked up by an
    equi-join: the plan is as large for ten namespaces as for ten thousand, and Spark chooses how to join them.  The
    distinct lengths reach the driver."""
    known = namespaces.where(F.col("prefix").isNotNull() & (F.length("namespace") > 0)).groupBy(F.col("namespace").alias("__head")).agg(F.min("prefix").alias("__prefix"))
    lengths = sorted(r[0] for r in known.select(F.length("__head")).distinct().collect())
    if not lengths:
        return rows.withColumn(name, F.col(uri))
    once = rows.select(F.col(uri).alias("__uri")).where("__uri is not null").distinct()
    cuts = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("__uri"))
    heads = once.select("__uri", F.explode(cuts).alias("__n")).withColumn("__head", F.expr("substring(__uri, 1, __n)"))
    best = heads.join(known, "__head").groupBy("__uri").agg(F.max(F.struct("__n", "__prefix")).alias("__best"))
    named = best.select("__uri", F.concat("__best.__prefix", F.lit(":"), F.expr("substring(__uri, __best.__n + 1)")).alias("__name"))
    return rows.join(named, rows[uri] == named["__uri"], "left").withColumn(name, F.coalesce("__name", uri)).drop("__uri", "__name")
