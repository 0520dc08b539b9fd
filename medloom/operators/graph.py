"""A property graph as vertex and edge tables, and pattern matching by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text; null is the empty text."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def value_map(column: str, labels: dict) -> Column:
    """The label of a value; null has the label of None; others have none (null)."""
    out = F.when(F.col(column).isNull(), F.lit(labels[None])) if None in labels else F.when(F.lit(False), F.lit(None).cast("string"))
    for value, label in labels.items():
        if value is not None:
            out = out.when(F.col(column) == value, label)
    return out


def lookup(df: DataFrame, kinds: dict[str, str], kind: str, value: str, named: str) -> DataFrame:
    """Rows of one entity by one of several kinds of key, of those that have a name."""
    if kind not in kinds:
        raise ValueError(f"unknown key {kind!r}: one of {sorted(kinds)}")
    return df.where((F.col(kinds[kind]).cast("string") == value) & F.col(named).isNotNull())


def attribute_graph(rows: DataFrame, uid: str, root_tag: str, attributes: list[str], edge: str = "has_parent", suffix: str = "") -> tuple[DataFrame, DataFrame]:
    """A root vertex per row, a vertex for every attribute that is not empty, and an edge from it to the root.

    Value vertices have the lower-cased value as id; rows without ``uid`` give nothing.  First of equals wins: vertices
    are unique by tag and id, with the least value as their property.
    """
    rows = rows.where(F.col(uid) != "").withColumn("root", F.concat(F.lower(uid), F.lit(suffix)))
    pairs = F.explode(F.array(*[F.struct(F.lit(a).alias("tag"), F.col(a).alias("value")) for a in attributes]))
    values = rows.select("root", pairs.alias("p")).select("root", "p.tag", "p.value").where(F.col("value") != "").withColumn("id", F.lower("value"))
    roots = rows.select(F.lit(root_tag).alias("tag"), F.col("root").alias("id"), F.col("root").alias("value"))
    vertices = roots.unionByName(values.select("tag", "id", "value")).groupBy("tag", "id").agg(F.min("value").alias("value"))
    edges = values.select(F.lit(edge).alias("type"), F.col("id").alias("src"), F.col("root").alias("dst")).distinct()
    return vertices, edges


def link_edges(rows: DataFrame, kind: str, src: Column, dst: Column) -> DataFrame:
    """Edges where both ends are present."""
    e = rows.select(F.lit(kind).alias("type"), F.lower(src).alias("src"), F.lower(dst).alias("dst"))
    return e.where("src <> '' and dst <> ''").distinct()


def add_first_wins(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Insert if not exists: what is there stays."""
    return old.unionByName(new.join(old.select(*keys), keys, "left_anti"))


def hop(starts: DataFrame, edges: DataFrame, kind: str | None = None, reverse: bool = False, at: str = "id", to: str = "next") -> DataFrame:
    """One step along edges of a type (any if None), against their direction if ``reverse``."""
    e = edges if kind is None else edges.where(F.col("type") == kind)
    a, b = ("dst", "src") if reverse else ("src", "dst")
    return starts.join(e.select(F.col(a).alias(at), F.col(b).alias(to)), at)
