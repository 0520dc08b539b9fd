"""Exploding and regrouping nested lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def explode_product(rows: DataFrame, lists: list[str]) -> DataFrame:
    """The cartesian product of several list columns of a row; if any list is empty, one row with nulls for all."""
    empty = F.lit(False)
    for c in lists:
        empty = empty | (F.size(F.coalesce(c, F.array())) == 0)
    out = rows.withColumns({c: F.when(empty, F.array(F.lit(None).cast("string"))).otherwise(F.col(c)) for c in lists})
    for c in lists:
        out = out.withColumn(c, F.explode(c))
    return out


def with_ordinal(rows: DataFrame, items: str, keep: list[str], value: str = "field") -> DataFrame:
    """Items with their position; a row without items stays, with nulls."""
    return rows.select(*keep, F.posexplode_outer(items).alias("ordinal", value))


def typed_references(rows: DataFrame, groups: str, keep: list[str], known: list[str]) -> DataFrame:
    """Groups (list of maps type -> id): a row per group and known type; the ordinal is the group's."""
    e = rows.select(*keep, F.posexplode(groups).alias("ordinal", "ids"))
    e = e.select(*keep, "ordinal", F.explode("ids").alias("kind", "reference"))
    return e.where(F.lower("kind").isin([k.lower() for k in known]))


def first_links(rows: DataFrame, ids: str, keep: list[str], source: str, target: str) -> DataFrame:
    """The first id of one type with the first of another; rows that lack either give nothing."""
    first = lambda kind: F.try_element_at(F.filter(ids, lambda x: x["kind"] == kind), F.lit(1))["value"]
    return rows.select(*keep, first(source).alias("source"), first(target).alias("target")).where("source is not null and target is not null")


def word_windows(text: Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` words that share ``overlap`` with the one before, as structs of position and text."""
    words = F.filter(F.split(text, r"\s+"), lambda w: w != "")
    step = size - overlap
    n = F.size(words)
    starts = F.when(n == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil((n - overlap) / F.lit(step)).cast("int") - 1) * step, F.lit(step)))
    return F.transform(starts, lambda s: F.struct((s / step).cast("int").alias("position"), F.array_join(F.slice(words, s + 1, F.lit(size)), " ").alias("chunk")))


def grouped_sections(paragraphs: DataFrame, key: str, section: str, text: str, depth: int) -> DataFrame:
    """Paragraphs of equal leading components of a dotted id, joined without separator in id order."""
    head = F.substring_index(section, ".", depth)
    order = F.transform(F.split(section, r"\."), lambda x: x.cast("int"))
    g = paragraphs.groupBy(key, head.alias("head")).agg(F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col(text).alias("t")))).alias("parts"))
    return g.select(key, "head", F.array_join(F.transform("parts", lambda p: p["t"]), "").alias("section_text"))


def runs(rows: DataFrame, key: str, order: list[str], within: str) -> DataFrame:
    """Rows with run, the number (from 0) of the stretch of equal ``key`` that a row is in, in the order of ``order``
    within each value of ``within``."""
    w = Window.partitionBy(within).orderBy(*order)
    new = (~F.col(key).eqNullSafe(F.lag(key).over(w))) & (F.row_number().over(w) > 1)
    return rows.withColumn("__new", new.cast("int")).withColumn("run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def split_on_change(rows: DataFrame, key: str, order: list[str], within: str, text: str) -> DataFrame:
    """A document for each run: within, run, the key, and its texts in order, line by line."""
    g = runs(rows, key, order, within).groupBy(within, "run", key)
    joined = F.array_sort(F.collect_list(F.struct(*order, F.col(text).alias("__text"))))
    return g.agg(F.array_join(F.transform(joined, lambda x: x["__text"]), "\n").alias("document"), F.count("*").alias("n"))
