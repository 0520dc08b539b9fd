"""Denormalising a registry: one document-shaped row per driver row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_value(children: DataFrame, keys: list[str], order: list[str], fields: dict[str, Column]) -> DataFrame:
    """Of each key's children the values of the last one: the fields of the child that is greatest by ``order``."""
    picked = F.max_by(F.struct(*[c.alias(n) for n, c in fields.items()]), F.struct(*order))
    return children.groupBy(*keys).agg(picked.alias("last")).select(*keys, *[F.col(f"last.{n}").alias(n) for n in fields])


def back_to_driver(driver: DataFrame, aggregated: DataFrame, key: str) -> DataFrame:
    """Every driver row once; those without children hold nulls."""
    return driver.join(aggregated, key, "left")


def null_tolerant_concat(*columns: str) -> Column:
    return F.concat_ws("", *[F.col(c).cast("string") for c in columns])


def as_object(fields: dict[str, Column]) -> Column:
    """A JSON object with all keys, nulls too."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]), {"ignoreNullFields": "false"})


def array_of_last(children: DataFrame, key: str, kind: str, order: list[str], fields: dict[str, Column]) -> DataFrame:
    """One element per kind - the last child of the kind - as an array by kind."""
    last = last_value(children, [key, kind], order, fields)
    return last.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(kind, *fields))).alias("elements"))


def last_of_last(children: DataFrame, key: str, kind: str, order: list[str], fields: dict[str, Column]) -> DataFrame:
    """The last kind, and within it the last child."""
    last = last_value(children, [key, kind], order, fields)
    return last_value(last, [key], [kind], {kind: F.col(kind), **{n: F.col(n) for n in fields}})


def joined_texts(rows: DataFrame, key: str, repeated: str, distinct: str) -> DataFrame:
    """``repeated`` once per row, ``distinct`` once per value and sorted, comma-joined."""
    return rows.groupBy(key).agg(F.array_join(F.sort_array(F.collect_list(repeated)), ",").alias(repeated), F.array_join(F.sort_array(F.collect_set(distinct)), ",").alias(distinct))
