"""Vector columns as numpy arrays, and classes of equal vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def matrix(column: pa.Array) -> np.ndarray:
    """A list column without nulls, all of one length, as a float64 matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def usable(vector: str) -> Column:
    """Not null or empty, no component null or not finite, and not all zero."""
    v = F.col(vector).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def classes(rows: DataFrame, vector: str, id_col: str, most: int) -> DataFrame:
    """Equal vectors as one row: vec, ids (the ``most`` smallest distinct ones, ascending).  Null ids are left out.

    The ranks are cut before the shuffle as well, so a vector that a third of all rows hold costs ``most`` ids a task.
    """
    base = rows.select(F.col(vector).alias("vec"), F.col(id_col).alias("id")).where("id is not null")
    ranked = base.withColumn("r", F.dense_rank().over(Window.partitionBy("vec").orderBy("id"))).where(F.col("r") <= most)
    return ranked.groupBy("vec").agg(F.sort_array(F.collect_set("id")).alias("ids"))
