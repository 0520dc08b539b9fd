"""Domain tables made from the generic ones, in DataFrame form and as SQL fragments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medloom.session import table


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("identifier"), F.year("o_orderdate").alias("year"), F.col("o_orderpriority").alias("origin"))


def references(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("articleid"), F.col("l_orderkey").cast("string").alias("reference"), F.lit(0).cast("smallint").alias("reference_type"),
        F.col("l_linenumber").alias("ordinal"), F.concat_ws("", "l_returnflag", "l_linestatus").alias("citation"),
    )


RAW = "raw AS (SELECT l_orderkey::VARCHAR AS reference, 0::SMALLINT AS reference_type, count(l_orderkey) AS citationcount FROM lineitem GROUP BY 1, 2)"
COUNTS = f"""{RAW}, counts AS (SELECT DISTINCT o_orderkey AS identifier, coalesce(citationcount, 0)::INTEGER AS citationcount, year(o_orderdate)::INTEGER AS year
    FROM orders LEFT JOIN raw ON o_orderkey::VARCHAR = reference)"""
PERCENTILES = f"""{COUNTS}, placed AS (SELECT year, citationcount, row_number() OVER (PARTITION BY year ORDER BY citationcount DESC, identifier) - 1 AS pos, count(*) OVER (PARTITION BY year) // 100 AS step FROM counts),
    pct AS (SELECT year, citationcount, p::INTEGER AS percentile FROM placed JOIN (SELECT unnest(range(0, 100)) AS p) ON pos = p * step)"""
