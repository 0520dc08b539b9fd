"""The session that the library expects, and table access."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI, adaptive execution, last value wins in maps; ``partitions`` defaults to twice the cores."""
    builder = SparkSession.builder.appName("medloom")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    return builder.config(map=settings).getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt out by keys to twice the cores at least, however small its files are: for rows that cost more than their bytes
    tell.  A stated number is not lessened by adaptive execution."""
    spark = df.sparkSession
    return df.repartition(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)
