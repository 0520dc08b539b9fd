"""Queries of the citation chain."""

from __future__ import annotations

from pyspark.sql import functions as F

from medloom.operators import citations as C
from medloom.plans.standins import COUNTS, PERCENTILES, RAW, records, references
from medloom.session import table


def _counts(spark, sf_dir):
    return C.records_with_counts(records(spark, sf_dir), C.count_references(references(spark, sf_dir)))


def citation_counts_raw(spark, sf_dir):
    return C.count_references(references(spark, sf_dir))


def citation_counts(spark, sf_dir):
    return _counts(spark, sf_dir)


def citation_percentiles(spark, sf_dir):
    return C.percentiles(_counts(spark, sf_dir))


def citation_percent_rank(spark, sf_dir):
    return C.percent_ranks(_counts(spark, sf_dir)).select("identifier", "year", "citationcount", F.round("percent_rank", 6).alias("percent_rank"), F.round("percent_rank").cast("int").alias("rounded"))


def _per_year(df):
    return df.groupBy("cut_year").agg(F.count("*").alias("n"), F.max("cut").alias("cut"))


def cutoff_any_year(spark, sf_dir):
    counts = _counts(spark, sf_dir)
    return _per_year(C.above_any_cutoff(counts, C.percentiles(counts), 10))


def cutoff_same_year(spark, sf_dir):
    counts = _counts(spark, sf_dir)
    return _per_year(C.above_own_cutoff(counts, C.percentiles(counts), 10))


def percentile_band_select(spark, sf_dir):
    counts = _counts(spark, sf_dir)
    return C.band(counts, C.percentiles(counts), 1997, 60, 95)


def percentile_band_unlogged(spark, sf_dir):
    counts = _counts(spark, sf_dir)
    log = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("identifier"))
    return C.not_logged(C.band(counts, C.percentiles(counts), 1997, 60, 95), log)


def citation_year_summary(spark, sf_dir):
    """Element counts by year, as the listing of a reader's records counts them."""
    return _counts(spark, sf_dir).groupBy("year").agg(F.count("*").alias("n"), F.sum("citationcount").cast("bigint").alias("cited"), F.count_if(F.col("citationcount") == 0).alias("never_cited"), F.max("citationcount").alias("most"))


BAND = f"""{PERCENTILES}, lim AS (SELECT coalesce(max(CASE WHEN percentile = 40 THEN citationcount END), 0) AS lower, coalesce(max(CASE WHEN percentile = 5 THEN citationcount END), 0) AS upper FROM pct WHERE year = 1997),
    band AS (SELECT identifier, citationcount, year FROM counts, lim WHERE year = 1997 AND citationcount BETWEEN lower AND upper)"""

ORACLE = {
    "citation_counts_raw": f"WITH {RAW} SELECT * FROM raw",
    "citation_counts": f"WITH {COUNTS} SELECT * FROM counts",
    "citation_percentiles": f"WITH {PERCENTILES} SELECT * FROM pct",
    "citation_percent_rank": f"""WITH {COUNTS} SELECT identifier, year, citationcount, round(percent_rank() OVER w, 6) AS percent_rank, round(percent_rank() OVER w)::INTEGER AS rounded
        FROM counts WINDOW w AS (PARTITION BY year ORDER BY citationcount)""",
    "cutoff_any_year": f"WITH {PERCENTILES} SELECT p.year AS cut_year, count(*) AS n, max(p.citationcount) AS cut FROM counts c JOIN pct p ON p.percentile = 10 AND p.citationcount <= c.citationcount GROUP BY 1",
    "cutoff_same_year": f"WITH {PERCENTILES} SELECT p.year AS cut_year, count(*) AS n, max(p.citationcount) AS cut FROM counts c JOIN pct p ON p.percentile = 10 AND p.year = c.year AND p.citationcount <= c.citationcount GROUP BY 1",
    "percentile_band_select": f"WITH {BAND} SELECT * FROM band",
    "percentile_band_unlogged": f"WITH {BAND} SELECT * FROM band WHERE identifier NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F') ORDER BY citationcount DESC, identifier",
    "citation_year_summary": f"WITH {COUNTS} SELECT year, count(*) AS n, sum(citationcount)::BIGINT AS cited, count(*) FILTER (citationcount = 0) AS never_cited, max(citationcount) AS most FROM counts GROUP BY 1",
}
QUERIES = {k: globals()[k] for k in ORACLE}
