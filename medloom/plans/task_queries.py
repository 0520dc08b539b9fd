"""Task algebra over events, orders and customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from medloom.operators import paging
from medloom.operators import tasks as T
from medloom.plans.source_queries import folder
from medloom.session import table

LINE = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
NOW = "1998-08-02"


def _tasks(spark, sf_dir):
    state = F.pmod(F.length("event_type") + F.col("event_id"), F.lit(5)).cast("smallint")
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("name"), state.alias("state"), F.lit("load").alias("job"), F.col("ts").alias("timestamp"), "event_id")


def _current(spark, sf_dir):
    return T.current_state(_tasks(spark, sf_dir), "name", "state", ["timestamp", "event_id"])


def _listing(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("name"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, int(c_custkey % 60))").alias("remote"))


def upsert_last_wins(spark, sf_dir):
    return T.last_wins(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], LINE)


def upsert_change_stamp(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    old = c.select("c_custkey", "c_mktsegment", "c_nationkey", F.lit("2020-01-01").alias("updated_at"))
    new = c.where("c_custkey % 3 <> 0").select("c_custkey", F.when(F.col("c_acctbal") < 0, F.lit("CLOSED")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), F.when(F.col("c_custkey") % 7 == 0, F.lit(None).cast("int")).otherwise(F.col("c_nationkey")).alias("c_nationkey"), F.lit("").alias("updated_at"))
    return T.stamped_upsert(old, new, "c_custkey", "updated_at", F.lit("2024-06-01"))


def sync_two_way(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    local = c.select(F.col("c_custkey").alias("identifier"), F.concat(F.lit("local/"), "c_custkey").alias("location"), F.when(F.col("c_acctbal") > 5000, 2).otherwise(0).alias("state"))
    remote = c.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("identifier"), F.concat(F.lit("remote/"), "c_custkey").alias("location"), F.lit(2).alias("state"))
    return T.two_way_sync(local, remote, "identifier", "state", 2)


def task_reconcile(spark, sf_dir):
    return T.reconcile(_listing(spark, sf_dir), _current(spark, sf_dir))


def task_current_state(spark, sf_dir):
    return _current(spark, sf_dir)


def task_needs_work(spark, sf_dir):
    """The first twenty tasks that are queued, failed or in progress (the limit is the operator's)."""
    return T.needs_work(_current(spark, sf_dir), ["Queued", "Failed", "InProgress"], 20, ["timestamp", "name"])


def task_gate(spark, sf_dir):
    return T.gate(_current(spark, sf_dir))


def task_counts(spark, sf_dir):
    return T.counts_by(_tasks(spark, sf_dir), "state")


def task_versions(spark, sf_dir):
    """Each user's newest event of a type."""
    return T.ranked_latest(table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id"), "user_id", [F.desc("ts"), F.desc("event_id")])


def seed_jobs(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.concat(F.lit("PMC"), "o_custkey").alias("identifier")).agg(F.max(F.year("o_orderdate")).alias("year"))
    known = table(spark, sf_dir, "customer").where("c_acctbal > 5000").select(F.concat(F.lit("PMC"), "c_custkey").alias("identifier"))
    return T.seed(o, known, "identifier")


def linked_completed(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year"))
    return o.join(table(spark, sf_dir, "customer").where("c_acctbal > 5000").select("c_custkey"), "c_custkey").distinct()


def _links(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(F.concat(F.lit("PMC"), "o_custkey").alias("pmc"), F.col("o_orderkey").alias("pubmed"), F.to_date("o_orderdate").alias("day"))


def link_location_latest(spark, sf_dir):
    return T.latest_rows(_links(spark, sf_dir), "pmc", "day")


def link_location_update(spark, sf_dir):
    latest = T.latest_rows(_links(spark, sf_dir), "pmc", "day").groupBy("pmc").agg(F.max("pubmed").cast("string").alias("location"))
    target = table(spark, sf_dir, "customer").select(F.concat(F.lit("PMC"), "c_custkey").alias("pmc"), F.lit("none").alias("location"))
    return T.update_from(target, latest, "pmc", "location")


def vector_log_pending(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    log = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey", F.lit(2).cast("smallint").alias("status"))
    now = F.lit(NOW).cast("timestamp_ntz")
    return T.pending(o.where(F.col("o_orderdate") <= now), log, "o_orderkey", "o_orderdate", now)


def vector_log_batch(spark, sf_dir):
    return T.unfinished(vector_log_pending(spark, sf_dir), 2, "o_orderkey")


def page_of_table(spark, sf_dir):
    """The third page of 1000 (the page is the operator's), read by its range of the key."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return paging.pages(o, ["o_orderkey"], folder(spark, "pages"), 1000).page(2)


def pages_of_table(spark, sf_dir):
    """All pages of 1000 by a key of two columns: their first keys and their numbers of rows."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus")
    return paging.pages(o, ["o_custkey", "o_orderkey"], folder(spark, "pages"), 1000).checked()


def id_partitions(spark, sf_dir):
    """Orders in partitions of 500 ids, each one group's work: a digest of its ids, in order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey")
    parts = paging.partitions(o, ["o_orderkey"], folder(spark, "ids"), 500)
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: x.cast("string")), ",")
    return parts.groupBy("partition").agg(F.count("*").alias("n"), F.md5(ids).alias("ids_md5"))


_T = "t AS (SELECT user_id::VARCHAR AS name, ((length(event_type) + event_id) % 5)::SMALLINT AS state, ts AS timestamp, event_id FROM events)"
_CUR = f"{_T}, cur AS (SELECT name, state, timestamp FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY timestamp DESC, event_id DESC) AS rn FROM t) WHERE rn = 1)"
_L = "li AS (SELECT 'PMC' || o_custkey AS pmc, o_orderkey AS pubmed, o_orderdate::DATE AS day FROM orders), la AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY pmc ORDER BY day DESC) AS r FROM li) WHERE r = 1)"
_PEND = f"""p AS (SELECT o_orderkey, 0::SMALLINT AS status FROM orders WHERE o_orderdate >= TIMESTAMP '{NOW}' - INTERVAL 1 DAY AND o_orderdate <= TIMESTAMP '{NOW}'
    UNION ALL SELECT o_orderkey, 2::SMALLINT FROM orders WHERE o_orderstatus = 'F' AND NOT (o_orderdate >= TIMESTAMP '{NOW}' - INTERVAL 1 DAY AND o_orderdate <= TIMESTAMP '{NOW}'))"""

ORACLE = {
    "upsert_last_wins": f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(c + ' DESC' for c in LINE)}) AS rn FROM lineitem) WHERE rn = 1",
    "upsert_change_stamp": """WITH n AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'CLOSED' ELSE c_mktsegment END AS s, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS k FROM customer WHERE c_custkey % 3 <> 0)
        SELECT c.c_custkey, CASE WHEN n.c_custkey IS NULL THEN c_mktsegment ELSE s END AS c_mktsegment, CASE WHEN n.c_custkey IS NULL THEN c_nationkey ELSE k END AS c_nationkey,
        CASE WHEN n.c_custkey IS NOT NULL AND (s IS DISTINCT FROM c_mktsegment OR k IS DISTINCT FROM c_nationkey) THEN '2024-06-01' ELSE '2020-01-01' END AS updated_at FROM customer c LEFT JOIN n USING (c_custkey)""",
    "sync_two_way": """SELECT c_custkey AS identifier, CASE WHEN c_mktsegment = 'BUILDING' THEN 'remote/' ELSE 'local/' END || c_custkey AS location, 2 AS state FROM customer WHERE c_mktsegment = 'BUILDING' OR c_acctbal > 5000""",
    "task_reconcile": f"""WITH {_CUR}, l AS (SELECT c_custkey::VARCHAR AS name, TIMESTAMP '2024-01-01' + INTERVAL 1 DAY * (c_custkey % 60) AS remote FROM customer)
        SELECT coalesce(l.name, cur.name) AS name, CASE WHEN remote IS NOT NULL AND (timestamp IS NULL OR remote > timestamp) THEN 0::SMALLINT ELSE state END AS state, greatest(remote, timestamp) AS timestamp FROM l FULL JOIN cur ON l.name = cur.name""",
    "task_current_state": f"WITH {_CUR} SELECT * FROM cur",
    "task_needs_work": f"WITH {_CUR} SELECT * FROM cur WHERE state IN (0, 1, 3) ORDER BY timestamp, name LIMIT 20",
    "task_gate": f"WITH {_CUR} SELECT count(*) FILTER (state <> 2) AS left, count(*) FILTER (state <> 2) = 0 AS passes FROM cur",
    "task_counts": f"WITH {_T} SELECT state, count(*) AS n FROM t GROUP BY 1",
    "task_versions": "SELECT user_id, event_type, ts, event_id FROM (SELECT *, rank() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1",
    "seed_jobs": "SELECT 'PMC' || o_custkey AS identifier, max(year(o_orderdate))::INTEGER AS year FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000) GROUP BY 1",
    "linked_completed": "SELECT DISTINCT c_custkey, year(o_orderdate)::INTEGER AS year FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 5000",
    "link_location_latest": f"WITH {_L} SELECT pmc, pubmed, day FROM la",
    "link_location_update": f"WITH {_L}, m AS (SELECT pmc, max(pubmed)::VARCHAR AS location FROM la GROUP BY 1) SELECT 'PMC' || c_custkey AS pmc, coalesce(location, 'none') AS location FROM customer LEFT JOIN m ON pmc = 'PMC' || c_custkey",
    "vector_log_pending": f"WITH {_PEND} SELECT * FROM p",
    "vector_log_batch": f"WITH {_PEND} SELECT * FROM p WHERE status <> 2 ORDER BY o_orderkey",
    "pages_of_table": "SELECT page, count(*) AS n, min_by(o_custkey, r) AS o_custkey, min_by(o_orderkey, r) AS o_orderkey FROM (SELECT *, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS r, (row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1) // 1000 AS page FROM orders) GROUP BY 1",
    "id_partitions": "SELECT partition, count(*) AS n, md5(string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_orderkey)) AS ids_md5 FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 500 AS partition FROM orders) GROUP BY 1",
    "page_of_table": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders ORDER BY o_orderkey LIMIT 1000 OFFSET 2000",
}
QUERIES = {k: globals()[k] for k in ORACLE}
