"""Regions, nations, customers and suppliers as triples."""

from __future__ import annotations

from pyspark.sql import functions as F

from medloom.operators import reach
from medloom.operators import triples as T
from medloom.operators.patterns import Clause, solve
from medloom.session import table


def _null():
    return F.lit(None).cast("string")


def _rows(df, s, p, o=None, lit=None, uri=None):
    text = lambda c: _null() if c is None else c.cast("string")
    return df.select(text(uri).alias("uri"), text(s).alias("s"), F.lit(p).alias("p"), text(o).alias("o"), text(lit).alias("lit"))


def _id(prefix, c):
    return F.concat(F.lit(prefix), F.col(c).cast("string"))


def triples_build(spark, sf_dir):
    r, n, c, s = (table(spark, sf_dir, t) for t in ("region", "nation", "customer", "supplier"))
    named = _rows(n, _id("n:", "n_nationkey"), "broader", _id("r:", "n_regionkey"), uri=_id("t:", "n_nationkey"))
    anonymous = _rows(n, _id("n:", "n_nationkey"), "broader", _id("r:", "n_regionkey"))  # each has a name: dropped
    for df, s_, p, o, lit in (
        (c, _id("c:", "c_custkey"), "broader", _id("n:", "c_nationkey"), None),
        (s, _id("s:", "s_suppkey"), "broader", _id("n:", "s_nationkey"), None),
        (r, _id("r:", "r_regionkey"), "name", None, F.col("r_name")),
        (n, _id("n:", "n_nationkey"), "name", None, F.col("n_name")),
        (c, _id("c:", "c_custkey"), "segment", None, F.col("c_mktsegment")),
        (c, _id("c:", "c_custkey"), "segment", None, F.col("c_mktsegment")),
    ):
        anonymous = anonymous.unionByName(_rows(df, s_, p, o, lit))
    return T.assert_triples(named, anonymous)


def triples_pattern_sv(spark, sf_dir):
    return T.pattern(triples_build(spark, sf_dir), s="n:3", p=["name", "broader"])


def triples_pattern_vo(spark, sf_dir):
    return T.pattern(triples_build(spark, sf_dir), p="broader", o="n:3")


def triples_objects(spark, sf_dir):
    return T.objects(T.pattern(triples_build(spark, sf_dir), p="name"))


def triples_stats(spark, sf_dir):
    t = triples_build(spark, sf_dir)
    return t.agg(F.count("*").alias("n"), F.count_distinct("s").alias("subjects"), F.count_distinct("p").alias("verbs"), F.count_distinct("o").alias("objects"), F.count("lit").alias("literals"), F.count("uri").alias("named"))


def triples_verb_stats(spark, sf_dir):
    return T.verb_statistics(triples_build(spark, sf_dir))


def transitive_closure(spark, sf_dir):
    starts = table(spark, sf_dir, "customer").select(_id("c:", "c_custkey").alias("start"))
    return reach.closure(triples_build(spark, sf_dir), ["broader"], starts)


def is_related(spark, sf_dir):
    c = table(spark, sf_dir, "supplier")
    pairs = c.select(_id("s:", "s_suppkey").alias("source"), F.concat(F.lit("r:"), (F.col("s_suppkey") % 5).cast("string")).alias("target"))
    return reach.is_related(triples_build(spark, sf_dir), ["broader"], pairs)


def replace_uri(spark, sf_dir):
    return T.replace_uri(triples_build(spark, sf_dir), "n:3", "n:three")


def remove_by_uri(spark, sf_dir):
    return T.remove_uri(triples_build(spark, sf_dir), "n:3")


def dedupe_categories(spark, sf_dir):
    t = triples_build(spark, sf_dir)
    extra = spark.createDataFrame([(None, "c:1", "broader", "r:1", None), (None, "c:2", "broader", "r:1", None), (None, "c:1", "broader", "r:2", None), (None, "c:2", "broader", "r:2", None), (None, "c:1", "broader", "r:4", None)], "uri string, s string, p string, o string, lit string")
    out = T.drop_shared_categories(t.unionByName(extra), "c:1", "c:2", "broader", ["r:2"])
    return out.where("s in ('c:1', 'c:2') and o like 'r:%'")


def container_members(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").groupBy(_id("v:", "conv_id").alias("conv")).agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "role"))), lambda x: x["role"]).alias("roles"))
    return T.members(T.sequence_triples(turns, "conv", "roles"), "conv")


def resource_filter(spark, sf_dir):
    return T.resources(triples_build(spark, sf_dir), ("segment", ["BUILDING"]), ("broader", ["n:3", "n:4", "n:5"]))


def triples_solve(spark, sf_dir):
    """Customers of a segment with their nation and the name of its region, joined by the verbs' frequencies."""
    t = triples_build(spark, sf_dir)
    clauses = [Clause("?customer", "broader", "?nation"), Clause("?customer", "segment", "?segment"), Clause("?nation", "broader", "?region"), Clause("?region", "name", "?name")]
    return solve(t, clauses, values={"?segment": ["BUILDING", "MACHINERY"]}, stats=T.verb_statistics(t))


def triples_paths(spark, sf_dir):
    """Who is one or two steps below the regions that are named, at whatever depth."""
    t = triples_build(spark, sf_dir)
    return solve(t, [Clause("?region", "name", "?name"), Clause("?below", "broader", "?region", (1, 2))], values={"?name": ["ASIA", "EUROPE"]})


def triples_any_path(spark, sf_dir):
    """All that customers come to, themselves included, with its name if it has one."""
    return solve(triples_build(spark, sf_dir), [Clause("?customer", "segment", "BUILDING"), Clause("?customer", "broader", "?place", (0, None)), Clause("?place", "name", "?name")])


_T = """t AS (SELECT 't:' || n_nationkey AS uri, 'n:' || n_nationkey AS s, 'broader' AS p, 'r:' || n_regionkey AS o, NULL::VARCHAR AS lit FROM nation
    UNION ALL SELECT NULL, 'c:' || c_custkey, 'broader', 'n:' || c_nationkey, NULL FROM customer UNION ALL SELECT NULL, 's:' || s_suppkey, 'broader', 'n:' || s_nationkey, NULL FROM supplier
    UNION ALL SELECT NULL, 'r:' || r_regionkey, 'name', NULL, r_name FROM region UNION ALL SELECT NULL, 'n:' || n_nationkey, 'name', NULL, n_name FROM nation
    UNION ALL SELECT NULL, 'c:' || c_custkey, 'segment', NULL, c_mktsegment FROM customer)"""
_W = "WITH " + _T
_R = _T + ", reach AS (SELECT s AS start, s AS node FROM (SELECT 'c:' || c_custkey AS s FROM customer UNION ALL SELECT 's:' || s_suppkey FROM supplier) UNION SELECT start, o FROM reach JOIN t ON node = s AND p = 'broader')"

ORACLE = {
    "triples_build": f"{_W} SELECT * FROM t",
    "triples_pattern_sv": f"{_W} SELECT * FROM t WHERE s = 'n:3' AND p IN ('name', 'broader')",
    "triples_pattern_vo": f"{_W} SELECT * FROM t WHERE p = 'broader' AND o = 'n:3'",
    "triples_objects": f"{_W} SELECT coalesce(o, lit) AS object FROM t WHERE p = 'name'",
    "triples_stats": f"{_W} SELECT count(*) AS n, count(DISTINCT s) AS subjects, count(DISTINCT p) AS verbs, count(DISTINCT o) AS objects, count(lit) AS literals, count(uri) AS named FROM t",
    "triples_verb_stats": f"{_W} SELECT p, count(*) AS n, count(DISTINCT s) AS subjects, count(DISTINCT o) AS objects, count(lit) AS literals FROM t GROUP BY 1",
    "transitive_closure": f"WITH RECURSIVE {_R} SELECT * FROM reach WHERE start LIKE 'c:%'",
    "is_related": f"WITH RECURSIVE {_R} SELECT 's:' || s_suppkey AS source, 'r:' || (s_suppkey % 5) AS target, EXISTS (SELECT 1 FROM reach WHERE start = 's:' || s_suppkey AND node = 'r:' || (s_suppkey % 5)) AS related FROM supplier",
    "triples_solve": f"{_W} SELECT DISTINCT a.s AS customer, a.o AS nation, b.lit AS segment, c.o AS region, d.lit AS name FROM t a JOIN t b ON a.s = b.s AND b.p = 'segment' AND b.lit IN ('BUILDING', 'MACHINERY') JOIN t c ON c.s = a.o AND c.p = 'broader' JOIN t d ON d.s = c.o AND d.p = 'name' WHERE a.p = 'broader'",
    "triples_paths": f"{_W}, one AS (SELECT s, o FROM t WHERE p = 'broader'), path AS (SELECT * FROM one UNION SELECT a.s, b.o FROM one a JOIN one b ON a.o = b.s) SELECT r.s AS region, r.lit AS name, path.s AS below FROM t r JOIN path ON path.o = r.s WHERE r.p = 'name' AND r.lit IN ('ASIA', 'EUROPE')",
    "triples_any_path": f"WITH RECURSIVE {_R} SELECT DISTINCT start AS customer, node AS place, n.lit AS name FROM reach JOIN t c ON c.s = start AND c.p = 'segment' AND c.lit = 'BUILDING' JOIN t n ON n.s = node AND n.p = 'name'",
    "replace_uri": f"{_W} SELECT uri, CASE WHEN s = 'n:3' THEN 'n:three' ELSE s END AS s, p, CASE WHEN o = 'n:3' THEN 'n:three' ELSE o END AS o, lit, ((s = 'n:3')::INTEGER + coalesce((o = 'n:3')::INTEGER, 0))::INTEGER AS replaced FROM t",
    "remove_by_uri": f"{_W} SELECT * FROM t WHERE s <> 'n:3' AND coalesce(o, '') <> 'n:3'",
    "dedupe_categories": "SELECT NULL::VARCHAR AS uri, s, 'broader' AS p, o, NULL::VARCHAR AS lit FROM (VALUES ('c:2', 'r:1'), ('c:1', 'r:2'), ('c:2', 'r:2'), ('c:1', 'r:4')) v(s, o)",
    "container_members": "SELECT 'v:' || conv_id AS conv, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role)::INTEGER AS position, role AS member FROM conversations",
    "resource_filter": "SELECT 'c:' || c_custkey AS s FROM customer WHERE c_mktsegment = 'BUILDING' AND c_nationkey IN (3, 4, 5)",
}
QUERIES = {k: globals()[k] for k in ORACLE}
