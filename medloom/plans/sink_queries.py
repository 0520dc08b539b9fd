"""Writers, each followed by a read of what it wrote, and states written back."""

from __future__ import annotations

from pyspark.sql import functions as F

from medloom import schema
from medloom.operators import tasks as K
from medloom.operators import triples as T
from medloom.plans.source_queries import folder
from medloom.plans.triple_queries import triples_build
from medloom.session import table
from medloom.sinks import tables as W
from medloom.sinks.keyed import KeyedTable


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")


def _halves(spark, sf_dir):
    """Orders, and those of even customers with another status."""
    o = _orders(spark, sf_dir)
    return o.where("o_custkey % 3 <> 0"), o.where("o_custkey % 2 = 0").withColumn("o_orderstatus", F.lit("new"))


def _back(spark, path):
    return spark.read.parquet(path)


def _stored(spark, path):
    return KeyedTable(spark, path).read()


def sink_append(spark, sf_dir):
    """Two writes; the second goes to a sink that keeps nothing as well."""
    a, b = _halves(spark, sf_dir)
    path = folder(spark, "append")
    W.append(path)(a)
    W.tee(W.append(path), W.nowhere)(b)
    return _back(spark, path)


def sink_keyed(spark, sf_dir):
    """Insert or update by key, twice."""
    a, b = _halves(spark, sf_dir)
    path = folder(spark, "keyed")
    for rows in (a, b):
        W.keyed(path, ["o_orderkey"])(rows)
    return _stored(spark, path)


def sink_insert_missing(spark, sf_dir):
    a, b = _halves(spark, sf_dir)
    path = folder(spark, "missing")
    for rows in (a, b):
        W.insert_missing(path, ["o_orderkey"])(rows)
    return _stored(spark, path)


def sink_replace_keys(spark, sf_dir):
    """All of a customer's rows go when new ones come."""
    a, b = _halves(spark, sf_dir)
    path = folder(spark, "replace")
    for rows in (a, b.where("o_orderkey % 4 = 0")):
        W.replace_keys(path, ["o_custkey"])(rows)
    return _stored(spark, path)


def sink_mapped(spark, sf_dir):
    """A filter and a projection before the sink."""
    path = folder(spark, "mapped")
    W.mapped(lambda df: df.where("o_orderstatus = 'F'").select("o_orderkey"), W.append(path))(_orders(spark, sf_dir))
    return _back(spark, path)


def sink_counted(spark, sf_dir):
    """Rows written, in all and with a key, counted while they pass; and the check of a copy."""
    o = _orders(spark, sf_dir).withColumn("k", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")))
    seen = W.counted(W.append(folder(spark, "counted")), "k")(o)
    source, stored = W.copy_checked(_orders(spark, sf_dir), folder(spark, "copy"), ["o_orderkey"])
    return spark.createDataFrame([(seen["total"], seen["keyed"], source, stored)], "total bigint, keyed bigint, source bigint, stored bigint")


def sink_declared(spark, sf_dir):
    """Lines as references in the declared table: sizes cut, defaults set, the last of a key."""
    li = table(spark, sf_dir, "lineitem")
    rows = li.select(F.col("l_partkey").alias("article_id"), F.col("l_orderkey").cast("string").alias("reference"), F.lit(0).alias("reference_type"), F.col("l_linenumber").alias("ordinal"), F.when(F.col("l_linenumber") > 3, F.repeat(F.lit("c"), 600)).alias("citation"))
    path = folder(spark, "declared")
    W.declared(schema.REFERENCES, path)(rows)
    return _stored(spark, path).withColumn("citation", F.length("citation"))


def sink_numbered(spark, sf_dir):
    """Customers in two overlapping writes: numbers that are generated are unique, and those given first stay."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    path = folder(spark, "numbered")
    t = KeyedTable(spark, path, ["c_custkey"])
    first = t.upsert_numbered(c.where("c_custkey % 3 <> 0"), "number")
    t.upsert_numbered(c.where("c_custkey % 2 = 0").withColumn("c_mktsegment", F.lower("c_mktsegment")), "number")
    old = t.read(first).select(F.col("c_custkey").alias("k"), F.col("number").alias("was"))
    both = t.read().join(old, F.col("c_custkey") == F.col("k"), "left")
    return both.groupBy("c_mktsegment").agg(F.count("*").alias("n"), F.count_distinct("number").alias("numbers"), F.count_if(F.col("number") == F.col("was")).alias("kept"), F.count_if(F.col("number") != F.col("was")).alias("changed"))


def sink_tables(spark, sf_dir):
    """All eight declared tables, filled from orders, lines, customers and documents: the rows of each by a digest."""
    o, d = table(spark, sf_dir, "orders"), table(spark, sf_dir, "documents")
    li, c = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "customer")
    k, day = F.col("o_orderkey").cast("string"), F.col("o_orderdate")
    year = F.year(day)
    rows = {
        schema.TASKS: o.select(k.alias("name"), (F.col("o_orderkey") % 5).alias("state"), F.col("o_orderpriority").alias("job"), day.alias("timestamp")),
        schema.FULL_TEXT_TASKS: o.select(F.concat(F.lit("PMC"), k).alias("identifier"), F.repeat(k, 60).alias("location"), year.alias("year"), (F.col("o_orderkey") % 5).alias("state"), day.alias("timestamp")),
        schema.AUTHORSHIPS: c.select(F.col("c_custkey").alias("publication_id"), F.lit(1).alias("ordinal"), F.repeat("c_name", 3).alias("fore_name"), F.col("c_name").alias("last_name"), F.col("c_mktsegment").alias("initials"), F.lit("[]").alias("affiliation"), F.when(F.col("c_custkey") % 2 == 0, 2001).alias("year_active")),
        schema.REFERENCES: li.select(F.col("l_partkey").alias("article_id"), F.col("l_orderkey").cast("string").alias("reference"), F.lit(0).alias("reference_type"), F.col("l_linenumber").alias("ordinal")),
        schema.LINKS: o.select(F.col("o_orderkey").alias("source"), F.concat(F.lit("10.1000/"), k).alias("target"), day.alias("timestamp")),
        schema.RECORDS: d.select(F.col("doc_id").alias("identifier"), F.lit(2020).alias("year"), F.md5("text").alias("record"), F.col("source").alias("origin")),
        schema.FULL_TEXTS: d.select(F.concat(F.lit("PMC"), F.col("doc_id").cast("string")).alias("identifier"), F.lit(2021).alias("year"), F.md5("text").alias("record")),
        schema.LOCATIONS: o.select(F.concat(F.lit("oa_"), year.cast("string"), F.lit(".tar.gz")).alias("container"), F.concat(k, F.lit(".xml")).alias("article_file"), F.lit("c").alias("article_citation"), F.concat(F.lit("PMC"), k).alias("pmc_id"), F.col("o_orderkey").alias("pmid"), day.alias("last_update"), F.lit("CC BY").alias("license"), F.when(F.col("o_orderkey") % 2 == 0, "yes").otherwise("no, never").alias("retracted")),
    }
    out = None
    for t, df in rows.items():
        path = folder(spark, t.name)
        W.declared(t, path)(df)
        stored = KeyedTable(spark, path).read() if t.keys else spark.read.parquet(path)
        text = [F.coalesce(F.date_format(f.name, "yyyy-MM-dd") if f.kind == "timestamp" else F.col(f.name).cast("string"), F.lit("-")) for f in t.fields]
        some = stored.select(F.lit(t.name).alias("table"), F.md5(F.concat_ws("|", *text)).alias("row_md5"))
        out = some if out is None else out.unionByName(some)
    return out


def sink_pairs(spark, sf_dir):
    path = folder(spark, "pairs")
    W.pairs(path, "c_custkey", "c_acctbal")(table(spark, sf_dir, "customer"))
    return _stored(spark, path).select("key", F.col("value").cast("double").alias("value"))


def sink_points(spark, sf_dir):
    """Vectors as points with a payload; a second write replaces points by id."""
    v = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("dense"), F.transform(F.slice("embedding", 1, 3), lambda x, i: F.struct(i.alias("index"), x.cast("double").alias("value"))).alias("sparse"), "label")
    path = folder(spark, "points")
    sink = W.points(path, ["label"])
    sink(v)
    sink(v.where("id % 7 = 0").withColumn("label", F.col("label") + 100))
    return _stored(spark, path).select("id", F.array_join(F.transform("text_dense", lambda x: F.format_number(x.cast("double"), 6)), ",").alias("dense"), F.array_join(F.transform("text_sparse", lambda x: F.concat_ws(":", x["index"].cast("string"), F.format_number(x["value"], 6))), ",").alias("sparse"), F.col("payload")["label"].alias("label"))


def sink_objects(spark, sf_dir):
    """Objects put and, some of them, deleted."""
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("d"), F.col("s_nationkey").cast("string"), F.lit("/o"), F.col("s_suppkey").cast("string")).alias("name"), F.col("s_name").alias("content"), "s_suppkey")
    path = folder(spark, "objects")
    W.put_objects(s, path).write.format("noop").mode("overwrite").save()
    W.delete_objects(s.where("s_suppkey % 3 = 0"), path).write.format("noop").mode("overwrite").save()
    left = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return left.select(F.array_join(F.slice(F.split("path", "/"), -2, 2), "/").alias("name"), F.col("content").cast("string").alias("content"))


def sink_json(spark, sf_dir):
    path = folder(spark, "json")
    W.json_lines(path)(_orders(spark, sf_dir))
    return spark.read.schema("o_orderkey bigint, o_custkey bigint, o_orderstatus string").json(path)


def sink_assertions(spark, sf_dir):
    """Triples logged with their origin, and read again."""
    path = folder(spark, "log")
    W.assertion_log(path, "here")(triples_build(spark, sf_dir))
    return spark.read.csv(path, sep="\t", schema="origin string, uri string, s string, p string, o string")


def writer_lost(spark, sf_dir):
    """A table whose second writer was lost after its data were written and before they had a version: the old rows."""
    a, b = _halves(spark, sf_dir)
    t = KeyedTable(spark, folder(spark, "lost"), ["o_orderkey"])
    t.upsert(a)
    b.write.parquet(f"{t.path}/data/lost")
    return t.read()


def sink_stamped(spark, sf_dir):
    """Customers that change: the stamp moves where a row does."""
    c = table(spark, sf_dir, "customer")
    t = KeyedTable(spark, folder(spark, "stamped"), ["c_custkey"])
    t.upsert(c.select("c_custkey", "c_mktsegment", "c_nationkey", F.lit("2020-01-01").alias("updated_at")))
    new = c.where("c_custkey % 3 <> 0").select("c_custkey", F.when(F.col("c_acctbal") < 0, F.lit("CLOSED")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"), F.when(F.col("c_custkey") % 7 == 0, F.lit(None).cast("int")).otherwise(F.col("c_nationkey")).alias("c_nationkey"), F.lit("").alias("updated_at"))
    t.upsert_stamped(new, "updated_at", F.lit("2024-06-01"))
    return t.read()


def sink_deleted(spark, sf_dir):
    """Orders of some customers removed by key, and what an older version still has."""
    o = _orders(spark, sf_dir)
    t = KeyedTable(spark, folder(spark, "deleted"), ["o_custkey"], buckets=16)
    first = t.replace(o)
    t.delete(o.where("o_custkey % 4 = 0").select("o_custkey"))
    now = t.read().select("o_orderkey", F.lit(True).alias("there"))
    return t.read(first).select("o_orderkey").join(now, "o_orderkey", "left").select("o_orderkey", F.coalesce("there", F.lit(False)).alias("there"))


def full_text_jobs(spark, sf_dir):
    """Full-text tasks after a run: queued and failed ones alone are worked on."""
    o = table(spark, sf_dir, "orders")
    t = o.select(F.concat(F.lit("PMC"), "o_orderkey").alias("identifier"), F.lit(None).cast("string").alias("location"), F.year("o_orderdate").cast("smallint").alias("year"), (F.col("o_orderkey") % 5).cast("smallint").alias("state"), F.col("o_orderdate").alias("timestamp"))
    status = F.when(F.col("o_orderkey") % 4 == 0, "Ok").when(F.col("o_orderkey") % 4 == 1, "Unavailable").when(F.col("o_orderkey") % 4 == 2, "Fail")
    r = o.select(F.concat(F.lit("PMC"), "o_orderkey").alias("identifier"), status.alias("status"))
    return K.full_text_jobs(t, r, F.concat_ws("/", F.lit("data"), "year", "identifier")).drop("timestamp")


def vector_log_states(spark, sf_dir):
    """A page of a log taken up, and its outcome written back."""
    log = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 4).cast("smallint").alias("status"))
    page = K.unfinished(log, K.LOG["COMPLETED"], "o_orderkey").limit(500)
    results = page.select("o_orderkey", (F.col("o_orderkey") % 3 != 0).alias("ok")).where("o_orderkey % 5 <> 0")
    return K.finished(K.taken(log, page, "o_orderkey"), results, "o_orderkey")


def assert_and_name(spark, sf_dir):
    """Names for relations of suppliers that are anonymous, one that is there, and one beside another."""
    t = triples_build(spark, sf_dir)
    new = t.where("p = 'broader' and (s like 's:%' or s = 'n:3')").select(F.concat(F.lit("u:"), "s").alias("uri"), "s", "p", "o")
    return T.assert_and_name(t, new.unionByName(t.where("uri is not null").select("uri", "s", "p", "o")))


def triples_collections(spark, sf_dir):
    """What is left after some are removed and some added, and whether it holds all."""
    t = triples_build(spark, sf_dir)
    gone, extra = t.where("s like 'c:%5'"), t.where("s like 'c:%15'")
    left = T.add_all(T.remove_all(t, gone), extra)
    return left.agg(F.count("*").alias("n")).join(T.contains_all(left, t)).join(T.contains_all(t, extra).select(F.col("contains").alias("extra_in")))


def triples_first(spark, sf_dir):
    t = triples_build(spark, sf_dir)
    return T.first_match(t, p="broader", o="n:3")


def terms(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    c, label = F.concat(F.lit("n:"), F.col("n_regionkey").cast("string")), F.concat(F.lit("l:"), F.col("n_nationkey").cast("string"))
    return T.terms(n.select(c.alias("concept"), label.alias("label"), F.col("n_name").alias("text"), (F.col("n_nationkey") % 2 == 0).alias("preferred")))


def replace_and_merge(spark, sf_dir):
    """Two nations made one: triples that become equal are one."""
    return T.merged(T.replace_uri(triples_build(spark, sf_dir), "n:3", "n:4"))


_A, _B = "a AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey % 3 <> 0)", "b AS (SELECT o_orderkey, o_custkey, 'new' AS o_orderstatus FROM orders WHERE o_custkey % 2 = 0)"
_T = """named AS (SELECT 't:' || n_nationkey AS uri, 'n:' || n_nationkey AS s, 'broader' AS p, 'r:' || n_regionkey AS o, NULL AS lit FROM nation),
    t AS (SELECT * FROM named UNION ALL SELECT NULL, 'c:' || c_custkey, 'broader', 'n:' || c_nationkey, NULL FROM customer UNION ALL SELECT NULL, 's:' || s_suppkey, 'broader', 'n:' || s_nationkey, NULL FROM supplier
        UNION ALL SELECT NULL, 'r:' || r_regionkey, 'name', NULL, r_name FROM region UNION ALL SELECT NULL, 'n:' || n_nationkey, 'name', NULL, n_name FROM nation UNION ALL SELECT NULL, 'c:' || c_custkey, 'segment', NULL, c_mktsegment FROM customer)"""
ORACLE = {
    "sink_append": f"WITH {_A}, {_B} SELECT * FROM a UNION ALL SELECT * FROM b",
    "sink_keyed": f"WITH {_A}, {_B} SELECT * FROM b UNION ALL SELECT * FROM a WHERE o_orderkey NOT IN (SELECT o_orderkey FROM b)",
    "sink_insert_missing": f"WITH {_A}, {_B} SELECT * FROM a UNION ALL SELECT * FROM b WHERE o_orderkey NOT IN (SELECT o_orderkey FROM a)",
    "sink_replace_keys": f"WITH {_A}, {_B}, c AS (SELECT * FROM b WHERE o_orderkey % 4 = 0) SELECT * FROM c UNION ALL SELECT * FROM a WHERE o_custkey NOT IN (SELECT o_custkey FROM c)",
    "sink_mapped": "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'",
    "sink_counted": "SELECT count(*) AS total, count(*) FILTER (o_orderkey % 2 = 0) AS keyed, count(*) AS source, count(*) AS stored FROM orders",
    "sink_declared": """SELECT l_partkey AS article_id, l_orderkey::VARCHAR AS reference, 0::SMALLINT AS reference_type, max(l_linenumber) AS ordinal, CASE WHEN max(l_linenumber) > 3 THEN 500 ELSE 0 END::INTEGER AS citation FROM lineitem GROUP BY 1, 2""",
    "sink_numbered": """WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE c_mktsegment END AS c_mktsegment FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0)
        SELECT c_mktsegment, count(*) AS n, count(*) AS numbers, count(*) FILTER (c_custkey % 3 <> 0) AS kept, 0::BIGINT AS changed FROM a GROUP BY 1""",
    "sink_tables": """SELECT 'tasks' AS "table", md5(o_orderkey || '|' || o_orderkey % 5 || '|' || o_orderpriority || '|' || strftime(o_orderdate, '%Y-%m-%d')) AS row_md5 FROM orders
        UNION ALL SELECT 'full_text_tasks' AS "table", md5('PMC' || o_orderkey || '|' || left(repeat(o_orderkey::VARCHAR, 60), 200) || '|' || year(o_orderdate) || '|' || o_orderkey % 5 || '|' || strftime(o_orderdate, '%Y-%m-%d')) AS row_md5 FROM orders
        UNION ALL SELECT 'authorships' AS "table", md5(c_custkey || '|' || 1 || '|' || left(repeat(c_name, 3), 40) || '|' || c_name || '|' || left(c_mktsegment, 10) || '|' || '[]' || '|' || CASE WHEN c_custkey % 2 = 0 THEN 2001 ELSE 0 END || '|' || '-') AS row_md5 FROM customer
        UNION ALL SELECT 'references' AS "table", md5(l_partkey || '|' || l_orderkey || '|' || 0 || '|' || max(l_linenumber) || '|' || '') AS row_md5 FROM lineitem GROUP BY l_partkey, l_orderkey
        UNION ALL SELECT 'links' AS "table", md5(o_orderkey || '|' || '10.1000/' || o_orderkey || '|' || strftime(o_orderdate, '%Y-%m-%d')) AS row_md5 FROM orders
        UNION ALL SELECT 'records' AS "table", md5(doc_id || '|' || 2020 || '|' || md5(text) || '|' || source) AS row_md5 FROM documents
        UNION ALL SELECT 'full_texts' AS "table", md5('PMC' || doc_id || '|' || 2021 || '|' || md5(text)) AS row_md5 FROM documents
        UNION ALL SELECT 'locations' AS "table", md5('oa_' || year(o_orderdate) || '.tar.gz|' || o_orderkey || '.xml|c|PMC' || o_orderkey || '|' || o_orderkey || '|' || strftime(o_orderdate, '%Y-%m-%d') || '|CC BY|' || CASE WHEN o_orderkey % 2 = 0 THEN 'yes' ELSE 'no, n' END) AS row_md5 FROM orders""",
    "sink_pairs": "SELECT c_custkey::VARCHAR AS key, c_acctbal AS value FROM customer",
    "sink_points": "SELECT vec_id AS id, array_to_string(list_transform(embedding, lambda x: format('{:.6f}', x::DOUBLE)), ',') AS dense, array_to_string(list_transform([0, 1, 2], lambda i: i || ':' || format('{:.6f}', embedding[i + 1]::DOUBLE)), ',') AS sparse, CASE WHEN vec_id % 7 = 0 THEN label + 100 ELSE label END::VARCHAR AS label FROM embeddings",
    "sink_objects": "SELECT 'd' || s_nationkey || '/o' || s_suppkey AS name, s_name AS content FROM supplier WHERE s_suppkey % 3 <> 0",
    "sink_json": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "sink_assertions": f"WITH {_T} SELECT 'here' AS origin, uri, s, p, coalesce(o, lit) AS o FROM t",
    "writer_lost": f"WITH {_A} SELECT * FROM a",
    "sink_stamped": """WITH n AS (SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'CLOSED' ELSE c_mktsegment END AS s, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_nationkey END AS k FROM customer WHERE c_custkey % 3 <> 0)
        SELECT c.c_custkey, CASE WHEN n.c_custkey IS NULL THEN c_mktsegment ELSE s END AS c_mktsegment, CASE WHEN n.c_custkey IS NULL THEN c_nationkey ELSE k END AS c_nationkey,
        CASE WHEN n.c_custkey IS NOT NULL AND (s IS DISTINCT FROM c_mktsegment OR k IS DISTINCT FROM c_nationkey) THEN '2024-06-01' ELSE '2020-01-01' END AS updated_at FROM customer c LEFT JOIN n USING (c_custkey)""",
    "sink_deleted": "SELECT o_orderkey, o_custkey % 4 <> 0 AS there FROM orders",
    "full_text_jobs": """WITH j AS (SELECT 'PMC' || o_orderkey AS identifier, year(o_orderdate)::SMALLINT AS year, o_orderkey % 5 AS state, o_orderkey % 4 AS r FROM orders)
        SELECT identifier, CASE WHEN state IN (0, 3) AND r = 0 THEN 'data/' || year || '/' || identifier END AS location, year, CASE WHEN state IN (0, 3) THEN CASE r WHEN 0 THEN 2 WHEN 1 THEN 4 WHEN 2 THEN 3 ELSE state END ELSE state END::SMALLINT AS state FROM j""",
    "vector_log_states": """WITH l AS (SELECT o_orderkey, o_orderkey % 4 AS status FROM orders), p AS (SELECT * FROM l WHERE status <> 2 ORDER BY o_orderkey LIMIT 500)
        SELECT l.o_orderkey, CASE WHEN p.o_orderkey IS NULL THEN CASE WHEN l.status = 1 AND false THEN 1 ELSE l.status END WHEN l.o_orderkey % 5 = 0 THEN 1 WHEN l.o_orderkey % 3 <> 0 THEN 2 ELSE 3 END::SMALLINT AS status FROM l LEFT JOIN p USING (o_orderkey)""",
    "assert_and_name": f"""WITH {_T} SELECT CASE WHEN p = 'broader' AND s LIKE 's:%' THEN 'u:' || s ELSE uri END AS uri, s, p, o, lit FROM t UNION ALL SELECT 'u:n:3', s, p, o, NULL FROM named WHERE s = 'n:3'""",
    "triples_collections": f"WITH {_T} SELECT count(*) FILTER (s NOT LIKE 'c:%5' OR s LIKE 'c:%15') AS n, count(*) FILTER (s LIKE 'c:%5' AND s NOT LIKE 'c:%15') AS missing, count(*) FILTER (s LIKE 'c:%5' AND s NOT LIKE 'c:%15') = 0 AS contains, true AS extra_in FROM t",
    "triples_first": f"WITH {_T} SELECT * FROM t WHERE p = 'broader' AND o = 'n:3' ORDER BY s, p, o, lit, uri LIMIT 1",
    "terms": """SELECT DISTINCT NULL::VARCHAR AS uri, s, p, o, lit FROM (SELECT 'n:' || n_regionkey AS s, 'rdf:type' AS p, 'skos:Concept' AS o, NULL AS lit FROM nation
        UNION ALL SELECT 'n:' || n_regionkey, CASE WHEN n_nationkey % 2 = 0 THEN 'skosxl:prefLabel' ELSE 'skosxl:altLabel' END, 'l:' || n_nationkey, NULL FROM nation UNION ALL SELECT 'l:' || n_nationkey, 'skosxl:literalForm', NULL, n_name FROM nation)""",
    "replace_and_merge": f"""WITH {_T}, m AS (SELECT CASE WHEN uri = 'n:3' THEN 'n:4' ELSE uri END AS uri, CASE WHEN s = 'n:3' THEN 'n:4' ELSE s END AS s, p, CASE WHEN o = 'n:3' THEN 'n:4' ELSE o END AS o, lit FROM t)
        SELECT DISTINCT * FROM m WHERE uri IS NOT NULL UNION ALL SELECT DISTINCT uri, s, p, o, lit FROM m WHERE uri IS NULL AND NOT EXISTS (SELECT 1 FROM m x WHERE x.uri IS NOT NULL AND x.s = m.s AND x.p = m.p AND x.o IS NOT DISTINCT FROM m.o AND x.lit IS NOT DISTINCT FROM m.lit)""",
}
QUERIES = {k: globals()[k] for k in ORACLE}
