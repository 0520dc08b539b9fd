"""Queries over embeddings: cosine, fingerprints, sparse vectors, clusters (labels) and the two-stage search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from medloom.operators import fingerprints as P
from medloom.operators import vectors as V
from medloom.session import table

K = 5


def _vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"), "label")


def _queries(df, name="q"):
    return df.where("id % 100 = 0").select(F.col("id").alias("query_id"), F.col("v").alias(name))


def dense_cosine_topk(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    return V.cosine_topk(_queries(v), v.select("id", "v"), K)


def dense_centroids(spark, sf_dir):
    return V.dense_centroids(_vectors(spark, sf_dir), "label")


def sparse_vectors(spark, sf_dir):
    return V.to_sparse(_vectors(spark, sf_dir), 0.1).select("id", "index", F.round("value", 6).alias("value"))


def _sparse(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    return V.to_sparse(v, 0.1)


def sparse_dot_topk(spark, sf_dir):
    s = _sparse(spark, sf_dir)
    return V.sparse_dot_topk(s.where("id % 100 = 0").withColumnRenamed("id", "query_id"), s, K)


def sparse_centroids(spark, sf_dir):
    v = _vectors(spark, sf_dir)
    return V.sparse_centroids(V.to_sparse(v, 0.1).join(v.select("id", "label"), "id"), "label")


def topk_overlap(spark, sf_dir):
    """How many of the best five dense and sparse hits coincide."""
    d, s = dense_cosine_topk(spark, sf_dir), sparse_dot_topk(spark, sf_dir)
    both = d.select("query_id", "id").join(s.select("query_id", "id", F.lit(1).alias("hit")), ["query_id", "id"], "left")
    return both.groupBy("query_id").agg(F.count("hit").alias("overlap"))


def two_stage_search(spark, sf_dir):
    """Five clusters by the dense and five by the sparse centroid, members of both, both scores and where each came from."""
    v = _vectors(spark, sf_dir)
    return V.two_stage(_queries(v), v, _sparse(spark, sf_dir), "label")


def _cluster_nodes(spark, sf_dir):
    v = _vectors(spark, sf_dir).withColumn("text", F.concat(F.lit("node "), "id"))
    return V.cluster_nodes(v, V.to_sparse(v, 0.1), "label")


def cluster_nodes(spark, sf_dir):
    """Members, and both centroids as numbers of entries and sums."""
    n = _cluster_nodes(spark, sf_dir)[0]
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda s, x: s + x), 4)
    return n.select("label", F.array_join(F.transform("members", lambda x: x.cast("string")), ",").alias("members"), F.size("dense").alias("dims"), total(F.col("dense")).alias("dense_sum"), F.size("sparse").alias("terms"), total(F.transform("sparse", lambda x: x["value"])).alias("sparse_sum"))


def cluster_texts(spark, sf_dir):
    return _cluster_nodes(spark, sf_dir)[1]


def _points(spark, sf_dir):
    return _vectors(spark, sf_dir).select("id", F.col("v").alias("text_dense"), F.create_map(F.lit("_node_type"), F.when(F.col("id") % 2 == 0, "parent").otherwise("child"), F.lit("label"), F.col("label").cast("string")).alias("payload"))


def scroll_points(spark, sf_dir):
    return V.scroll(_points(spark, sf_dir), {"_node_type": "child"}, 5000).select("id", F.col("payload")["label"].alias("label"))


def payload_rewrite(spark, sf_dir):
    p = V.with_payload(_points(spark, sf_dir), {"label": None, "origin": F.concat(F.lit("o"), "id")})
    return p.select("id", F.array_join(F.array_sort(F.map_keys("payload")), ",").alias("keys"), F.col("payload")["origin"].alias("origin"), F.size("text_dense").alias("dims"))


def zero_vector_topk(spark, sf_dir):
    """All vectors against all; every third one is zero: it finds nothing and is not found."""
    v = _vectors(spark, sf_dir).select("id", F.when(F.col("id") % 3 == 0, F.transform("v", lambda x: x * 0)).otherwise(F.col("v")).alias("v"))
    return V.cosine_topk(v.select(F.col("id").alias("query_id"), F.col("v").alias("q")), v, K)


def empty_prints(spark, sf_dir):
    """All fingerprints against all; those without a bit are similar to none, each other included."""
    none = F.transform("fp", lambda w: F.lit(0).cast("bigint"))
    p = _prints(spark, sf_dir).withColumn("fp", F.when(F.col("id") % 3 == 0, none).otherwise(F.col("fp")))
    return P.search(p.select(F.col("id").alias("query_id"), F.col("fp").alias("q")), p, 0.45)


def match_report(spark, sf_dir):
    """Hits of the two-stage search with both scores, where they came from, and labels and texts (as digests) of query and hit
    looked up; by query, best sum of scores first."""
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.md5(F.coalesce("text", F.lit(""))).alias("text"))
    v = _vectors(spark, sf_dir)
    return V.two_stage_report(_queries(v), v, _sparse(spark, sf_dir), "label", v.select("id", "label").join(d, "id"))


def _prints(spark, sf_dir):
    return _vectors(spark, sf_dir).select("id", P.sign_bits(F.col("v")).alias("fp"))


def tanimoto_pairs(spark, sf_dir):
    p = _prints(spark, sf_dir)
    return P.search(p.select(F.col("id").alias("query_id"), F.col("fp").alias("q")).where("query_id % 100 = 0"), p, 0.45)


def tanimoto_topk(spark, sf_dir):
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    return tanimoto_pairs(spark, sf_dir).withColumn("rank", F.row_number().over(w)).where("rank <= 3")


#: Bits of a compound's fingerprint: sixteen levels for each of 64 components.
LEVELS = 16
COMPOUND_BITS = 64 * LEVELS


def compound_prints(spark, sf_dir):
    """Fingerprints of parts as compounds, of which a family shares a vector: the first has the vector's levels, a bit a
    component, the others have a few components the other way round."""
    v = _vectors(spark, sf_dir)
    parts = table(spark, sf_dir, "part").select("p_partkey").join(v.agg(F.count("*").alias("n")))
    parts = parts.select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % F.col("n")).alias("family"), F.expr("p_partkey div n").alias("k"))
    both = parts.join(v.select(F.col("id").alias("family"), "v"), "family")

    def run(batches):
        for batch in batches:
            size = np.asarray(batch.column("v").value_lengths())
            x = batch.column("v").flatten().to_numpy().astype(np.float64)
            row = np.repeat(np.arange(len(batch)), size)
            i = np.arange(len(x)) - np.repeat(np.cumsum(size) - size, size)
            k = batch.column("k").to_numpy()[row]
            bit = 16 * i + np.clip(np.floor((np.where((k > 0) & ((i + 5 * k) % 16 == 0), -x, x) + 0.4) / 0.05), 0, 15).astype(np.int64)
            words = np.zeros((len(batch), COMPOUND_BITS // 64), np.uint64)
            np.bitwise_or.at(words, (row, bit // 64), np.uint64(1) << (bit % 64).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(np.arange(len(batch) + 1, dtype=np.int32) * words.shape[1], pa.array(words.view(np.int64).reshape(-1)))], names=["id", "fp"])

    return both.select("id", "k", "v").mapInArrow(run, "id bigint, fp array<bigint>")


def tanimoto_members(spark, sf_dir):
    """Each compound with the least id of its fingerprint, which stands for it in ``tanimoto_links``."""
    return P.members(compound_prints(spark, sf_dir))


def tanimoto_links(spark, sf_dir):
    """Similar-to edges of all compounds, by the usual threshold; ends are ids of ``tanimoto_members``."""
    return P.links(compound_prints(spark, sf_dir), 0.85, LEVELS)


def compound_links(spark, sf_dir):
    """``tanimoto_links`` between all compounds: those that share a fingerprint are each an end, and similar to each other."""
    return P.every_link(compound_prints(spark, sf_dir), 0.85, LEVELS)


def match_similar(spark, sf_dir):
    """Similar vectors of the queries (ids divisible by 100), counted by label."""
    e = tanimoto_pairs(spark, sf_dir).where("query_id <> id")
    v = _vectors(spark, sf_dir).select("id", "label")
    return e.join(v, "id").groupBy("query_id", "label").agg(F.count("*").alias("n"), F.max("similarity").alias("best"))


_V = "v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS v, label FROM embeddings)"
_COS = "list_dot_product({0}, {1}) / (sqrt(list_dot_product({0}, {0})) * sqrt(list_dot_product({1}, {1})))"
_TOP = f"{_V}, sc AS (SELECT a.id AS query_id, b.id, round({_COS.format('a.v', 'b.v')}, 6) AS score FROM v a, v b WHERE a.id % 100 = 0), top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INTEGER AS rank FROM sc) WHERE rank <= {K})"
_S = f"{_V}, s0 AS (SELECT id, label, (generate_subscripts(v, 1) - 1)::INTEGER AS index, unnest(v) AS value FROM v), s AS (SELECT * FROM s0 WHERE value > 0.1)"
_STOP = f"{_S}, ss AS (SELECT a.id AS query_id, b.id, round(sum(a.value * b.value), 6) AS score FROM s a JOIN s b ON a.index = b.index WHERE a.id % 100 = 0 GROUP BY 1, 2), stop AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INTEGER AS rank FROM ss) WHERE rank <= {K})"
_CEN = "cen AS (SELECT label, index, round(avg(value), 6) AS value FROM s0 GROUP BY 1, 2)"
_SCEN = """mem AS (SELECT label, id, count(*) AS dims, pow(sum(value * value), 1.0::DOUBLE / count(*)) AS len FROM s GROUP BY 1, 2), av AS (SELECT label, floor(avg(dims)) AS keep, avg(len) AS avg_len FROM mem GROUP BY 1),
        sums AS (SELECT label, index, sum(value) AS total FROM s GROUP BY 1, 2), stop5 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(total, 9) DESC, index) AS rn FROM sums) JOIN av USING (label) WHERE rn <= keep),
        own AS (SELECT label, pow(sum(total * total), 1.0::DOUBLE / count(*)) AS own_len FROM stop5 GROUP BY 1), scen AS (SELECT label, index, round(total * avg_len / own_len, 6) AS value FROM stop5 JOIN own USING (label))"""
_FP = f"{_V}, bits AS (SELECT id, bit_or(CASE WHEN x > 0 THEN CASE WHEN i = 64 THEN (-9223372036854775808)::BIGINT ELSE (1::BIGINT << (i - 1)::INTEGER) END ELSE 0::BIGINT END) AS fp FROM (SELECT id, generate_subscripts(v, 1) AS i, unnest(v) AS x FROM v) GROUP BY 1), pr AS (SELECT a.id AS query_id, b.id, round(bit_count(a.fp & b.fp) / bit_count(a.fp | b.fp), 6) AS similarity FROM bits a, bits b WHERE a.id % 100 = 0 AND bit_count(a.fp & b.fp) / bit_count(a.fp | b.fp) >= 0.45)"
_ALL = _FP[: _FP.index(", pr AS")]
_COMPOUND = """cfam AS (SELECT p_partkey AS id, p_partkey // n AS k, embedding::DOUBLE[] AS v FROM part, (SELECT count(*) AS n FROM embeddings) JOIN embeddings ON vec_id = p_partkey % n),
        cbits AS (SELECT id, list_transform(range(0, len(v)), lambda i: 16 * i + least(15, greatest(0, floor(((CASE WHEN k > 0 AND (i + 5 * k) % 16 = 0 THEN -v[i + 1] ELSE v[i + 1] END) + 0.4::DOUBLE) / 0.05::DOUBLE)))::INTEGER) AS bits FROM cfam),
        cone AS (SELECT bits, min(id) AS id FROM cbits GROUP BY 1), clong AS (SELECT id, len(bits) AS n, unnest(bits) AS bit FROM cone), cpair AS (SELECT a.id AS query_id, b.id, a.n + b.n AS n, count(*) AS c FROM clong a JOIN clong b USING (bit) GROUP BY ALL),
        links AS (SELECT query_id, id, round(c / (n - c), 6) AS similarity FROM cpair WHERE c / (n - c) >= 0.85)"""
#: The similarity join as common table expressions.
SIMILAR_SQL = _COMPOUND
#: Behind it, the links of all compounds, copies as ends of their own.
EVERY_SQL = """cmem AS (SELECT id, min(id) OVER (PARTITION BY bits) AS least FROM cbits),
        every AS (SELECT a.id AS query_id, b.id, similarity FROM links l JOIN cmem a ON a.least = l.query_id JOIN cmem b ON b.least = l.id)"""

ORACLE = {
    "dense_cosine_topk": f"WITH {_TOP} SELECT * FROM top",
    "dense_centroids": f"WITH {_S}, {_CEN} SELECT * FROM cen",
    "sparse_vectors": f"WITH {_S} SELECT id, index, round(value, 6) AS value FROM s",
    "sparse_dot_topk": f"WITH {_STOP} SELECT * FROM stop",
    "sparse_centroids": f"WITH {_S}, {_SCEN} SELECT * FROM scen",
    "topk_overlap": f"WITH {_TOP}, {_STOP[len(_V) + 2:]} SELECT t.query_id, count(u.id) AS overlap FROM top t LEFT JOIN stop u ON t.query_id = u.query_id AND t.id = u.id GROUP BY 1",
    "two_stage_search": f"""WITH {_S}, {_CEN}, {_SCEN}, q AS (SELECT id AS query_id, v AS q FROM v WHERE id % 100 = 0), cv AS (SELECT label, list(value ORDER BY index) AS c FROM cen GROUP BY 1),
        dh AS (SELECT query_id, label FROM (SELECT query_id, label, row_number() OVER (PARTITION BY query_id ORDER BY round({_COS.format('q', 'c')}, 6) DESC, label) AS rn FROM q, cv) WHERE rn <= 5),
        sq AS (SELECT s.id AS query_id, index, value AS qv FROM s JOIN q ON s.id = q.query_id), sh AS (SELECT query_id, label FROM (SELECT query_id, label, row_number() OVER (PARTITION BY query_id ORDER BY round(sum(qv * value), 6) DESC, label) AS rn FROM sq JOIN scen USING (index) GROUP BY 1, 2) WHERE rn <= 5),
        h AS (SELECT query_id, label, max(d) AS in_dense, max(p) AS in_sparse FROM (SELECT *, 1 AS d, 0 AS p FROM dh UNION ALL SELECT *, 0, 1 FROM sh) GROUP BY 1, 2),
        dp AS (SELECT query_id, s.id, sum(qv * value) AS sparse FROM sq JOIN s USING (index) GROUP BY 1, 2), sc AS (SELECT h.query_id, v.id, in_dense, in_sparse, {_COS.format('q.q', 'v.v')} AS dense, coalesce(sparse, 0) AS sparse FROM h JOIN v USING (label) JOIN q USING (query_id) LEFT JOIN dp ON dp.query_id = h.query_id AND dp.id = v.id)
        SELECT query_id, id, round(dense / max(dense) OVER (PARTITION BY query_id), 6) AS dense, round(sparse / max(sparse) OVER (PARTITION BY query_id), 6) AS sparse, in_dense, in_sparse FROM sc""",
    "cluster_nodes": f"""WITH {_S}, {_CEN}, {_SCEN} SELECT label, members, dims, dense_sum, coalesce(terms, 0)::INTEGER AS terms, coalesce(sparse_sum, 0) AS sparse_sum FROM (SELECT label, string_agg(id::VARCHAR, ',' ORDER BY id) AS members FROM v GROUP BY 1)
        JOIN (SELECT label, count(*)::INTEGER AS dims, round(sum(value ORDER BY index), 4) AS dense_sum FROM cen GROUP BY 1) USING (label) LEFT JOIN (SELECT label, count(*) AS terms, round(sum(value ORDER BY index), 4) AS sparse_sum FROM scen GROUP BY 1) USING (label)""",
    "cluster_texts": f"WITH {_V} SELECT label, id, 'node ' || id AS text FROM v",
    "scroll_points": f"WITH {_V} SELECT id, label::VARCHAR AS label FROM v WHERE id % 2 = 1 ORDER BY id LIMIT 5000",
    "payload_rewrite": f"WITH {_V} SELECT id, '_node_type,origin' AS keys, 'o' || id AS origin, len(v)::INTEGER AS dims FROM v",
    "zero_vector_topk": f"""WITH {_V}, sc AS (SELECT a.id AS query_id, b.id, round({_COS.format('a.v', 'b.v')}, 6) AS score FROM v a, v b WHERE a.id % 3 <> 0 AND b.id % 3 <> 0)
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INTEGER AS rank FROM sc) WHERE rank <= {K}""",
    "empty_prints": f"WITH {_ALL} SELECT a.id AS query_id, b.id, round(bit_count(a.fp & b.fp) / bit_count(a.fp | b.fp), 6) AS similarity FROM bits a, bits b WHERE a.id % 3 <> 0 AND b.id % 3 <> 0 AND bit_count(a.fp & b.fp) / bit_count(a.fp | b.fp) >= 0.45",
    "tanimoto_pairs": f"WITH {_FP} SELECT * FROM pr",
    "tanimoto_topk": f"WITH {_FP} SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id)::INTEGER AS rank FROM pr) WHERE rank <= 3",
    "tanimoto_members": f"WITH {_COMPOUND} SELECT id, min(id) OVER (PARTITION BY bits) AS least FROM cbits",
    "tanimoto_links": f"WITH {_COMPOUND} SELECT * FROM links",
    "match_similar": f"WITH {_FP} SELECT query_id, label, count(*) AS n, max(similarity) AS best FROM pr JOIN v USING (id) WHERE query_id <> id GROUP BY 1, 2",
}
ORACLE["match_report"] = f"""WITH r AS ({ORACLE["two_stage_search"]}), n AS (SELECT vec_id, label, md5(coalesce(text, '')) AS text FROM embeddings JOIN documents ON vec_id = doc_id)
    SELECT query_id, a.label AS query_label, a.text AS query_text, id, b.label AS hit_label, b.text AS hit_text, dense, sparse, in_dense, in_sparse, round(dense + sparse, 6) AS total FROM r JOIN n a ON a.vec_id = query_id JOIN n b ON b.vec_id = id"""
QUERIES = {k: globals()[k] for k in ORACLE}
