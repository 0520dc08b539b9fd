"""Compounds (parts), targets (suppliers), mechanisms (lines) and indications (orders) as a graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from medloom.operators import graph as G
from medloom.operators.patterns import Clause, of_edges, solve
from medloom.plans.vector_queries import EVERY_SQL, SIMILAR_SQL, compound_links, tanimoto_links
from medloom.session import table

PHASES = {None: "Unknown", 1: "Early phase", 5: "Phase 1", 10: "Phase 2", 20: "Phase 3", 30: "Phase 4", 50: "Approved"}


def _parts(spark, sf_dir):
    return table(spark, sf_dir, "part")


def _mechanisms(spark, sf_dir):
    """One for each compound, action and way of its lines, with their least target."""
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_partkey", "l_returnflag", "l_linestatus").agg(F.min("l_suppkey").alias("l_suppkey"))


def _indications(spark, sf_dir):
    """One for each compound and priority of the orders that hold it."""
    li, o = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return li.join(o.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_partkey", "o_orderpriority").distinct()


def compound_info(spark, sf_dir):
    df = _parts(spark, sf_dir).select("p_partkey", "p_name", "p_brand", G.value_map("p_size", PHASES).alias("max_phase"), F.round("p_retailprice", 2).cast("int").alias("price"))
    return G.stringify(df)


def compound_lookup(spark, sf_dir):
    return G.lookup(_parts(spark, sf_dir), {"key": "p_partkey", "brand": "p_brand", "name": "p_name"}, "brand", "Brand#13", "p_name").select("p_partkey", "p_name", "p_brand")


def target_info(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "full").where("s_suppkey is not null")
    return G.stringify(s.select(F.col("s_suppkey").alias("tid"), F.col("s_name").alias("target_name"), F.col("n_name").alias("organism")))


def compound_synonyms(spark, sf_dir):
    words = _parts(spark, sf_dir).select("p_partkey", F.explode(F.split("p_name", " ")).alias("synonym"))
    return words.where("synonym <> ''").distinct()


def mechanism_info(spark, sf_dir):
    """A chain of full joins kept to rows of the first table."""
    p = _parts(spark, sf_dir)
    m = _mechanisms(spark, sf_dir)
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = p.join(m, F.col("p_partkey") == F.col("l_partkey"), "full").join(s, F.col("l_suppkey") == F.col("s_suppkey"), "full")
    j = j.join(n, F.col("s_nationkey") == F.col("n_nationkey"), "full").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "full")
    return G.stringify(j.where("p_partkey is not null and p_name is not null").select("p_partkey", "p_name", F.col("s_suppkey").alias("tid"), "n_name", "r_name", "l_linestatus"))


def indication_info(spark, sf_dir):
    i = _indications(spark, sf_dir)
    j = i.join(_parts(spark, sf_dir), F.col("l_partkey") == F.col("p_partkey"), "full")
    return G.stringify(j.where("l_partkey is not null").select(F.col("o_orderpriority").alias("mesh_heading"), "p_partkey", "p_name", "p_brand"))


MECHANISM = ["action_type", "mechanism_of_action", "reference_type", "compound_name", "compound_key", "source_name", "source_description"]
INDICATION = ["mesh_heading", "reference_type", "compound_name", "compound_key", "source_name", "source_description"]


def _similar(spark, sf_dir, links=tanimoto_links):
    """Similar-to edges of compounds by their fingerprints, with the similarity."""
    name = lambda c: F.concat(F.col(c).cast("string"), F.lit("_compound"))
    return links(spark, sf_dir).where("query_id <> id").select(F.lit("similar_to").alias("type"), name("query_id").alias("src"), name("id").alias("dst"), "similarity")


def _compounds(spark, sf_dir):
    """Vertices and edges of compounds and their values."""
    c = G.stringify(_parts(spark, sf_dir).select("p_partkey", F.col("p_name").alias("molecule_name"), F.col("p_brand").alias("chembl_id"), F.col("p_type").alias("molecule_type")))
    return G.attribute_graph(c, "p_partkey", "compound_details", ["molecule_name", "chembl_id", "molecule_type"], suffix="_compound")


def _graph(spark, sf_dir, similar=tanimoto_links):
    """Vertices and edges; ``similar`` gives the links of compounds, which are left out where it is None."""
    t = G.stringify(table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", F.col("s_name").alias("target_name"), F.col("n_name").alias("organism")))
    cv, ce = _compounds(spark, sf_dir)
    tv, te = G.attribute_graph(t, "s_suppkey", "target_details", ["target_name", "organism"], suffix="_target")
    # no side that grows with the tables is broadcast: files are far smaller than their rows, and those pass through the driver
    parts = _parts(spark, sf_dir)
    compound = F.concat(F.col("l_partkey"), F.lit("_compound"))
    m = _mechanisms(spark, sf_dir).join(parts.hint("merge"), F.col("l_partkey") == F.col("p_partkey"), "left")
    places = table(spark, sf_dir, "supplier").join(F.broadcast(table(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    m = m.join(places.hint("merge"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    m = G.stringify(m.select("l_partkey", "l_suppkey", *(F.col(c).alias(n) for c, n in zip(["l_returnflag", "l_linestatus", "p_type", "p_name", "p_brand", "n_name", "r_name"], MECHANISM, strict=True))))
    m = m.withColumn("uid", F.concat_ws("-", "l_partkey", "action_type", "mechanism_of_action"))
    mv, me = G.attribute_graph(m, "uid", "drug_mechanism", MECHANISM, suffix="_mechanism")
    target = F.when(F.col("l_suppkey") != "", F.concat(F.col("l_suppkey"), F.lit("_target"))).otherwise("")
    i = _indications(spark, sf_dir).join(parts.hint("merge"), F.col("l_partkey") == F.col("p_partkey"), "left").withColumn("price", F.round("p_retailprice", 2).cast("int"))
    i = G.stringify(i.select("l_partkey", *(F.col(c).alias(n) for c, n in zip(["o_orderpriority", "p_type", "p_name", "p_brand", "p_size", "price"], INDICATION, strict=True))))
    i = i.withColumn("uid", F.concat_ws("-", "l_partkey", "mesh_heading"))
    iv, ie = G.attribute_graph(i, "uid", "drug_indication", INDICATION, suffix="_indication")
    syn = compound_synonyms(spark, sf_dir).select(F.col("synonym"), F.col("p_partkey").cast("string").alias("k"))
    sv = syn.select(F.lit("molecule_synonym").alias("tag"), F.lower("synonym").alias("id"), F.col("synonym").alias("value"))
    # a value of several entities is one vertex
    vertices = cv.unionByName(tv).unionByName(mv).unionByName(iv).unionByName(sv).groupBy("tag", "id").agg(F.min("value").alias("value"))
    edges = ce.unionByName(te).unionByName(me).unionByName(ie)
    mechanism, indication = F.concat("uid", F.lit("_mechanism")), F.concat("uid", F.lit("_indication"))
    edges = edges.unionByName(G.link_edges(m, "compound_of", compound, mechanism)).unionByName(G.link_edges(m, "target_of", target, mechanism)).unionByName(G.link_edges(i, "compound_of", compound, indication))
    if similar:
        edges = edges.unionByName(_similar(spark, sf_dir, similar).drop("similarity"))
    return vertices, edges.unionByName(G.link_edges(syn, "synonym_of", F.col("synonym"), F.concat(F.col("k"), F.lit("_compound"))))


def graph_similar_edges(spark, sf_dir):
    return _similar(spark, sf_dir)


def graph_vertices(spark, sf_dir):
    return _graph(spark, sf_dir, similar=None)[0]


def graph_edges(spark, sf_dir):
    return _graph(spark, sf_dir)[1]


def graph_tag_counts(spark, sf_dir):
    v, e = _graph(spark, sf_dir)
    return v.groupBy(F.col("tag").alias("name")).agg(F.count("*").alias("n")).unionByName(e.groupBy(F.col("type").alias("name")).agg(F.count("*").alias("n")))


def _match(spark, sf_dir, clauses, out, values=None, similar=None):
    """A pattern over the graph's edges; its first values reach the tables that the edges are made of."""
    return solve(of_edges(_graph(spark, sf_dir, similar)[1]), [Clause(*c) for c in clauses], out, values)


def match_similar_compounds(spark, sf_dir):
    """The compounds of all values, and those that are similar to them, copies too; mechanisms and indications are no part of
    it, as they are similar to nothing."""
    edges = _compounds(spark, sf_dir)[1].unionByName(_similar(spark, sf_dir, compound_links).drop("similarity"))
    return solve(of_edges(edges), [Clause("?value", "has_parent", "?compound"), Clause("?compound", "similar_to", "?similar")], ["?compound", "?similar"])


def match_details(spark, sf_dir):
    """From a value to its compounds, and on to all of their values."""
    return _match(spark, sf_dir, [("?input", "has_parent", "?compound"), ("?detail", "has_parent", "?compound")], ["?input", "?compound", "?detail"], {"?input": ["brand#13"]})


def match_synonyms(spark, sf_dir):
    return _match(spark, sf_dir, [("brand#13", "has_parent", "?compound"), ("?synonym", "synonym_of", "?compound")], ["?compound", "?synonym"])


def match_indications(spark, sf_dir):
    """A value's compounds, and what they are of by edges of any type: mechanisms, indications and all similar compounds."""
    return _match(spark, sf_dir, [("?input", None, "?mid"), ("?mid", None, "?found")], ["?input", "?mid", "?found"], {"?input": ["brand#22"]}, compound_links)


def match_mechanism_targets(spark, sf_dir):
    """Value to compound, compound to mechanism, and against the edge to the target."""
    clauses = [("?brand", "has_parent", "?compound"), ("?compound", "compound_of", "?mechanism"), ("?target", "target_of", "?mechanism")]
    return _match(spark, sf_dir, clauses, ["?compound", "?mechanism", "?target"], {"?brand": ["brand#13", "brand#22"]})


def match_shared_values(spark, sf_dir):
    """Compounds that have a target in common with those of a value: out to mechanisms, to their target and back again."""
    clauses = [("brand#13", "has_parent", "?compound"), ("?compound", "compound_of", "?one"), ("?target", "target_of", "?one"), ("?target", "target_of", "?two"), ("?other", "compound_of", "?two")]
    return _match(spark, sf_dir, clauses, ["?compound", "?target", "?other"])


_PAIRS = "pairs AS (SELECT l_partkey, min(l_suppkey) AS l_suppkey, l_returnflag, l_linestatus FROM lineitem GROUP BY 1, 3, 4)"
_IND = "ind AS (SELECT DISTINCT l_partkey, o_orderpriority FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
_SYN = "syn AS (SELECT DISTINCT p_partkey, unnest(string_split(p_name, ' ')) AS synonym FROM part), syns AS (SELECT * FROM syn WHERE synonym <> '')"
_GRAPH = f"""{_PAIRS}, {_IND}, {_SYN}, {SIMILAR_SQL}, c AS (SELECT p_partkey || '_compound' AS root, unnest(['molecule_name', 'chembl_id', 'molecule_type']) AS tag, unnest([p_name, p_brand, p_type]) AS value FROM part),
    t AS (SELECT s_suppkey || '_target' AS root, unnest(['target_name', 'organism']) AS tag, unnest([s_name, n_name]) AS value FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
    m AS (SELECT l_partkey || '-' || lower(l_returnflag) || '-' || lower(l_linestatus) || '_mechanism' AS root, l_partkey, l_suppkey, l_returnflag, l_linestatus, p_type, p_name, p_brand, n_name, r_name
        FROM pairs LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN (supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey) ON l_suppkey = s_suppkey),
    i AS (SELECT l_partkey || '-' || lower(o_orderpriority) || '_indication' AS root, l_partkey, o_orderpriority, p_type, p_name, p_brand, p_size, trunc(round(p_retailprice, 2))::INTEGER AS price FROM ind LEFT JOIN part ON l_partkey = p_partkey),
    sim AS (SELECT query_id || '_compound' AS src, id || '_compound' AS dst, similarity FROM links WHERE query_id <> id),
    vals AS (SELECT root, tag, value FROM c UNION ALL SELECT root, tag, value FROM t
        UNION ALL SELECT root, unnest(['action_type', 'mechanism_of_action', 'reference_type', 'compound_name', 'compound_key', 'source_name', 'source_description']), unnest([l_returnflag, l_linestatus, p_type, p_name, p_brand, n_name, r_name]) FROM m
        UNION ALL SELECT root, unnest(['mesh_heading', 'reference_type', 'compound_name', 'compound_key', 'source_name', 'source_description']), unnest([o_orderpriority, p_type, p_name, p_brand, p_size::VARCHAR, price::VARCHAR]) FROM i),
    v AS (SELECT tag, id, min(value) AS value FROM (SELECT tag, lower(value) AS id, value FROM vals WHERE value <> ''
        UNION ALL SELECT 'compound_details', p_partkey || '_compound', p_partkey || '_compound' FROM part UNION ALL SELECT 'target_details', s_suppkey || '_target', s_suppkey || '_target' FROM supplier
        UNION ALL SELECT 'drug_mechanism', root, root FROM m UNION ALL SELECT 'drug_indication', root, root FROM i UNION ALL SELECT 'molecule_synonym', lower(synonym), synonym FROM syns) GROUP BY 1, 2),
    e AS (SELECT DISTINCT 'has_parent' AS type, lower(value) AS src, root AS dst FROM vals WHERE value <> ''
        UNION ALL SELECT DISTINCT 'compound_of', l_partkey || '_compound', root FROM m UNION ALL SELECT DISTINCT 'target_of', l_suppkey || '_target', root FROM m
        UNION ALL SELECT DISTINCT 'compound_of', l_partkey || '_compound', root FROM i UNION ALL SELECT 'similar_to', src, dst FROM sim
        UNION ALL SELECT DISTINCT 'synonym_of', lower(synonym), p_partkey || '_compound' FROM syns)"""
#: The same graph with the similar-to edges of all compounds, copies too.
_WHOLE = _GRAPH.replace(SIMILAR_SQL, f"{SIMILAR_SQL}, {EVERY_SQL}").replace("FROM links WHERE query_id <> id", "FROM every WHERE query_id <> id")

ORACLE = {
    "compound_info": """SELECT p_partkey::VARCHAR AS p_partkey, coalesce(p_name, '') AS p_name, coalesce(p_brand, '') AS p_brand,
        coalesce(CASE WHEN p_size IS NULL THEN 'Unknown' WHEN p_size = 1 THEN 'Early phase' WHEN p_size = 5 THEN 'Phase 1' WHEN p_size = 10 THEN 'Phase 2' WHEN p_size = 20 THEN 'Phase 3' WHEN p_size = 30 THEN 'Phase 4' WHEN p_size = 50 THEN 'Approved' END, '') AS max_phase,
        coalesce(trunc(round(p_retailprice, 2))::INTEGER::VARCHAR, '') AS price FROM part""",
    "compound_lookup": "SELECT p_partkey, p_name, p_brand FROM part WHERE p_brand = 'Brand#13' AND p_name IS NOT NULL",
    "target_info": "SELECT s_suppkey::VARCHAR AS tid, coalesce(s_name, '') AS target_name, coalesce(n_name, '') AS organism FROM supplier FULL JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey IS NOT NULL",
    "compound_synonyms": f"WITH {_SYN} SELECT * FROM syns",
    "mechanism_info": f"""WITH {_PAIRS} SELECT p_partkey::VARCHAR AS p_partkey, p_name, coalesce(s_suppkey::VARCHAR, '') AS tid, coalesce(n_name, '') AS n_name, coalesce(r_name, '') AS r_name, coalesce(l_linestatus, '') AS l_linestatus
        FROM part FULL JOIN pairs ON p_partkey = l_partkey FULL JOIN supplier ON l_suppkey = s_suppkey FULL JOIN nation ON s_nationkey = n_nationkey FULL JOIN region ON n_regionkey = r_regionkey WHERE p_partkey IS NOT NULL AND p_name IS NOT NULL""",
    "indication_info": f"""WITH {_IND} SELECT o_orderpriority AS mesh_heading, coalesce(p_partkey::VARCHAR, '') AS p_partkey, coalesce(p_name, '') AS p_name, coalesce(p_brand, '') AS p_brand
        FROM ind FULL JOIN part ON l_partkey = p_partkey WHERE l_partkey IS NOT NULL""",
    "graph_similar_edges": f"WITH {_GRAPH} SELECT 'similar_to' AS type, src, dst, similarity FROM sim",
    "match_similar_compounds": f"WITH {_WHOLE} SELECT DISTINCT a.dst AS compound, b.dst AS similar FROM e a JOIN e b ON a.dst = b.src AND b.type = 'similar_to' WHERE a.type = 'has_parent'",
    "graph_vertices": f"WITH {_GRAPH} SELECT * FROM v",
    "graph_edges": f"WITH {_GRAPH} SELECT * FROM e",
    "graph_tag_counts": f"WITH {_GRAPH} SELECT tag AS name, count(*) AS n FROM v GROUP BY 1 UNION ALL SELECT type, count(*) FROM e GROUP BY 1",
    "match_details": f"WITH {_GRAPH} SELECT DISTINCT a.src AS input, a.dst AS compound, b.src AS detail FROM e a JOIN e b ON a.dst = b.dst AND b.type = 'has_parent' WHERE a.type = 'has_parent' AND a.src = 'brand#13'",
    "match_synonyms": f"WITH {_GRAPH} SELECT DISTINCT a.dst AS compound, b.src AS synonym FROM e a JOIN e b ON a.dst = b.dst AND b.type = 'synonym_of' WHERE a.type = 'has_parent' AND a.src = 'brand#13'",
    "match_indications": f"WITH {_WHOLE} SELECT DISTINCT a.src AS input, a.dst AS mid, b.dst AS found FROM e a JOIN e b ON a.dst = b.src WHERE a.src = 'brand#22'",
    "match_shared_values": f"WITH {_GRAPH} SELECT DISTINCT a.dst AS compound, t1.src AS target, o.src AS other FROM e a JOIN e m ON a.dst = m.src AND m.type = 'compound_of' JOIN e t1 ON t1.dst = m.dst AND t1.type = 'target_of' JOIN e t2 ON t2.src = t1.src AND t2.type = 'target_of' JOIN e o ON o.dst = t2.dst AND o.type = 'compound_of' WHERE a.type = 'has_parent' AND a.src = 'brand#13'",
    "match_mechanism_targets": f"WITH {_GRAPH} SELECT DISTINCT a.dst AS compound, b.dst AS mechanism, c.src AS target FROM e a JOIN e b ON a.dst = b.src AND b.type = 'compound_of' JOIN e c ON b.dst = c.dst AND c.type = 'target_of' WHERE a.type = 'has_parent' AND a.src IN ('brand#13', 'brand#22')",
}
QUERIES = {k: globals()[k] for k in ORACLE}
