"""Findings of round 4: whole links, odd texts, what is sent."""

import duckdb
import numpy as np
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def copies(tmp_path_factory):
    """Families of more than 17 compounds, in which members share fingerprints; brands of any number."""
    out = tmp_path_factory.mktemp("copies")
    con = duckdb.connect()
    for name in ("supplier", "nation", "region", "lineitem", "orders"):
        con.execute(f"COPY (SELECT * FROM '{SF}/{name}.parquet') TO '{out}/{name}.parquet'")
    con.execute(f"COPY (SELECT * FROM '{SF}/embeddings.parquet' WHERE vec_id < 5) TO '{out}/embeddings.parquet'")
    con.execute(f"COPY (SELECT * REPLACE ('Brand#' || [7, 22][1 + p_partkey % 2] AS p_brand) FROM '{SF}/part.parquet') TO '{out}/part.parquet'")
    for name in ("part", "embeddings", "supplier", "nation", "region", "lineitem", "orders"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{out}/{name}.parquet'")
    return str(out), con


def _brute(con):
    """All ordered pairs of different compounds from a similarity of 0.85 on, each compared with each."""
    v = {i: np.array(x, float) for i, x in con.execute("SELECT vec_id, embedding FROM embeddings").fetchall()}
    i = np.arange(64)
    levels = {}
    for p in (p for (p,) in con.execute("SELECT p_partkey FROM part").fetchall()):
        k, x = p // len(v), v[p % len(v)]
        levels[p] = np.clip(np.floor((np.where((k > 0) & ((i + 5 * k) % 16 == 0), -x, x) + 0.4) / 0.05), 0, 15)
    same = lambda a, b: (levels[a] == levels[b]).sum()
    return {(a, b) for a in levels for b in levels if a != b and same(a, b) / (128 - same(a, b)) >= 0.85}


def test_similar_compounds_with_copies_and_all_brands(spark, copies):
    from medloom.plans import graph_queries as Q

    path, con = copies
    want = {(f"{a}_compound", f"{b}_compound") for a, b in _brute(con)}
    got = Q.match_similar_compounds(spark, path).collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert set(con.execute(Q.ORACLE["match_similar_compounds"]).fetchall()) == want


def test_indications_with_copies(spark, copies):
    from medloom.plans import graph_queries as Q

    path, con = copies
    brand = {f"{p}_compound" for (p,) in con.execute("SELECT p_partkey FROM part WHERE p_brand = 'Brand#22'").fetchall()}
    want = {(f"{a}_compound", f"{b}_compound") for a, b in _brute(con) if f"{a}_compound" in brand}
    got = {tuple(r) for r in Q.match_indications(spark, path).collect()}
    assert {(m, f) for _, m, f in got if f.endswith("_compound")} == want
    assert set(con.execute(Q.ORACLE["match_indications"]).fetchall()) == got


def test_sections_of_odd_texts(spark, tmp_path):
    from medloom.plans import source_queries as Q

    texts = ["", "  \n ", "a  b\n\nc", "see xlink:href and <b xmlns=\"x\"> or xmlns=\"y\" & <!DOCTYPE z>", None, "d\r\ne", "\x01\nf"]
    rows = [*enumerate(texts), (None, "no number")]
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(Q.ORACLE["jats_sections"]).fetchall()
    assert len(want) == 7
    assert sorted(map(str, map(tuple, Q.jats_sections(spark, str(tmp_path)).collect()))) == sorted(map(str, want))


def test_namespaces_go_from_tags_only():
    from medloom.sources import jats

    xml = '<?xml version="1.0"?><!DOCTYPE article PUBLIC "-//x//DTD v1.2//EN" "a.dtd"><article xmlns:xlink="http://x" xmlns="http://y"><front><article-meta><article-id pub-id-type="pmc">P1</article-id></article-meta></front><body><sec xlink:href="q"><title>T</title><p>xlink:a <ext xlink:href="u>v">in</ext> xmlns="w"</p></sec></body></article>'
    assert [c["text"] for c in jats.parse(xml)["contents"]] == ['xlink:a in xmlns="w"']


def test_shared_values_broadcast_no_table_that_grows(spark):
    from medloom.plans import graph_queries as Q

    plan = Q.match_shared_values(spark, SF)._jdf.queryExecution().executedPlan().toString()
    sent = [x for x in plan.splitlines() if "BroadcastHashJoin" in x or "BroadcastNestedLoopJoin" in x]
    assert sent and all("n_nationkey" in x or "r_regionkey" in x for x in sent)


def test_search_sends_members_once(spark, monkeypatch):
    from medloom.operators import vectors as V
    from medloom.plans import vector_queries as Q

    want = sorted(map(tuple, Q.two_stage_search(spark, SF).collect()))
    copies, dealt = [], V._dealt

    def counted(df, key, own, other, parts, others):
        if "cluster" in df.columns:
            copies.append(others)
        return dealt(df, key, own, other, parts, others)

    monkeypatch.setattr(V, "_dealt", counted)
    monkeypatch.setattr(V, "PAIRS", 1)
    monkeypatch.setattr(V, "_STEP", 7, raising=False)
    monkeypatch.setattr(V, "SHARD", 40)
    assert sorted(map(tuple, Q.two_stage_search(spark, SF).collect())) == want
    assert copies == [1, 1]
    monkeypatch.setattr(V, "WIDE", 1)
    assert sorted(map(tuple, Q.two_stage_search(spark, SF).collect())) == want


def test_report_has_no_more_blocks_than_cores(spark, monkeypatch):
    from medloom.operators import vectors as V
    from medloom.plans import vector_queries as Q

    want = [tuple(r) for r in Q.match_report(spark, SF).collect()]
    monkeypatch.setattr(V, "RANKED", 1)
    monkeypatch.setattr(V, "_COPIES", 0.25, raising=False)
    df = Q.match_report(spark, SF)
    assert df.rdd.getNumPartitions() == 1
    assert [tuple(r) for r in df.collect()] == want
