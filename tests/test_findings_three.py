"""Findings of round 3 about growth: what a plan shuffles, what a worker holds, how work is dealt."""

import numpy as np
import pytest

from medloom.operators import vectors as V

SF = "/root/testdata/sf0.001"


def test_report_shuffles_no_hits(spark, monkeypatch):
    from pyspark.sql import functions as F

    from medloom.plans import vector_queries

    monkeypatch.setattr(V, "RANKED", 2)
    monkeypatch.setattr(V, "_HANDED", 7)
    df = vector_queries.match_report(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # nothing but a map behind the last shuffle, so hits are not joined or sorted across tasks
    assert "Exchange" not in plan[: plan.index("MapInArrow")]
    got = df.collect()
    assert [(r["query_id"], -r["total"], r["id"]) for r in got] == sorted((r["query_id"], -r["total"], r["id"]) for r in got)
    d = spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id").alias("id"), F.md5("text").alias("text"))
    texts = {r["id"]: r["text"] for r in d.collect()}
    scores = {(r["query_id"], r["id"]): (r["dense"], r["sparse"], r["in_dense"], r["in_sparse"]) for r in vector_queries.two_stage_search(spark, SF).collect()}
    assert {(r["query_id"], r["id"]): (r["dense"], r["sparse"], r["in_dense"], r["in_sparse"]) for r in got} == {k: s for k, s in scores.items() if set(k) <= texts.keys()}
    assert all((r["query_text"], r["hit_text"]) == (texts[r["query_id"]], texts[r["id"]]) for r in got)


def test_rounding_of_large_numbers():
    x = np.array([0.1234565, -2.5e-7, 123456789.1234565, 9007199254.7409915, 1e18])
    from decimal import ROUND_HALF_UP, Decimal

    assert V._rounded(x).tolist() == [float(Decimal(repr(float(v))).quantize(Decimal("0.000001"), ROUND_HALF_UP)) + 0.0 for v in x]


def test_few_texts_are_embedded_at_a_time(spark):
    import pyarrow as pa

    from medloom.operators import nodes

    class Rows:
        schema = spark.createDataFrame([], "text string").schema

        def mapInArrow(self, run, schema):
            return run

    run = nodes.embed(Rows())
    out = list(run(iter([pa.record_batch({"text": [f"a b a {k}" for k in range(300)]})])))
    assert max(map(len, out)) <= 64 and sum(map(len, out)) == 300
    assert all(sum(x["value"] for x in s) == 4.0 for b in out for s in b.column("sparse").to_pylist())


def test_children_are_embedded_once(spark, tmp_path):
    from medloom.operators import nodes

    calls = spark.sparkContext.accumulator(0)

    def dense(text):
        calls.add(1)
        return nodes.hashed_vector(text)

    records = spark.createDataFrame([(k, True) for k in range(20)], "record_id bigint, abstract_ok boolean")
    locations = records.selectExpr("record_id", "'x' as location")
    sections = records.selectExpr("record_id", "'1' as head", "'One sentence.' as section_text")
    nodes.ingest_children(records, locations, sections, f"file://{tmp_path}/index", f"file://{tmp_path}/results", dense=dense)
    assert calls.value == 20


@pytest.mark.parametrize("name", ["jats_dates", "jats_nested"])
def test_small_files_are_parsed_by_many_tasks(spark, name):
    from medloom.plans import catalogue

    assert catalogue.QUERIES[name](spark, SF).rdd.getNumPartitions() >= 2 * spark.sparkContext.defaultParallelism


def test_numbers_of_parts_that_cannot_be_best_are_not_fitted(monkeypatch):
    from medloom.operators import clusters

    x = clusters.reduce(np.random.default_rng(4).normal(size=(60, 12)), 10)
    every = [clusters.mixture(x, k) for k in range(1, 50)]
    fitted, plain = [], clusters.mixture
    monkeypatch.setattr(clusters, "mixture", lambda x, k: (fitted.append(k), plain(x, k))[1])
    got = clusters.best_mixture(x)
    assert (got == every[int(np.argmin([bic for _, bic in every]))][0]).all() and len(fitted) < 40


def test_groups_of_bits_halve_the_parts(spark):
    from pyspark.sql import functions as F

    from medloom.operators import fingerprints as P

    rng = np.random.default_rng(6)
    levels = rng.integers(0, 16, (40, 64))
    rows = [x for base in levels for x in (base, np.where(np.arange(64) % 16 == 3, (base + 1) % 16, base), np.where(np.arange(64) < 6, (base + 1) % 16, base))]

    def frame(rows):
        return spark.createDataFrame([(i, [16 * k + int(v) for k, v in enumerate(x)]) for i, x in enumerate(rows)], "id bigint, bits array<int>")

    def near(rows):
        sets = [{16 * k + int(v) for k, v in enumerate(x)} for x in rows]
        return {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if len(a & b) / len(a | b) >= 0.85}

    for some in (rows, [*rows, rows[0][:60]]):
        prints = frame(some).select("id", P.words_of(F.col("bits"), 1024).alias("fp"))
        assert P.alike(prints, 16) == (some is rows)
        assert {(r["query_id"], r["id"]) for r in P.links(prints, 0.85, 16).collect()} == near(some)
    prints = frame(rows).select("id", P.words_of(F.col("bits"), 1024).alias("fp"))
    # all have 64 bits: six keys each in halves, eleven in bits, no key for sizes that there are not
    assert P.signatures(prints, 0.85, 16, True).count() == 6 * len(rows) and P.signatures(prints, 0.85).count() == 11 * len(rows)
