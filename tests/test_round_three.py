"""What the findings of round 3 named."""

import numpy as np
import pyarrow as pa
import pytest

from medloom.llm import line_dedup, line_keys, meeting
from medloom.plans import registry_queries


@pytest.fixture
def tables(spark, tmp_path):
    def write(**frames):
        for name, df in frames.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def test_arms_of_a_study_without_children(spark, tables):
    customer = spark.createDataFrame([(1, "a", 0, 0.0, "x"), (2, "b", 0, 0.0, "x")], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    orders = spark.createDataFrame([(1, 1, "F", 2.0, "LOW"), (2, 1, "O", 1.0, "HIGH")], "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string")
    got = registry_queries.study_arms(spark, tables(customer=customer, orders=orders)).collect()
    assert sorted(map(tuple, got)) == [(1, "F", "LOW F"), (2, None, "")]


def test_records_go_in_folders_and_once(spark):
    packer = meeting.Packer()
    for _ in range(2):
        packer.add(*meeting.records(np.arange(1000, dtype=np.uint64) << np.uint64(29), np.arange(1000), 0, 16))
    part, packed = packer.take()
    assert sum(map(len, packed.to_pylist())) == 1000 * meeting.RECORD.itemsize
    assert meeting.dealt(pa.array([0, 3, 5], pa.int32())).to_pylist() == [1, 4, 2]
    docs = spark.createDataFrame([(k, k, f"a line of several words that is number {chr(97 + k % 20) * 5}") for k in range(60)], "key bigint, id bigint, text string")
    tables = line_dedup.lines_of(docs, 16)[1]
    found = [{r["part"] for r in t.collect()} for t in tables]
    assert len(tables) == meeting.ROUNDS and all(found) and sum(map(len, found)) == len(set().union(*found))


def test_texts_of_lines_that_met_by_chance_stay(spark):
    def sketch(lanes, length):
        return bytearray(np.array(lanes, np.uint16).tobytes() + np.uint32(length).tobytes())

    # in bucket 0 (kind 0, band 0): two near lines of two groups, and one with three lanes in common
    near = [*range(100, 130)]
    triple = set(line_keys._TRIPLES[0].tolist())
    far = [x if k in triple else 7 for k, x in enumerate(near)]
    rows = [(0, 1, sketch(near, 50), 1, 3), (0, 2, sketch(near, 50), 2, 3), (0, 3, sketch(far, 50), 3, 3)]
    members = spark.createDataFrame(rows, "bucket bigint, code bigint, sketch binary, root bigint, n bigint")
    got = meeting.close_members(members, line_keys.likeness, line_keys.first_band).collect()
    assert sorted(map(tuple, got)) == [(0, 1, 1, 2), (0, 2, 2, 2)]


@pytest.mark.parametrize("name", ["zero_vector_topk", "empty_prints"])
def test_all_rows_are_queries(spark, name):
    from medloom.plans import catalogue

    asked = {r["query_id"] for r in catalogue.QUERIES[name](spark, "/root/testdata/sf0.001").collect()}
    assert any(i % 100 and i % 50 != 1 for i in asked) and not any(i % 3 == 0 for i in asked)


def test_best_of_shards_and_blocks(spark, monkeypatch):
    from medloom.operators import vectors

    rng = np.random.default_rng(5)
    v = [[float(x) for x in rng.integers(-3, 4, 6)] for _ in range(80)]
    v[10:30] = [v[9]] * 20  # equal vectors: ties go to the smaller ids
    v[40], v[41] = [0.0] * 6, None
    monkeypatch.setattr(vectors, "SHARD", 11)
    monkeypatch.setattr(vectors, "FEW", 17)
    df = spark.createDataFrame(list(enumerate(v)), "id bigint, v array<double>")
    got = vectors.cosine_topk(df.select(df.id.alias("query_id"), df.v.alias("q")), df, 4).collect()
    long = [x is not None and np.sqrt(np.dot(x, x)) for x in v]
    want = {(a, b, r) for a in range(80) if long[a] for r, (_, b) in enumerate(sorted((-round(np.dot(v[a], v[b]) / long[a] / long[b], 6), b) for b in range(80) if long[b])[:4], 1)}
    assert {(r["query_id"], r["id"], r["rank"]) for r in got} == want
    long_form = vectors.to_sparse(df.where("v is not null"), 0.5)
    got = vectors.sparse_dot_topk(long_form.withColumnRenamed("id", "query_id"), long_form, 4).collect()
    part = lambda x: [y if y > 0.5 else 0.0 for y in x or ()]
    scores = {a: sorted((-s, b) for b in range(80) if (s := sum(x * y for x, y in zip(part(v[a]), part(v[b]), strict=False))) > 0)[:4] for a in range(80)}
    assert {(r["query_id"], r["id"], r["rank"], r["score"]) for r in got} == {(a, b, k, -s) for a, x in scores.items() for k, (s, b) in enumerate(x, 1)}


def test_overlap_and_two_stage_are_not_joins_of_pairs(spark):
    from medloom.plans import vector_queries

    plan = vector_queries.two_stage_search(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "sum(" not in plan.split("FlatMapCoGroupsInArrow")[0]


def test_nothing_that_grows_is_broadcast(spark, monkeypatch):
    from medloom.llm import components, shared, simhash

    plans = []

    def seen(df, what):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return shared.store(df, what)

    monkeypatch.setattr(components, "store", seen)
    monkeypatch.setattr(simhash, "store", seen)
    words = [f"w{k}" for k in range(120)]
    docs = spark.createDataFrame([(k, " ".join(words if k % 3 else words[k:])) for k in range(30)], "doc_id bigint, text string")
    out = simhash.simhash_groups(docs)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert out.count() == 30 and len(plans) > 5 and not any("Broadcast" in p for p in plans)
