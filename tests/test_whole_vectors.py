"""Similarity joins over all rows of a table, against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from medloom.operators import fingerprints as P
from medloom.plans import catalogue

SF = "/root/testdata/sf0.001"


def signed(words):
    return [w - (1 << 64) if w >> 63 else w for w in words]


def as_words(bits, width):
    return signed([sum(1 << (b % 64) for b in bits if b // 64 == w) for w in range(-(-width // 64))])


def families(width, sizes, seed):
    """Sets of bits in families: a few bits of a member differ from the first one's."""
    rng = random.Random(seed)
    out = []
    for size in sizes:
        base = set(rng.sample(range(width), min(size, width)))
        out.append(base)
        for _ in range(5):
            other = set(base)
            for _ in range(rng.randrange(0, 1 + size // 5)):
                other ^= {rng.randrange(width)}
            out.append(other)
    return out


@pytest.mark.parametrize(("width", "least"), [(64, 0.85), (256, 0.85), (1024, 0.7), (2048, 0.85), (130, 0.5), (2048, 1.0)])
def test_links_of_all_fingerprints(spark, width, least):
    sets = families(width, [1, 2, 3, 4, 5, 8, 13, 20, 30, 50, 60, 90, 110, 200, 0, 7, 7], seed=width)
    sets = [*sets, sets[0], sets[40], set()]
    prints = spark.createDataFrame([(i, as_words(s, width)) for i, s in enumerate(sets)], "id bigint, fp array<bigint>")
    of = {r["id"]: r["least"] for r in P.members(prints).collect()}
    got = [(r["query_id"], r["id"], r["similarity"]) for r in P.links(prints, least).collect()]
    assert len(got) == len({g[:2] for g in got})
    want = {(a, b, round(len(x & y) / len(x | y) + 1e-10, 6)) for a, x in enumerate(sets) for b, y in enumerate(sets) if of[a] == a and of[b] == b and x | y and len(x & y) / len(x | y) >= least}
    assert set(got) == want
    found = P.search(prints.select(F.col("id").alias("query_id"), F.col("fp").alias("q")).where("query_id % 3 = 0"), prints, least)
    assert {tuple(r) for r in found.collect()} == {(a, b, round(len(x & y) / len(x | y) + 1e-10, 6)) for a, x in enumerate(sets) for b, y in enumerate(sets) if a % 3 == 0 and x | y and len(x & y) / len(x | y) >= least}


def test_many_queries_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(P, "FEW", 10)
    prints = spark.createDataFrame([(i, as_words({i % 7, i % 11, 70}, 128)) for i in range(60)], "id bigint, fp array<bigint>")
    queries = prints.select(F.col("id").alias("query_id"), F.col("fp").alias("q"))
    got = {tuple(r) for r in P.search(queries, prints, 0.4).collect()}
    monkeypatch.undo()
    assert got == {tuple(r) for r in P.search(queries, prints, 0.4).collect()} and len(got) > 60


def test_prints_of_vectors(spark):
    v = [1.0 if i in (0, 63, 64, 69) else -1.0 for i in range(70)]
    df = spark.createDataFrame([(1, v), (2, [0.0, 2.0]), (3, [])], "id int, v array<double>")
    got = {r["id"]: (r["fp"], r["bits"], r["n"]) for r in df.select("id", P.sign_bits(F.col("v")).alias("fp")).withColumn("bits", P.bits_of(F.col("fp"))).withColumn("n", P.set_bits(F.col("fp"))).collect()}
    assert got == {1: (as_words({0, 63, 64, 69}, 70), [0, 63, 64, 69], 4), 2: ([2], [1], 1), 3: ([0], [], 0)}
    far = spark.createDataFrame([([0] * 64 + [1] * 6, [1] * 6 + [0] * 64)], "a array<int>, b array<int>")
    assert far.select(P.tanimoto(P.sign_bits(F.col("a")), P.sign_bits(F.col("b"))).alias("t")).first()["t"] == 0
    listed = spark.createDataFrame([([3, 64, 127],)], "b array<int>").select(P.words_of(F.col("b"), 130).alias("w")).first()["w"]
    assert listed == as_words({3, 64, 127}, 130)


def test_links_query_is_of_all_compounds(spark):
    every = {r["query_id"] for r in catalogue.QUERIES["tanimoto_links"](spark, SF).collect()}
    assert any(i % 100 for i in every) and every == {r["least"] for r in catalogue.QUERIES["tanimoto_members"](spark, SF).collect()}


def test_many_vectors_are_sent_seldom_and_zero_ones_never(spark, monkeypatch):
    import numpy as np

    from medloom.operators import vectors

    seen = []
    real = vectors.met
    monkeypatch.setattr(vectors, "met", lambda q, v, block, nq, nv, *rest: seen.append((-(-nq // block), -(-nv // rest[2]), nq, nv)) or real(q, v, block, nq, nv, *rest))
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 6)).round(2)
    x[::3], x[400:600] = 0, x[400]  # a third is zero; many equal ones, whose ties go to the smaller ids
    x[700] = x[401] * (1 + 1e-9)
    df = spark.createDataFrame([(i, [float(y) for y in r]) for i, r in enumerate(x)], "id bigint, v array<double>")
    monkeypatch.setattr(vectors, "FEW", 10)
    monkeypatch.setattr(vectors, "SHARD", 10)
    got = vectors.cosine_topk(df.select(df.id.alias("query_id"), df.v.alias("q")), df, 5).collect()
    some = np.flatnonzero((x != 0).any(axis=1))
    unit = x[some] / np.sqrt((x[some] ** 2).sum(axis=1))[:, None]
    score = (unit @ unit.T).round(6)
    want = {(int(some[i]), int(some[j]), r) for i in range(len(some)) for r, j in enumerate(np.lexsort((some, -score[i]))[:5], 1)}
    assert {(r["query_id"], r["id"], r["rank"]) for r in got} == want
    blocks, shards, *n = seen[0]
    assert n == [len(some)] * 2 and blocks * shards <= 9 * spark.sparkContext.defaultParallelism
