"""Pages and partitions by ranges of a key: all of them as by sort and offset."""

import random

import pytest
from pyspark.sql import functions as F

from medloom.operators import paging


def order(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("size", [1, 7, 100, 1000])
def test_every_page_is_as_by_offset(spark, tmp_path, size):
    rng = random.Random(size)
    n = 23 if size == 1 else 400
    data = list({(rng.choice([None, "a", "b", "ü", "zz"]), rng.choice([None, *range(200)])) for _ in range(n)})
    rows = spark.createDataFrame([(*d, i) for i, d in enumerate(data)], "a string, b int, v int").repartition(7)
    pages = paging.pages(rows, ["a", "b"], f"file://{tmp_path}/p", size)
    want = sorted([(*d, i) for i, d in enumerate(data)], key=lambda r: order(r[:2]))
    assert pages.number() == -(-len(want) // size)
    for k in range(0, pages.number(), 1 if size > 1 else 5):
        assert [tuple(r) for r in pages.page(k).collect()] == want[k * size : (k + 1) * size]
    assert pages.page(pages.number()).count() == 0
    assert sorted((r["page"], r["n"]) for r in pages.checked().collect()) == [(k, len(want[k * size : (k + 1) * size])) for k in range(pages.number())]


def test_a_page_reads_its_own_range(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    spark.range(0, 20_000).withColumn("v", F.md5(F.col("id").cast("string"))).repartitionByRange(20, "id").sortWithinPartitions("id").write.parquet(path)
    pages = paging.pages(spark.read.parquet(path), ["id"], f"file://{tmp_path}/p", 1000)
    page = pages.page(12)
    assert [r["id"] for r in page.select("id").collect()] == list(range(12_000, 13_000))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(id,12000)" in plan and "LessThan(id,13000)" in plan


def test_keys_that_repeat_are_told(spark, tmp_path):
    rows = spark.createDataFrame([(i // 3,) for i in range(30)], "k int")
    with pytest.raises(Exception, match="not unique"):
        paging.pages(rows, ["k"], f"file://{tmp_path}/p", 10).checked().collect()


def test_partitions_are_bounded(spark, tmp_path):
    rows = spark.createDataFrame([(i % 50, i) for i in range(1234)], "k int, v int")
    got = paging.partitions(rows, ["k"], f"file://{tmp_path}/p", 100)
    assert got.columns == ["k", "v", "partition"]
    sizes = {r["partition"]: (r["n"], r["a"], r["b"]) for r in got.groupBy("partition").agg(F.count("*").alias("n"), F.min("k").alias("a"), F.max("k").alias("b")).collect()}
    assert [sizes[k][0] for k in range(13)] == [100] * 12 + [34]
    assert all(sizes[k][2] <= sizes[k + 1][1] for k in range(12))
    ranks = paging.numbered(rows, ["k", "v"], f"file://{tmp_path}/r").orderBy("k", "v").collect()
    assert [r["rank"] for r in ranks] == list(range(1234))
    none = spark.createDataFrame([], "k int")
    assert paging.numbered(none, ["k"], f"file://{tmp_path}/n").count() == 0 and paging.pages(none, ["k"], f"file://{tmp_path}/e").page(0).count() == 0
