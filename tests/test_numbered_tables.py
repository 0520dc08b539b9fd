from xml.etree import ElementTree as ET

import pytest
from pyspark.sql import functions as F

from medloom import schema
from medloom.sinks import tables
from medloom.sinks.keyed import KeyedTable

DDL = "k int, a string, v string"


def _numbers(t):
    return {(r["k"], r["a"]): r["number"] for r in t.read().collect()}


def test_numbers_are_unique_and_stay(spark, tmp_path):
    t = KeyedTable(spark, f"file://{tmp_path}/t", ["k", "a"], buckets=4)
    rows = [(k, x, "one") for k in range(150) for x in ("x", None)] + [(None, None, "none"), (7, "x", "two"), (7, "x", "two")]
    t.upsert_numbered(spark.createDataFrame(rows, DDL), "number")
    first = _numbers(t)
    assert len(first) == 301 == len(set(first.values())) and t.lookup(k=7, a="x").first()["v"] == "two"
    t.upsert_numbered(spark.createDataFrame([(k, "x", "new") for k in range(100, 400)], DDL), "number")
    second = _numbers(t)
    assert len(second) == 551 == len(set(second.values())) and all(second[k] == n for k, n in first.items())
    # dense in each bucket
    assert all(sorted(n // 4 for n in second.values() if n % 4 == b) == list(range(sum(n % 4 == b for n in second.values()))) for b in range(4))
    t.upsert_numbered(spark.createDataFrame([], DDL), "number")
    assert _numbers(t) == second


def test_two_writers_give_no_number_twice(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/t"
    KeyedTable(spark, path, ["k"], buckets=4).upsert_numbered(spark.createDataFrame([(0, "a")], "k int, v string"), "number")
    one, other = KeyedTable(spark, path, ["k"]), KeyedTable(spark, path, ["k"])
    publish, done = one._publish, []

    def late(v):
        if not done:
            done.append(1)
            other.upsert_numbered(spark.createDataFrame([(k, "other") for k in range(50, 100)], "k int, v string"), "number")
        return publish(v)

    monkeypatch.setattr(one, "_publish", late)
    one.upsert_numbered(spark.createDataFrame([(k, "one") for k in range(1, 75)], "k int, v string"), "number")
    got = {r["k"]: (r["v"], r["number"]) for r in one.read().collect()}
    assert len(got) == 100 == len({n for _, n in got.values()}) and got[60][0] == "one" and got[80][0] == "other"


def test_a_table_of_keys_only(spark, tmp_path):
    t = KeyedTable(spark, f"file://{tmp_path}/t", ["k"])
    t.upsert_numbered(spark.createDataFrame([(1,), (1,), (2,)], "k int"), "number")
    assert t.read().count() == 2


def test_declared_tables_with_number_and_stamp(spark, tmp_path):
    rows = spark.createDataFrame([(1, "t" * 150, "x"), (None, "u", "y")], "source bigint, target string, other string")
    stamp = F.lit("2024-01-02 03:04:05").cast("timestamp_ntz")
    tables.declared(schema.LINKS, f"file://{tmp_path}/links", "id", stamp)(rows)
    (got,) = KeyedTable(spark, f"file://{tmp_path}/links").read().collect()
    assert (got["source"], len(got["target"]), str(got["timestamp"])) == (1, 100, "2024-01-02 03:04:05") and got["id"] >= 0
    with pytest.raises(ValueError, match="keys"):
        tables.declared(schema.LOCATIONS, f"file://{tmp_path}/x", "id")


def test_every_file_is_a_document_with_its_comments(spark, tmp_path):
    t = spark.createDataFrame([(f"s{k}", "p", None, f"a & <b> {k}") for k in range(9)] + [("s1", "q", "http://e/o?a&b", None)], "s string, p string, o string, lit string").repartition(3)
    tables.rdf_xml(f"{tmp_path}/x", comments=["made -- here --- and <there> -", "two"])(t)
    found = {}
    for file in (tmp_path / "x").glob("part-*"):
        text = file.read_text()
        if not text:
            continue
        assert text.count("<!--") == 2 and "made - - here - - - and <there> -" in text
        for e in ET.fromstring(text):
            about = e.get("{http://www.w3.org/1999/02/22-rdf-syntax-ns#}about")
            found.setdefault(about, []).extend((c.tag, c.text or c.get("{http://www.w3.org/1999/02/22-rdf-syntax-ns#}resource")) for c in e)
    assert len(found) == 9 and sorted(found["s1"]) == [("{http://example.org/}p", "a & <b> 1"), ("{http://example.org/}q", "http://e/o?a&b")]
    empty = tables.rdf_document(tables.as_xml()(t.limit(0)), {"ex": "http://example.org/"})
    assert empty.count() == 0
