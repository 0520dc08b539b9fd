import json

import pytest

from medloom.operators import triples as T
from medloom.sources import rdf

E = "http://e/"


def _lists(spark, rows):
    t = spark.createDataFrame([(r["s"], r["p"], r["o"], r["lit"] and r["lit"]["value"]) for r in rows], "s string, p string, o string, lit string")
    out = {}
    for head, position, member in T.collections(t).collect():
        out.setdefault(head, {})[position] = member
    return {h: [m[k] for k in range(len(m))] for h, m in out.items()}


def test_turtle_collections_nest_and_may_be_subjects(spark):
    rows = rdf.parse_turtle('@prefix e: <http://e/> . e:a e:b ( e:c "x"@en ( 1 2.5 ) [ e:k -3e2 ] () true ) , (e:z) . ( e:p e:q ) e:r e:s .')
    lists = _lists(spark, rows)
    heads = [r["o"] for r in rows if r["p"] == E + "b"]
    outer = lists[heads[0]]
    assert outer[:2] == [E + "c", "x"] and outer[4] == rdf.NIL and outer[5] == "true" and lists[outer[2]] == ["1", "2.5"]
    assert lists[heads[1]] == [E + "z"]
    subject = next(r["s"] for r in rows if r["p"] == E + "r")
    assert lists[subject] == [E + "p", E + "q"]
    kinds = {r["lit"]["value"]: r["lit"]["datatype"] for r in rows if r["lit"]}
    assert kinds == {"x": None, "1": rdf.XSD + "integer", "2.5": rdf.XSD + "decimal", "-3e2": rdf.XSD + "double", "true": rdf.XSD + "boolean"}


@pytest.mark.parametrize("bad", ["<e:a> <e:b> ( <e:c> .", "<e:a> <e:b> <e:c> ) .", "<e:a> <e:b> ( <e:c>", "<e:a> <e:b>"])
def test_broken_turtle_is_an_error(bad):
    with pytest.raises((ValueError, IndexError)):
        rdf.parse_turtle(bad)


def test_jsonld_lists_sets_and_reverse(spark):
    doc = {
        "@context": {"e": E, "l": {"@id": "e:l", "@container": "@list"}, "child": {"@reverse": "e:parent"}},
        "@id": "e:a", "l": ["x", {"@id": "e:y"}, 3], "e:m": {"@list": []}, "e:n": {"@set": ["p", None, "q"]}, "e:o": ["s", ["t", "u"]],
        "child": [{"@id": "e:c", "e:k": 1}, "e:d"], "@reverse": {"e:knows": {"@id": "e:f"}},
    }
    rows = rdf.parse_jsonld(json.dumps(doc))
    lists = _lists(spark, rows)
    of = lambda verb: [(r["s"], r["o"], r["lit"] and r["lit"]["value"]) for r in rows if r["p"] == E + verb]
    assert lists[of("l")[0][1]] == ["x", E + "y", "3"]
    assert of("m") == [(E + "a", rdf.NIL, None)]
    assert of("n") == [(E + "a", None, "p"), (E + "a", None, "q")]
    assert of("o")[0] == (E + "a", None, "s") and lists[of("o")[1][1]] == ["t", "u"]
    assert of("parent") == [(E + "c", E + "a", None), (E + "d", E + "a", None)] and of("knows") == [(E + "f", E + "a", None)] and of("k") == [(E + "c", None, "1")]


def test_long_lists_shared_tails_and_circles(spark):
    cell = lambda s, first, rest: [(s, rdf.FIRST, None, first), (s, rdf.REST, rest, None)]
    rows = [x for k in range(100) for x in cell(f"c{k:03}", f"m{k}", f"c{k + 1:03}" if k < 99 else rdf.NIL)]
    rows += cell("h1", "a", "tail") + cell("h2", "b", "tail") + cell("tail", "c", rdf.NIL)
    rows += cell("r1", "x", "r2") + cell("r2", "y", "r1") + [(None, rdf.FIRST, None, "lost")]
    t = spark.createDataFrame(rows, "s string, p string, o string, lit string")
    got = sorted(map(tuple, T.collections(t).collect()))
    assert got == sorted([("c000", k, f"m{k}") for k in range(100)] + [("h1", 0, "a"), ("h2", 0, "b"), ("h1", 1, "c"), ("r1", 0, "x"), ("r1", 1, "y")])


def test_blank_nodes_of_several_files_are_told_apart(spark, tmp_path):
    for k in range(2):
        (tmp_path / f"{k}.ttl").write_text(f"<e:s{k}> <e:p> ( {k} ) .")
    path = f"file://{tmp_path}"
    assert {r["s"] for r in rdf.turtle(spark, path).where("s like '\\_:%'").collect()} == {"_:anon1"}
    assert len({r["s"] for r in rdf.turtle(spark, path, apart=True).where("s like '\\_:%'").collect()}) == 2
