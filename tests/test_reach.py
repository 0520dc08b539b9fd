import random

import pytest

from medloom.operators import reach


def _triples(spark, edges, verb="up"):
    return spark.createDataFrame([(None, s, verb, o, None) for s, o in edges], "uri string, s string, p string, o string, lit string")


def _all(edges, start):
    seen, todo = {start}, [start]
    while todo:
        at = todo.pop()
        new = {o for s, o in edges if s == at and o} - seen
        seen |= new
        todo += new
    return seen


def _random(nodes, extra, seed):
    """A forest, and some edges beside it in any direction."""
    r = random.Random(seed)
    forest = [(f"n{i}", f"n{r.randrange(i)}") for i in range(1, nodes) if r.random() < 0.95]
    return forest + [(f"n{r.randrange(nodes)}", f"n{r.randrange(nodes)}") for _ in range(extra)]


@pytest.mark.parametrize("edges", [_random(60, 0, 1), _random(60, 12, 2), [(f"n{i}", f"n{(i + 1) % 13}") for i in range(13)] + [("n20", "n21"), ("n21", "n20"), ("n5", "n20"), ("n30", "n3")], _random(20, 60, 3)], ids=["forest", "links", "circles", "dense"])
def test_closure_and_pairs_agree_with_a_walk(spark, edges):
    nodes = sorted({x for e in edges for x in e})
    t = _triples(spark, edges).unionByName(_triples(spark, [("n1", "n9"), ("n2", "n8")], "other"))
    starts = spark.createDataFrame([(x,) for x in [*nodes, nodes[0], None, "lone"]], "start string")
    got = [tuple(r) for r in reach.closure(t, ["up"], starts).collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(a, b) for a in [*nodes, "lone"] for b in _all(edges, a)}
    r = random.Random(4)
    pairs = [(r.choice(nodes), r.choice(nodes)) for _ in range(80)] + [("lone", "lone"), ("lone", nodes[0]), (None, nodes[0]), (nodes[0], None)]
    pairs.append(pairs[0])
    got = sorted(map(tuple, reach.is_related(t, ["up"], spark.createDataFrame(pairs, "source string, target string")).collect()), key=str)
    assert got == sorted(((a, b, None if a is None or b is None else b in _all(edges, a)) for a, b in pairs), key=str)


def test_rounds_grow_with_the_logarithm_of_the_depth(spark):
    chain = [(f"n{i:04}", f"n{i + 1:04}") for i in range(300)]
    graph = reach.forest(reach.edges_of(_triples(spark, chain), ["up"]))
    assert len(graph.jumps) == 9 and graph.links.isEmpty()
    deepest = reach.labels(graph, spark.createDataFrame([("n0000",), ("n0299",), ("x",)], "node string"))
    assert sorted(map(tuple, deepest.collect())) == [("n0000", "n0300", 300), ("n0299", "n0300", 1), ("x", "x", 0)]


def test_a_circle_gives_one_edge_up(spark):
    circle = [(f"n{i}", f"n{(i + 1) % 5}") for i in range(5)]
    graph = reach.forest(reach.edges_of(_triples(spark, [*circle, ("n7", "n7")]), ["up"]))
    assert [tuple(r) for r in graph.links.collect()] == [("n0", "n1")]


def test_no_edges(spark):
    t = _triples(spark, [("a", None)])
    assert [tuple(r) for r in reach.closure(t, ["up"], spark.createDataFrame([("a",)], "start string")).collect()] == [("a", "a")]
    assert reach.is_related(t, ["up"], spark.createDataFrame([], "source string, target string")).count() == 0
