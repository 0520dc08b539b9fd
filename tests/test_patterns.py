import random

import pytest
from pyspark.sql import functions as F

from medloom.operators import triples as T
from medloom.operators.patterns import Clause, solve

SCHEMA = "uri string, s string, p string, o string, lit string"


@pytest.fixture(scope="module")
def facts():
    r = random.Random(5)
    return sorted({(f"n{r.randrange(12)}", r.choice("abc"), f"n{r.randrange(12)}") for _ in range(60)})


@pytest.fixture(scope="module")
def table(spark, facts):
    rows = [(None, *f, None) for f in facts] + [("u", *facts[0], None), (None, None, "a", "n1", None), (None, "n1", "a", None, None), (None, "n3", "label", None, "three")]
    return spark.createDataFrame(rows, SCHEMA)


def _plain(facts, clauses, out, values=None):
    """Every assignment of nodes and verbs, tried."""
    facts = {*facts, ("n3", "label", "three")}
    nodes = sorted({x for s, _, o in facts for x in (s, o)})
    follow = {}
    for p in {p for _, p, _ in facts}:
        paths = [{(n, n) for n in nodes if any(n in (s, o) and q == p for s, q, o in facts)}]
        for _ in range(len(nodes)):
            paths.append({(a, o) for a, b in paths[-1] for s, q, o in facts if q == p and s == b})
        follow[p] = paths
    found = set()

    def go(left, got):
        if not left:
            found.add(tuple(got[v] for v in out))
            return
        c = left[0]
        if c.hops == (1, 1):
            options = facts
        else:
            low, high = c.hops
            options = {(a, c.p, b) for pairs in follow[c.p][low : (high + 1 if high is not None else None)] for a, b in pairs}
        for fact in options:
            new = dict(got)
            if all(term is None or (new.setdefault(term, x) == x if term.startswith("?") else term == x) for term, x in zip(c[:3], fact, strict=True)) and all(new[v] in w for v, w in (values or {}).items() if v in new):
                go(left[1:], new)

    go(list(clauses), {})
    return found


CASES = [
    ([Clause("?x", "a", "?y"), Clause("?y", "b", "?z")], None),
    ([Clause("?x", "a", "?y"), Clause("?z", "b", "?y"), Clause("?z", "c", "?x")], None),
    ([Clause("?x", "?v", "?x")], None),
    ([Clause("?x", None, "?y"), Clause("?y", "?v", "n3")], {"?x": ["n1", "n2", "n4"]}),
    ([Clause("?x", "label", "three"), Clause("?x", "a", "?y", (1, 3))], None),
    ([Clause("?y", "b", "?x", (0, 2)), Clause("?x", "c", "?z")], None),
    ([Clause("?y", "b", "?x", (1, None))], {"?x": ["n3", "n5"]}),
    ([Clause("?x", "a", "?y", (2, 2))], None),
    ([Clause("?x", "c", "?y"), Clause("?x", "a", "?y", (0, None))], None),
    ([Clause("?x", "a", "?y"), Clause("n3", "label", "three")], None),
    ([Clause("?x", "a", "?y"), Clause("n3", "label", "four")], None),
    ([Clause("?x", "none", "?y"), Clause("?y", "a", "?z")], None),
]


@pytest.mark.parametrize(("clauses", "values"), CASES)
@pytest.mark.parametrize("ordered", [False, True])
def test_patterns_agree_with_trying_everything(table, facts, clauses, values, ordered):
    out = sorted({v for c in clauses for v in c.variables()})
    got = [tuple(r) for r in solve(table, clauses, out, values, T.verb_statistics(table) if ordered else None).collect()]
    assert len(got) == len(set(got))
    assert set(got) == _plain(facts, clauses, out, values)


def test_clauses_that_share_nothing_wait_or_are_refused(table):
    with pytest.raises(ValueError, match="falls apart"):
        solve(table, [Clause("?x", "a", "?y"), Clause("?z", "b", "?w")])
    with pytest.raises(ValueError, match="verb"):
        solve(table, [Clause("?x", None, "?y", (1, 2))])
    got = solve(table, [Clause("?x", "a", "?y"), Clause("?z", "b", "?w"), Clause("?y", "c", "?z")])
    assert "Cartesian" not in got._jdf.queryExecution().toString()


def test_no_triples(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert solve(empty, [Clause("?x", "a", "?y"), Clause("?y", "b", "?z", (1, None))], stats=T.verb_statistics(empty)).count() == 0


def test_edges_as_triples_keep_other_columns_out(table):
    wide = table.withColumn("x", F.lit("clash")).withColumn("start", F.lit(1)).withColumn("node", F.lit(2))
    clauses = [Clause("?start", "a", "?node"), Clause("?node", "b", "?s", (1, 2))]
    assert set(map(tuple, solve(wide, clauses).collect())) == set(map(tuple, solve(table, clauses).collect()))
    assert solve(wide, clauses).columns == ["node", "s", "start"]


def test_ways_through_a_variable_that_nobody_asks_for_are_not_multiplied(spark):
    # x to many m's to one t, and t's many n's to few y's: every row of the last join is a result
    rows = [("x", "p", f"m{i}") for i in range(20)] + [("t", "q", f"m{i}") for i in range(20)] + [("t", "q", f"n{i}") for i in range(30)] + [(f"y{i % 3}", "p", f"n{i}") for i in range(30)] + [("far", "q", "n_far"), ("y9", "p", "n_far")]
    df = spark.createDataFrame(rows, "s string, p string, o string")
    clauses = [Clause("x", "p", "?one"), Clause("?t", "q", "?one"), Clause("?t", "q", "?two"), Clause("?y", "p", "?two")]
    got = solve(df, clauses, ["?t", "?y"])
    assert sorted(map(tuple, got.collect())) == [("t", "x"), *[("t", f"y{i}") for i in range(3)]]
    plan = got._jdf.queryExecution().optimizedPlan().toString().splitlines()
    top = next(i for i, line in enumerate(plan) if "Join" in line)
    assert not any("Aggregate" in line for line in plan[:top])  # none behind the last join


def test_hidden_variables_give_what_is_tried_by_hand(facts, table):
    for clauses, out in (
        ([("?a", "a", "?x"), ("?y", "b", "?x"), ("?y", "b", "?z"), ("?w", "a", "?z")], ["?a", "?y", "?w"]),
        ([("?a", "a", "?b"), ("?b", "b", "?c"), ("?c", "c", "?d"), ("?d", "a", "?e")], ["?a", "?e"]),
        ([("?a", "a", "?b"), ("?b", "b", "?c"), ("?c", "c", "?a")], ["?b"]),
        ([("n1", "a", "?b"), ("?b", "b", "?c"), ("?c", "?v", "?d"), ("?d", "a", "?b")], ["?b", "?v"]),
    ):
        clauses = [Clause(*c) for c in clauses]
        got = solve(table, clauses, out).collect()
        assert len(got) == len(set(got)) and {tuple(r) for r in got} == _plain(facts, clauses, out)
