"""Names by the longest namespace, against a plain search."""

import random

from medloom.operators import prefixes


def test_ten_thousand_namespaces(spark):
    rng = random.Random(4)
    known = {f"p{i}": "http://x.org/" + "/".join(str(rng.randrange(30)) for _ in range(rng.randrange(1, 5))) + rng.choice(["/", "#", ""]) for i in range(10_000)}
    uris = [rng.choice(list(known.values())) + rng.choice(["", "a", "é/b"]) for _ in range(300)] + ["urn:other", "", None, "http://x.org/", None]
    rows = spark.createDataFrame(list(enumerate(uris)), "k int, uri string")
    table = spark.createDataFrame([*known.items(), ("none", None), (None, "http://x.org/"), ("empty", "")], "prefix string, namespace string")
    by_head: dict = {}
    for p, n in known.items():
        by_head[n] = min(p, by_head.get(n, p))

    def plain(uri):
        if uri is None:
            return None
        head = max((uri[:n] for n in range(len(uri) + 1) if uri[:n] in by_head), key=len, default=None)
        return uri if head is None else f"{by_head[head]}:{uri[len(head) :]}"

    named = prefixes.encode(rows, "uri", table)
    assert {r["k"]: r["name"] for r in named.collect()} == {k: plain(u) for k, u in enumerate(uris)}
    # the plan does not grow with the namespaces
    few = prefixes.encode(rows, "uri", table.limit(5))
    size = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString().split("\n"))
    assert size(named) <= size(few) + 2


def test_no_namespaces(spark):
    rows = spark.createDataFrame([("a:b",), (None,)], "uri string")
    assert [r["name"] for r in prefixes.encode(rows, "uri", spark.createDataFrame([], "prefix string, namespace string")).collect()] == ["a:b", None]
