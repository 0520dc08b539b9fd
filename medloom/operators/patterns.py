"""Patterns of triples, or of a property graph's edges, as equi-joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.operators import reach


class Clause(NamedTuple):
    """``s`` and ``o`` are variables (?name) or values, ``p`` a verb, a variable, or any verb if None.  ``hops`` is the
    smallest and largest number of edges, the largest None for any number; a path of several edges needs a verb."""

    s: str
    p: str | None
    o: str
    hops: tuple[int, int | None] = (1, 1)

    def variables(self) -> set[str]:
        return {x for x in (self.s, self.p, self.o) if _free(x)}


def _free(term: str | None) -> bool:
    return term is not None and term.startswith("?")


def of_edges(edges: DataFrame) -> DataFrame:
    """A property graph's edges (type, src, dst) as triples."""
    return edges.select(F.col("src").alias("s"), F.col("type").alias("p"), F.col("dst").alias("o"))


def _given(rows: DataFrame, terms: dict[str, str | None], values: dict[str, list]) -> DataFrame:
    """The rows that fit, with a column for each variable; a variable that stands twice has one value."""
    columns: dict[str, str] = {}
    for column, term in terms.items():
        if term is None:
            continue
        if not _free(term):
            rows = rows.where(F.col(column) == term)
        elif term in columns:
            rows = rows.where(F.col(column) == F.col(columns[term]))
        else:
            columns[term] = column
            if term in values:
                rows = rows.where(F.col(column).isin(values[term]))
    return rows.select(*[F.col(c).alias(term[1:]) for term, c in columns.items()])


def _paths(rows: DataFrame, clause: Clause, starts: DataFrame, back: bool) -> DataFrame:
    """(s, o) of the paths of a clause that begin at the starts, or end there if ``back``."""
    low, high = clause.hops
    steps = rows.where(F.col("p") == clause.p).select("s", "p", "o").distinct()
    if back:
        steps = steps.select(F.col("o").alias("s"), "p", F.col("s").alias("o"))
    at = starts.select(F.col("start"), F.col("start").alias("node")).where("start is not null").distinct()
    ends = []
    for k in range((low if high is None else high) + 1):
        if k:
            at = reach.settled(at.join(steps, F.col("node") == F.col("s")).select("start", F.col("o").alias("node")).distinct())
        if k >= low and high is not None:
            ends.append(at)
    if high is None:
        further = reach.closure(steps, [clause.p], at.select(F.col("node").alias("start"))).select(F.col("start").alias("node"), F.col("node").alias("end"))
        ends.append(at.join(further, "node").select("start", F.col("end").alias("node")))
    s, o = ("node", "start") if back else ("start", "node")
    return reduce(DataFrame.unionByName, ends).distinct().select(F.col(s).alias("s"), F.col(o).alias("o"))


def _in_order(clauses: Sequence[Clause], stats: dict[str, tuple[int, int, int]], values: dict[str, list]) -> list[Clause]:
    """The rarest clause first, then always one that shares a variable and adds the fewest rows for each found so far."""
    everything = max((n for n, _, _ in stats.values()), default=1)

    def cost(c: Clause, known: set[str]) -> float:
        n, subjects, objects = stats.get(c.p, (everything, 1, 1)) if not c.p or _free(c.p) or c.p in stats else (0, 1, 1)
        rows = float(n)
        for term, distinct in ((c.s, subjects), (c.o, objects)):
            if not _free(term) or term in known:
                rows /= max(distinct, 1)
            elif term in values:
                rows *= min(1.0, len(values[term]) / max(distinct, 1))
        return rows * (c.hops[1] or 8)

    left, known, out = list(clauses), set(), []
    while left:
        near = [c for c in left if not out or c.variables() & known]
        if not near:
            raise ValueError("the pattern falls apart: no variable is shared")
        # a path is walked from an end that is known
        ready = [c for c in near if c.hops == (1, 1) or not (_free(c.s) and _free(c.o)) or {c.s, c.o} & (known | values.keys())] or near
        best = min(ready, key=lambda c: (cost(c, known), clauses.index(c)))
        left.remove(best)
        out.append(best)
        known |= best.variables()
    return out


def solve(triples: DataFrame, clauses: Sequence[Clause], out: Sequence[str] | None = None, values: dict[str, list] | None = None, stats: DataFrame | None = None) -> DataFrame:
    """The distinct values of the variables ``out`` (all, if None; columns without the question mark) for which every clause
    has a triple.

    ``triples`` has s, p, o and possibly lit, which is the object where there is no other; nulls match nothing.  ``values``
    restricts variables to some values, which reach the tables.  ``stats`` are ``verb_statistics``, from which only the rows of
    the pattern's verbs are fetched; with them, joins begin at the rarest clause, without them in the order as written.  All
    clauses must hang together by variables: nothing is a cross join.
    """
    values = values or {}
    wanted = [v.lstrip("?") for v in (out or sorted({v for c in clauses for v in c.variables()}))]
    if not clauses or not wanted:
        raise ValueError("a pattern has a clause and a variable")
    if any(c.hops != (1, 1) and (c.p is None or _free(c.p)) for c in clauses):
        raise ValueError("a path needs a verb")
    if any(c.hops[0] < 0 or c.hops[1] is not None and c.hops[1] < c.hops[0] for c in clauses):
        raise ValueError("a path has no negative length, and its largest is not below its smallest")
    rows = triples.select("s", "p", (F.coalesce("o", "lit") if "lit" in triples.columns else F.col("o")).alias("o")).where("s is not null and p is not null and o is not null")
    known = {}
    if stats is not None:
        verbs = [c.p for c in clauses if c.p and not _free(c.p)]
        known = {r["p"]: (r["n"], r["subjects"], r["objects"] + r["literals"]) for r in stats.where(F.col("p").isin(verbs)).collect()}
    order = [c for c in clauses if c.variables()]
    order = _connected(order) if stats is None else _in_order(order, known, values)
    found: DataFrame | None = None
    seen: set[str] = set()
    asked = {f"?{v}" for v in wanted}
    once = False  # whether what is found holds no row twice
    while order:
        c, *order = order
        part, names, alone = _part(rows, c, found, seen, values), c.variables(), False
        if found is None and set() < (kept := names & _asked(asked, order)) < names:
            # the first clause's other variables would only multiply rows
            part, names = part.select(*[v[1:] for v in sorted(kept)]).distinct(), kept
        if found is not None and _hidden(c, order, names, seen, asked):
            # what lies behind a variable that nobody else asks for is found first, of the ends that are known: the ways
            # through that variable multiply with nothing then
            ends = [v[1:] for v in names & seen]
            found = found.select(*[v[1:] for v in sorted(seen & _asked(asked, [c, *order]))]).distinct()
            part, once, alone = part.join(found.select(*ends).hint("merge"), ends, "left_semi"), True, True
            while _hidden(c, order, names, seen, asked):
                c, *order = order
                part = part.join(_part(rows, c, None, set(), values).hint("merge"), [v[1:] for v in c.variables() & names])
                names = (names | c.variables()) & (_asked(asked, order) | seen)
                part = part.select(*[v[1:] for v in sorted(names)]).distinct()
        once = alone and once
        found = part if found is None else found.join(part.hint("merge"), [v[1:] for v in names & seen])
        seen = (seen | names) & {f"?{v}" for v in found.columns}
    for c in clauses:
        # a clause of values only holds or does not
        if not c.variables() and _part(rows, c, None, set(), values).isEmpty():
            found = found.where(F.lit(False))
    return found.select(*wanted) if once and set(found.columns) == set(wanted) else found.select(*wanted).distinct()


def _asked(wanted: set[str], clauses: Sequence[Clause]) -> set[str]:
    """The variables that are wanted, or that clauses ask for."""
    return wanted.union(*(c.variables() for c in clauses))


def _hidden(c: Clause, later: Sequence[Clause], names: set[str], seen: set[str], wanted: set[str]) -> bool:
    """Whether the clause behind ``c`` hangs on what ``c`` brings by variables alone that no other one and no result has."""
    if not later or c.hops != (1, 1) or later[0].hops != (1, 1) or not names & seen:
        return False
    shared = later[0].variables() & names
    return bool(shared) and not shared & (seen | _asked(wanted, later[1:])) and not later[0].variables() & seen


def _part(rows: DataFrame, c: Clause, found: DataFrame | None, seen: set[str], values: dict[str, list]) -> DataFrame:
    if c.hops == (1, 1):
        return _given(rows, {"s": c.s, "p": c.p, "o": c.o}, values)
    back, starts = _starts(rows, c, found, seen, values)
    return _given(_paths(rows, c, starts, back), {"s": c.s, "o": c.o}, values)


def _connected(clauses: Sequence[Clause]) -> list[Clause]:
    """As written, but for clauses that share nothing with those before them, which wait."""
    left, known, out = list(clauses), set(), []
    while left:
        at = next((c for c in left if not out or c.variables() & known), None)
        if at is None:
            raise ValueError("the pattern falls apart: no variable is shared")
        left.remove(at)
        out.append(at)
        known |= at.variables()
    return out


def _starts(rows: DataFrame, c: Clause, found: DataFrame | None, seen: set[str], values: dict[str, list]) -> tuple[bool, DataFrame]:
    """Where a path is walked from: a value, a variable that is known or restricted, else every subject; and whether it is walked
    backwards."""
    spark = rows.sparkSession
    for back, term in ((False, c.s), (True, c.o)):
        if not _free(term):
            return back, spark.createDataFrame([(term,)], "start string")
        if term in seen:
            return back, found.select(F.col(term[1:]).alias("start"))
        if term in values:
            return back, spark.createDataFrame([(v,) for v in values[term]], "start string")
    ends = rows.where(F.col("p") == c.p)
    # a path of no edge is at every node of the verb
    return False, ends.select(F.explode(F.array("s", "o")).alias("start")) if c.hops[0] == 0 else ends.select(F.col("s").alias("start"))

