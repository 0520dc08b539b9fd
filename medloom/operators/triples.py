"""Triples as a table: assertion, pattern access, rewriting."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medloom.operators import reach

COLUMNS = ["uri", "s", "p", "o", "lit"]


def assert_triples(named: DataFrame, anonymous: DataFrame) -> DataFrame:
    """Anonymous triples once, and not where an equal one has a name."""
    keys = ["s", "p", "o", "lit"]
    a = anonymous.dropDuplicates(keys)
    n = named.select(*[F.col(k).alias(f"n_{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"n_{k}")) for k in keys]
    return named.select(*COLUMNS).unionByName(a.join(n, same, "left_anti").select(*COLUMNS))


def pattern(triples: DataFrame, s: str | None = None, p: str | list[str] | None = None, o: str | None = None, uri: str | None = None) -> DataFrame:
    out = triples
    for name, value in (("s", s), ("p", p), ("o", o), ("uri", uri)):
        if value is not None:
            out = out.where(F.col(name).isin(value) if isinstance(value, list) else F.col(name) == value)
    return out


def objects(triples: DataFrame) -> DataFrame:
    return triples.select(F.coalesce("o", "lit").alias("object"))


def verb_statistics(triples: DataFrame) -> DataFrame:
    return triples.groupBy("p").agg(F.count("*").alias("n"), F.count_distinct("s").alias("subjects"), F.count_distinct("o").alias("objects"), F.count("lit").alias("literals"))


def assert_and_name(triples: DataFrame, named: DataFrame) -> DataFrame:
    """``named`` (uri, s, p, o) added: an anonymous triple of the same parts gets the name, one that has that name stays as
    it is, and one of another name stands beside the new one."""
    parts = ["s", "p", "o"]
    new = named.select("uri", *parts).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"n_{c}")) for c in parts]
    renamed = new.select(*[F.col(c).alias(f"n_{c}") for c in parts]).distinct()
    plain = F.col("uri").isNull() & F.col("lit").isNull()
    rest = triples.where(~plain).unionByName(triples.where(plain).join(renamed, same, "left_anti"))
    there = triples.where("uri is not null and lit is null").select("uri", *parts)
    fresh = new.join(there, ["uri", *parts], "left_anti")
    return rest.select(*COLUMNS).unionByName(fresh.withColumn("lit", F.lit(None).cast("string")).select(*COLUMNS))


def _matched(triples: DataFrame, other: DataFrame, how: str) -> DataFrame:
    o = other.select(*[F.col(c).alias(f"o_{c}") for c in COLUMNS]).distinct()
    return triples.join(o, [F.col(c).eqNullSafe(F.col(f"o_{c}")) for c in COLUMNS], how)


def add_all(triples: DataFrame, other: DataFrame) -> DataFrame:
    """Both; what is there already is not added again."""
    new = other.select(*COLUMNS).distinct()
    return triples.select(*COLUMNS).unionByName(_matched(new, triples, "left_anti"))


def remove_all(triples: DataFrame, other: DataFrame) -> DataFrame:
    """Without the triples of ``other``, by all of their parts."""
    return _matched(triples.select(*COLUMNS), other, "left_anti")


def contains_all(triples: DataFrame, other: DataFrame) -> DataFrame:
    """One row: how many distinct triples of ``other`` are missing, and whether none is."""
    missing = F.count(F.lit(1))
    return _matched(other.select(*COLUMNS).distinct(), triples, "left_anti").agg(missing.alias("missing"), (missing == 0).alias("contains"))


def first_match(triples: DataFrame, **parts) -> DataFrame:
    """The first triple of a pattern in the order of its parts."""
    return pattern(triples, **parts).orderBy(*[F.col(c).asc_nulls_last() for c in ("s", "p", "o", "lit", "uri")]).limit(1)


def terms(labels: DataFrame, concept: str = "concept", label: str = "label", text: str = "text", preferred: str = "preferred") -> DataFrame:
    """Three triples for each label of a concept: the concept's type, its preferred or alternative label, and the label's
    literal form."""
    e = lambda s, p, o, lit: F.struct(s.alias("s"), p.alias("p"), o.alias("o"), lit.alias("lit"))
    none = F.lit(None).cast("string")
    verb = F.when(F.col(preferred), F.lit("skosxl:prefLabel")).otherwise(F.lit("skosxl:altLabel"))
    three = F.array(
        e(F.col(concept), F.lit("rdf:type"), F.lit("skos:Concept"), none), e(F.col(concept), verb, F.col(label), none), e(F.col(label), F.lit("skosxl:literalForm"), none, F.col(text)),
    )
    return labels.select(F.explode(three).alias("t")).select(none.alias("uri"), "t.*").distinct().select(*COLUMNS)


def replace_uri(triples: DataFrame, old: str, new: str) -> DataFrame:
    """``old`` as ``new`` in every position, with the number of replacements of each triple; ``merged`` asserts the result
    anew."""
    hits = sum((F.coalesce((F.col(c) == old).cast("int"), F.lit(0)) for c in ("uri", "s", "p", "o")), F.lit(0))
    changed = {c: F.when(F.col(c) == old, F.lit(new)).otherwise(F.col(c)) for c in ("uri", "s", "p", "o")}
    return triples.withColumn("replaced", hits).withColumns(changed)


def merged(replaced: DataFrame) -> DataFrame:
    """Triples that a replacement has made equal, once: named ones as they are, others only where none has a name."""
    changed = replaced.select(*COLUMNS)
    return assert_triples(changed.where("uri is not null").distinct(), changed.where("uri is null"))


def remove_uri(triples: DataFrame, uri: str) -> DataFrame:
    keep = ~F.greatest(*[F.coalesce(F.col(c) == uri, F.lit(False)) for c in ("uri", "s", "p", "o")])
    return triples.where(keep)


def drop_shared_categories(triples: DataFrame, of: str, other: str, verb: str, preserved: list[str]) -> DataFrame:
    """Without the categories of ``of`` that ``other`` has as well, but for the preserved ones."""
    theirs = triples.where((F.col("s") == other) & (F.col("p") == verb)).select("o").distinct().where(~F.col("o").isin(preserved) if preserved else F.lit(True))
    mine = (F.col("s") == of) & (F.col("p") == verb)
    return triples.where(~mine | F.col("o").isNull()).unionByName(triples.where(mine & F.col("o").isNotNull()).join(theirs, "o", "left_anti").select(*triples.columns))


def members(triples: DataFrame, container: str, numeric: bool = True) -> DataFrame:
    """Members rdf:_1, rdf:_2 ... of containers in order; ``numeric`` False orders the names as text."""
    m = triples.where(F.col("p").rlike("^rdf:_[0-9]+$"))
    order = F.regexp_extract("p", "([0-9]+)$", 1).cast("bigint") if numeric else F.col("p")
    return m.withColumn("position", F.row_number().over(Window.partitionBy("s").orderBy(order))).select(F.col("s").alias(container), "position", F.coalesce("o", "lit").alias("member"))


def collections(triples: DataFrame, rdf: str = "http://www.w3.org/1999/02/22-rdf-syntax-ns#") -> DataFrame:
    """(head, position from 0, member) of lists by rdf:first and rdf:rest, of any length; an empty list (rdf:nil) has no row.

    Cells point back to the cell before them; the head is the root of that forest and the position the depth in it, which takes as
    many joins as the logarithm of the longest list.  A tail that lists share is counted to the list whose cell before it has
    the smallest name; a circle begins at its smallest cell.
    """
    cells = triples.where((F.col("p") == rdf + "first") & F.col("s").isNotNull())
    before = triples.where((F.col("p") == rdf + "rest") & (F.col("o") != rdf + "nil") & (F.col("o") != F.col("s"))).select(F.col("o").alias("s"), F.col("s").alias("o")).distinct()
    placed = reach.labels(reach.forest(before), cells.select(F.col("s").alias("node")).distinct())
    return cells.join(placed, F.col("s") == F.col("node")).select(F.col("root").alias("head"), F.col("depth").alias("position"), F.coalesce("o", "lit").alias("member"))


def sequence_triples(rows: DataFrame, subject: str, items: str) -> DataFrame:
    e = rows.select(F.col(subject).alias("s"), F.posexplode(items).alias("i", "lit"))
    return e.select(F.lit(None).cast("string").alias("uri"), "s", F.concat(F.lit("rdf:_"), (F.col("i") + 1).cast("string")).alias("p"), F.lit(None).cast("string").alias("o"), "lit")


def resources(triples: DataFrame, *wanted: tuple[str, list[str]], any_of: bool = False) -> DataFrame:
    """Subjects with the properties: (verb, values), where no values mean any; all of them, or one if ``any_of``."""
    sets = [triples.where((F.col("p") == v) & (F.coalesce("o", "lit").isin(values) if values else F.lit(True))).select("s").distinct() for v, values in wanted]
    out = sets[0]
    for other in sets[1:]:
        out = out.union(other).distinct() if any_of else out.join(other, "s", "left_semi")
    return out
