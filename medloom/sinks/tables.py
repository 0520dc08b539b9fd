"""Writers: append, keyed upsert, tee, counts, tab separated indexes, RDF/XML and assertion logs."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from medloom.schema import Table
from medloom.sinks.keyed import KeyedTable

Sink = Callable[[DataFrame], None]
#: Statements of one element of RDF/XML at most.
STATEMENTS = 1000


def read_or_empty(df: DataFrame, path: str) -> DataFrame:
    """What a writer by key has stored at ``path``, with the columns of ``df``; nothing yet is empty."""
    try:
        return KeyedTable(df.sparkSession, path).read().select(*df.columns)
    except FileNotFoundError:
        return df.limit(0)


def append(path: str) -> Sink:
    return lambda df: df.write.mode("append").parquet(path)


def nowhere(df: DataFrame) -> None:
    """Runs the plan and keeps nothing."""
    df.write.format("noop").mode("overwrite").save()


def tee(*sinks: Sink) -> Sink:
    """Several sinks over one computation, which is kept between them."""

    def write(df: DataFrame) -> None:
        kept = df.persist()
        try:
            for sink in sinks:
                sink(kept)
        finally:
            kept.unpersist()

    return write


def mapped(f: Callable[[DataFrame], DataFrame], sink: Sink) -> Sink:
    """A sink behind a transformation; a filter or an explode is one as well."""
    return lambda df: sink(f(df))


def counted(sink: Sink, key: str | None = None) -> Callable[[DataFrame], dict]:
    """Writes and returns the number of rows, in all and with a key, counted while they pass."""

    def write(df: DataFrame) -> dict:
        seen = Observation()
        sink(df.observe(seen, F.count(F.lit(1)).alias("total"), *([F.count(key).alias("keyed")] if key else [])))
        return seen.get

    return write


def keyed(path: str, keys: list[str], order: list[str] | None = None) -> Sink:
    """Insert or update by key, in the buckets of the keys that come; a failed write leaves the old table."""
    return lambda df: KeyedTable(df.sparkSession, path, keys).upsert(df, order)


def declared(table: Table, path: str, number: str | None = None, stamp: Column | None = None) -> Sink:
    """Rows in the shape of a declared table, upserted by its keys or appended where it has none.  ``number`` is a column of
    generated numbers, which a table with keys may have; ``stamp`` is the time of the write in a column ``timestamp``."""
    if number and not table.keys:
        raise ValueError(f"{table.name} has no keys to number")
    if number:
        sink = lambda df: KeyedTable(df.sparkSession, path, list(table.keys)).upsert_numbered(df, number)
    else:
        sink = keyed(path, list(table.keys)) if table.keys else append(path)
    return mapped(lambda df: table.project(df, stamp), sink)


def insert_missing(path: str, keys: list[str]) -> Sink:
    """Insert if not exists: the first row of a key stays."""
    return lambda df: KeyedTable(df.sparkSession, path, keys).insert_missing(df)


def replace_keys(path: str, keys: list[str]) -> Sink:
    """All stored rows of the keys that come go, then the new rows are added; a failed write leaves the old table."""
    return lambda df: KeyedTable(df.sparkSession, path, keys).replace(df)


def copy_checked(source: DataFrame, path: str, keys: list[str]) -> tuple[int, int]:
    """Upsert a table and compare the numbers of rows: of the source and of what is stored."""
    keyed(path, keys)(source)
    return source.select(*keys).distinct().count(), KeyedTable(source.sparkSession, path).read().count()


def pairs(path: str, key: str, value: str) -> Sink:
    """Key and value as text, the last value of a key."""
    text = lambda df: df.select(F.col(key).cast("string").alias("key"), F.col(value).cast("string").alias("value"))
    return mapped(text, keyed(path, ["key"], ["value"]))


def points(path: str, payload: list[str], id_col: str = "id") -> Sink:
    """Vector points by id: ``text_dense`` (array<float>), ``text_sparse`` (index and value) and a payload of text."""

    def shape(df: DataFrame) -> DataFrame:
        entries = [x for c in payload for x in (F.lit(c), F.col(c).cast("string"))]
        return df.select(F.col(id_col).alias("id"), F.col("dense").cast("array<float>").alias("text_dense"), F.col("sparse").alias("text_sparse"), F.create_map(*entries).alias("payload"))

    return mapped(shape, replace_keys(path, ["id"]))


def put_objects(rows: DataFrame, folder: str, name: str = "name", content: str = "content") -> DataFrame:
    """Each row's content as an object of its name under ``folder`` (a URI that all executors reach): name and size.

    An object is written under another name and moved, so a task that is run again, or lost, leaves whole objects."""

    def run(batches):
        files, base = fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        for batch in batches:
            names, contents = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (name, content))
            for n, c in zip(names, contents, strict=True):
                whole = f"{base}/{n}"
                files.create_dir(whole.rpartition("/")[0], recursive=True)
                with files.open_output_stream(part := f"{whole}.{uuid.uuid4().hex}.tmp") as out:
                    out.write(c or b"")
                files.move(part, whole)
            yield pa.RecordBatch.from_pydict({"name": names, "size": pa.array([len(c or b"") for c in contents], pa.int64())})

    return rows.select(F.col(name).alias(name), F.col(content).cast("binary").alias(content)).mapInArrow(run, "name string, size bigint")


def delete_objects(rows: DataFrame, folder: str, name: str = "name") -> DataFrame:
    """The names of which an object was there, and is gone."""

    def run(batches):
        files, base = fs.FileSystem.from_uri(folder)
        for batch in batches:
            there = [n for n in batch.column(batch.schema.get_field_index(name)).to_pylist() if files.get_file_info(f"{base}/{n}").type == fs.FileType.File]
            for n in there:
                files.delete_file(f"{base}/{n}")
            yield pa.RecordBatch.from_pydict({"name": pa.array(there, pa.string())})

    return rows.select(name).mapInArrow(run, "name string")


def tab_index(path: str) -> Sink:
    return lambda df: df.write.mode("overwrite").csv(path, sep="\t")


def json_lines(path: str) -> Sink:
    return lambda df: df.write.mode("overwrite").json(path)


def assertion_log(path: str, origin: str) -> Sink:
    """Origin, uri, subject, verb and object, tab separated."""
    return lambda df: df.select(F.lit(origin).alias("origin"), "uri", "s", "p", F.coalesce("o", "lit").alias("o")).write.mode("append").csv(path, sep="\t")


def as_xml(prefix: str = "ex") -> Callable[[DataFrame], DataFrame]:
    """A description element per subject, verbs and objects in order, as rows of text; a subject of more than
    ``STATEMENTS`` has several elements, which say the same together."""

    def quote(c):
        return F.replace(F.replace(F.replace(F.replace(c, F.lit("&"), F.lit(escape("&"))), F.lit("<"), F.lit(escape("<"))), F.lit(">"), F.lit(escape(">"))), F.lit('"'), F.lit("&quot;"))

    def convert(df: DataFrame) -> DataFrame:
        verb = F.concat(F.lit(f"{prefix}:"), F.col("p"))
        one = F.when(F.col("o").isNotNull(), F.concat(F.lit("  <"), verb, F.lit(' rdf:resource="'), quote(F.col("o")), F.lit('"/>'))).otherwise(F.concat(F.lit("  <"), verb, F.lit(">"), quote(F.coalesce("lit", F.lit(""))), F.lit("</"), verb, F.lit(">")))
        numbered = df.select("s", one.alias("one")).withColumn("part", F.floor((F.row_number().over(Window.partitionBy("s").orderBy("one")) - 1) / STATEMENTS))
        g = numbered.groupBy("s", "part").agg(F.sort_array(F.collect_list("one")).alias("x"))
        return g.select(F.concat(F.lit('<rdf:Description rdf:about="'), quote(F.col("s")), F.lit('">\n'), F.array_join("x", "\n"), F.lit("\n</rdf:Description>")).alias("value"))

    return convert


def rdf_document(elements: DataFrame, namespaces: dict[str, str], comments: list[str] | None = None) -> DataFrame:
    """Lines of RDF/XML around elements (``value``, of ``as_xml``): each partition is a whole document, with the namespaces and
    comments at its head; a partition without elements has none.  Two hyphens of a comment are set apart, as XML wants."""
    spaces = {"rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#"} | namespaces
    head = ['<?xml version="1.0" encoding="UTF-8"?>', "<rdf:RDF " + " ".join(f"xmlns:{k}={quoteattr(v)}" for k, v in spaces.items()) + ">"]
    head += [f"<!-- {re.sub('-(?=-)', '- ', c)} -->" for c in comments or []]

    def run(batches):
        begun = False
        for batch in batches:
            if batch.num_rows:
                lines = batch.column("value").to_pylist()
                yield pa.RecordBatch.from_pydict({"value": lines if begun else head + lines})
                begun = True
        if begun:
            yield pa.RecordBatch.from_pydict({"value": ["</rdf:RDF>"]})

    return elements.select("value").mapInArrow(run, "value string")


def rdf_xml(path: str, prefix: str = "ex", space: str = "http://example.org/", comments: list[str] | None = None) -> Sink:
    """RDF/XML, a document a file."""
    return lambda df: rdf_document(as_xml(prefix)(df), {prefix: space}, comments).write.mode("overwrite").text(path)
