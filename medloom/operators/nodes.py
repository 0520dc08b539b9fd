"""Chunk nodes: embedders, parents, children with result codes, and centroids of their clusters."""

from __future__ import annotations

from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from medloom.operators.reach import settled
from medloom.operators.sentences import chunked
from medloom.sinks.keyed import KeyedTable

#: Result codes of a record (fixed values).
CODES = {"ok": 1, "in_progress": 2, "index_failed": -1, "no_full_text": -2, "no_location": -3, "bad_abstract": -4, "empty": -5, "embedding_failed": -6, "other": -7}


#: Texts that are embedded at a time.
AT_ONCE = 64


@lru_cache(1 << 16)
def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(word)


@lru_cache(1 << 16)
def _term(word: str) -> int:
    return xxhash.xxh32_intdigest(word) % 30_000


def hashed_vector(text: str, dim: int = 64) -> np.ndarray:
    """A stand-in for an embedding service: words hashed to signed dimensions, of unit length."""
    v = np.zeros(dim, np.float32)
    for w in text.lower().split():
        h = _hash(w)
        v[h % dim] += 1 if h >> 63 else -1
    norm = np.linalg.norm(v)
    return v / norm if norm else v


def embed(nodes: DataFrame, text: str = "text", dense=hashed_vector) -> DataFrame:
    """``nodes`` with dense (array<float>; null where the embedder answers None) and sparse (array of index and value: term
    counts by hash)."""

    kind = pa.list_(pa.struct([("index", pa.int32()), ("value", pa.float64())]))

    def terms(texts: list[str]) -> pa.Array:
        ends, index, value = [0], [], []
        for t in texts:
            counts = Counter(_term(w) for w in t.lower().split())
            for i in sorted(counts):
                index.append(i)
                value.append(float(counts[i]))
            ends.append(len(index))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(index, pa.int32()), pa.array(value, pa.float64())], fields=list(kind.value_type)))

    def run(batches):
        for whole in batches:
            # a batch may hold thousands of long texts: few at a time, so that what Python holds does not grow with them
            for at in range(0, len(whole), AT_ONCE):
                batch = whole.slice(at, AT_ONCE)
                texts = [t or "" for t in batch.column(text).to_pylist()]
                vectors = [dense(t) for t in texts]
                extra = [pa.array([None if v is None else v.tolist() for v in vectors], pa.list_(pa.float32())), terms(texts).cast(kind)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *extra], names=[*batch.schema.names, "dense", "sparse"])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema.fields)
    return nodes.mapInArrow(run, f"{own}, dense array<float>, sparse array<struct<index:int,value:double>>")


def node_id(*parts: Column) -> Column:
    """An id that follows from what the node is, so reruns agree."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def parents(records: DataFrame, key: str, abstract: str, size: int = 1024, overlap: int = 50, meta: list[str] | None = None) -> DataFrame:
    """Chunks of whole sentences of the abstracts of valid records, with metadata of which the ids stay out of what is
    embedded."""
    ok = records.where((F.col(key) > 0) & (F.length(F.trim(abstract)) > 0))
    c = chunked(ok, abstract, [key, *(meta or [])], size, overlap)
    return c.select(node_id(F.lit("parent"), F.col(key), F.col("position")).alias("node_id"), F.col(key).alias("record_id"), F.col("chunk").alias("text"), F.create_map(F.lit("_node_type"), F.lit("parent"), *[x for m in (meta or []) for x in (F.lit(m), F.col(m).cast("string"))]).alias("metadata"), F.array(F.lit("_node_type")).alias("excluded"))


def children(sections: DataFrame, key: str, text: str = "section_text", size: int = 512, overlap: int = 30) -> DataFrame:
    """Chunks of whole sentences of grouped sections."""
    c = chunked(sections, text, [key, "head"], size, overlap)
    return c.select(node_id(F.lit("child"), F.col(key), F.col("head"), F.col("position")).alias("node_id"), F.col(key).alias("record_id"), "head", F.col("chunk").alias("text"))


def result_code(abstract_ok: Column, location: Column, full_text: Column, nodes: Column, embedded: Column, indexed: Column) -> Column:
    """The first thing that went wrong, else ok."""
    return (
        F.when(~F.coalesce(abstract_ok, F.lit(False)), CODES["bad_abstract"]).when(location.isNull(), CODES["no_location"]).when(full_text.isNull(), CODES["no_full_text"])
        .when(F.coalesce(nodes, F.lit(0)) == 0, CODES["empty"]).when(~F.coalesce(embedded, F.lit(False)), CODES["embedding_failed"]).when(~F.coalesce(indexed, F.lit(False)), CODES["index_failed"])
        .otherwise(CODES["ok"]).cast("smallint")
    )


def ingest_children(records: DataFrame, locations: DataFrame, sections: DataFrame, index: str, results: str, size: int = 512, overlap: int = 30, dense=hashed_vector) -> dict[str, int]:
    """Full texts of records to child nodes in an index, with a result for every record; returns how many came to each code.

    ``records``: record_id and abstract_ok; ``locations``: record_id and location; ``sections``: record_id, head and
    section_text of the full texts that were read.  Nodes are chunks of whole sentences; a record of which the embedder
    leaves a node out is not indexed.  ``index`` is a keyed table of nodes by record, so a record that comes again
    replaces its nodes; what it holds afterwards is what counts as indexed.  ``results``, by record, has record_id, code
    and n_nodes.  Codes are counted while results are written."""
    spark = records.sparkSession
    # chunks are made and embedded once: three steps read them
    made = settled(embed(children(sections.join(records.where("abstract_ok").select("record_id"), "record_id", "left_semi"), "record_id", size=size, overlap=overlap), dense=dense))
    each = made.groupBy("record_id").agg(F.count("*").alias("n_nodes"), F.bool_and(F.col("dense").isNotNull()).alias("embedded"))
    whole = made.join(each.where("embedded").select("record_id"), "record_id", "left_semi")
    store = KeyedTable(spark, index, ["record_id"])
    store.replace(whole.select("node_id", "record_id", "head", "text", "dense", "sparse"))
    there = store.read().groupBy("record_id").agg(F.count("*").alias("n_indexed"))
    read = sections.select("record_id").distinct().withColumn("read", F.lit(True))
    state = records.join(locations.groupBy("record_id").agg(F.max("location").alias("location")), "record_id", "left").join(read, "record_id", "left").join(each, "record_id", "left").join(there, "record_id", "left")
    code = result_code(F.col("abstract_ok"), F.col("location"), F.col("read"), F.col("n_nodes"), F.col("embedded"), F.coalesce("n_indexed", F.lit(0)) == F.col("n_nodes"))
    coded = state.select("record_id", code.alias("code"), F.coalesce("n_nodes", F.lit(0)).cast("bigint").alias("n_nodes"))
    seen = Observation()
    counted = coded.observe(seen, F.count("*").alias("records"), F.sum("n_nodes").alias("nodes"), *[F.count_if(F.col("code") == c).alias(name) for name, c in CODES.items()])
    counted.write.mode("overwrite").parquet(results)
    return seen.get
