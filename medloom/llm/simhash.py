"""SimHash near-duplicates: fingerprints, deletion-variant index, connected groups."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm.components import components
from medloom.llm.shared import drop_stored, fresh, row_key, store, text_batches
from medloom.llm.textcols import column

SEED = 42
BITS = 64


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The signed 64-bit SimHash of one text (see ``fingerprints``)."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(lengths) - 1
        begins = (ends - lengths + 1)[: len(words) - shingle + 1].tolist()
        digest = xxhash.xxh64_intdigest
        n = len(begins)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(begins, ends[shingle - 1 :].tolist(), strict=True)), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 65536):
        counts += np.unpackbits(hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > len(hashes))
    return int(bits.view(">i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), shingle: int = 3) -> DataFrame:
    """``keep`` columns and fp: the SimHash of the lower-cased (A-Z) text's word shingles, repeats counted.

    Words are runs of anything but ASCII white space.  A text of fewer words than a shingle is one shingle; a text
    without words, or a null one, has fingerprint 0.
    """
    text_batches(docs.sparkSession)
    whole = fresh(docs, "whole_text")
    source = docs.select(*keep, F.col(text).cast("string").alias(whole))
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in source.schema.fields[:-1])}, fp bigint"

    def run(batches):
        for batch in batches:
            found = [fingerprint(t, shingle) for t in (x.as_py() for x in column(batch, whole))]
            yield pa.RecordBatch.from_arrays([*(column(batch, k) for k in keep), pa.array(found, pa.int64())], names=[*keep, "fp"])

    return source.mapInArrow(run, schema)


def variant_links(prints: DataFrame, distance: int = 2) -> DataFrame:
    """Pairs (u, v), u < v, of distinct fingerprints in column fp that differ in at most ``distance`` bits.

    The 64 bits are cut into ``distance // 2 + 1`` segments; two fingerprints within the distance differ by at most one
    bit in some segment.  Each segment is indexed once for every bit of it, that bit removed; two segments that differ
    by at most one bit share such a key.  An equality join on the keys finds every pair, and the exact distance is part
    of the join condition, so a bucket's other pairs are never rows.  As fingerprints are distinct, one has at most
    some two thousand links for distance 2 whatever the size of a group of copies.
    """
    cuts = distance // 2 + 1
    edges = [round(i * BITS / cuts) for i in range(cuts + 1)]
    spread = []
    for lo, hi in zip(edges, edges[1:], strict=False):
        width = hi - lo
        mask = (1 << width) - 1
        segment = F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit(mask if mask < 1 << 63 else -1).cast("bigint"))
        for bit in range(width):
            key = segment.bitwiseAND(F.lit(mask & ~(1 << bit)))
            spread.append(F.struct(F.lit(lo + bit).cast("smallint").alias("slot"), key.alias("key")))
    keys = prints.select("fp", F.explode(F.array(*spread)).alias("x")).select("fp", "x.slot", "x.key")
    a, b = keys.alias("a"), keys.alias("b")
    close = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= distance
    pairs = a.join(b.hint("merge"), (F.col("a.slot") == F.col("b.slot")) & (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp")) & close)
    return pairs.select(F.col("a.fp").alias("u"), F.col("b.fp").alias("v")).distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """One row per document: ``id_col``, fp (long), component_id (smallest id reachable over links, itself included).

    Documents of equal fingerprints form one class, and links run between classes, so a large group of copies is one
    node.  Null ids are kept; a component of null ids only has a null component_id.  Repeated rows stay repeated.
    No table is broadcast: all of them grow with the documents.  An empty table gives an empty one.
    """
    prints = store(fingerprints(docs, text, (id_col,), shingle), "prints")
    classes = store(prints.groupBy("fp").agg(F.min(id_col).alias("least")), "classes")
    links = store(variant_links(classes.select("fp"), distance), "near")
    roots = components(links)
    drop_stored(links)
    group = classes.join(roots.withColumnRenamed("node", "fp").hint("merge"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = group.groupBy("root").agg(F.min("least").alias("component_id"))
    named = store(group.join(least.hint("merge"), "root").select("fp", "component_id"), "groups")
    drop_stored(classes, roots)
    return prints.join(named.hint("merge"), "fp").select(id_col, "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 3, distance: int = 2) -> DataFrame:
    """``docs`` with one document of each group: the first by id, then by the hash of the whole row; nulls last.

    Rows that repeat in every column count as one.
    """
    names = docs.columns
    key = fresh(docs, "__key")
    keyed = docs.withColumn(key, row_key(*[c for c, t in docs.dtypes if not t.startswith("map")]))
    prints = store(fingerprints(keyed.select(F.col(key).alias("k"), F.col(id_col).alias("i"), F.col(text).alias("t")), "t", ("i", "k"), shingle), "prints")
    classes = prints.groupBy("fp").agg(F.min(F.struct(F.col("i").isNull().alias("n"), "i", "k")).alias("least"))
    classes = store(classes, "classes")
    links = store(variant_links(classes.select("fp"), distance), "near")
    roots = components(links)
    drop_stored(links)
    group = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("least", F.coalesce("root", "fp").alias("root"))
    chosen = store(group.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.k").alias(key)).distinct(), "chosen")
    drop_stored(prints, classes, roots)
    return keyed.join(chosen, key, "left_semi").dropDuplicates([key]).select(*names)
