"""Binary fingerprints of any width as arrays of 64-bit words, and their similarity."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from medloom.operators.reach import settled
from medloom.operators.vectors import met

#: Queries that are sent to every task at most.
FEW = 2048
#: Queries whose similarities are held together.
_RUN = 64


def words_of(bits: Column, width: int) -> Column:
    """Words with the bits of a list of numbers (from 0, below ``width``) set."""
    one = lambda b: F.call_function("shiftleft", F.lit(1).cast("bigint"), (b % 64).cast("int"))
    word = lambda w: F.aggregate(F.filter(bits, lambda b: F.floor(b / 64) == w), F.lit(0).cast("bigint"), lambda s, b: s.bitwiseOR(one(b)))
    return F.transform(F.sequence(F.lit(0), F.lit(-(-width // 64) - 1)), word)


def bits_of(words: Column) -> Column:
    """Numbers of the bits that are set, ascending."""
    has = lambda w, k: F.call_function("shiftrightunsigned", w, k).bitwiseAND(F.lit(1).cast("bigint")) == 1
    return F.flatten(F.transform(words, lambda w, i: F.transform(F.filter(F.sequence(F.lit(0), F.lit(63)), lambda k: has(w, k)), lambda k: (i * 64 + k).cast("int"))))


def sign_bits(v: Column) -> Column:
    """A fingerprint of a vector of any length: bit i is set where component i is positive."""
    bit = lambda w, i: F.coalesce(F.try_element_at(v, (w * 64 + i + 1).cast("int")) > 0, F.lit(False))
    one = lambda i: F.call_function("shiftleft", F.lit(1).cast("bigint"), i)
    word = lambda w: F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), lambda s, i: F.when(bit(w, i), s.bitwiseOR(one(i))).otherwise(s))
    return F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), (F.ceil(F.size(v) / 64) - 1).cast("int"))), word)


def set_bits(words: Column) -> Column:
    """How many bits are set."""
    return F.aggregate(words, F.lit(0), lambda s, w: s + F.bit_count(w))


def tanimoto(a: Column, b: Column) -> Column:
    """Shared bits over all bits of two fingerprints; a shorter one has no bits beyond its end.  Null where neither has a
    bit set."""
    zero = F.lit(0).cast("bigint")
    each = lambda f: F.aggregate(F.zip_with(a, b, lambda x, y: f(F.coalesce(x, zero), F.coalesce(y, zero))), F.lit(0), lambda s, n: s + n)
    return F.try_divide(each(lambda x, y: F.bit_count(x.bitwiseAND(y))), each(lambda x, y: F.bit_count(x.bitwiseOR(y))))


def search(queries: DataFrame, prints: DataFrame, least: float) -> DataFrame:
    """A stated set of queries (query_id, q) against all fingerprints (id, fp), with the similarity, from ``least`` (over 0)
    on.

    Blocks of at most about ``FEW`` queries meet shards of fingerprints; only pairs that are similar become rows."""
    q, p = queries.select("query_id", "q").where("q is not null"), prints.select("id", "fp").where("fp is not null")
    kinds = [to_arrow_type(d.schema[c].dataType) for d, c in ((q, "query_id"), (p, "id"))]
    schema = pa.schema([("query_id", kinds[0]), ("id", kinds[1]), ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [schema.empty_table()]
        if len(left) and len(right):
            a, b = _matrices(left.column("q"), right.column("fp"))
            have = [np.bitwise_count(x).sum(axis=1, dtype=np.int32) for x in (a, b)]
            for at in range(0, len(a), _RUN):
                x = a[at : at + _RUN]
                both = np.zeros((len(x), len(b)), np.int32)
                for k in range(a.shape[1]):
                    both += np.bitwise_count(x[:, None, k] & b[None, :, k])
                every = have[0][at : at + _RUN, None] + have[1] - both
                score = both / np.maximum(every, 1)
                i, j = np.nonzero((score >= least) & (every > 0))
                out.append(pa.table([left.column("query_id").take(pa.array(i + at)), right.column("id").take(pa.array(j)), score[i, j]], schema=schema))
        return pa.concat_tables(out)

    types = f"query_id {q.schema['query_id'].dataType.simpleString()}, id {p.schema['id'].dataType.simpleString()}, score double"
    return met(q, p, FEW, q.count(), p.count(), run, types).select("query_id", "id", F.round("score", 6).alias("similarity"))


def _matrices(*columns: pa.ChunkedArray) -> list[np.ndarray]:
    """Lists of words as rows, of one width, zeros behind their ends."""
    lists = [c.combine_chunks() for c in columns]
    sizes = [pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in lists]
    width, out = max(1, *(int(s.max()) for s in sizes)), []
    for x, size in zip(lists, sizes, strict=True):
        words = np.zeros((len(x), width), np.uint64)
        row = np.repeat(np.arange(len(x)), size)
        words[row, np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)] = pc.fill_null(x.flatten(), 0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        out.append(words)
    return out


def members(prints: DataFrame) -> DataFrame:
    """``prints`` (id, fp): id and least, the least id of an equal fingerprint."""
    return prints.join(prints.groupBy("fp").agg(F.min("id").alias("least")), "fp").select("id", "least")


def _bits(fp: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of every bit that is set, in the order of rows."""
    size = pc.fill_null(pc.list_value_length(fp), 0).to_numpy(zero_copy_only=False)
    flat = fp.flatten().to_numpy(zero_copy_only=False).astype("<i8").view(np.uint8).reshape(-1, 8)
    word, bit = np.nonzero(np.unpackbits(flat, axis=1, bitorder="little"))
    row = np.repeat(np.arange(len(fp)), size)
    first = np.repeat(np.cumsum(size) - size, size)
    return row[word], 64 * (word - first[word]) + bit


def _parts(n: int, least: float, halved: bool = False) -> int:
    """Into how many parts the bits fall where the larger fingerprint has ``n``: one more than can differ.  ``halved``: bits
    differ in twos."""
    differ = int(2 * n * (1 - least) / (1 + least) + 1e-9)
    return (differ // 2 if halved else differ) + 1


def _dealt(seen: dict[int, int], parts: int) -> np.ndarray:
    """The part of every bit, such that parts have about as many set bits: the most frequent first, to the part that has
    least."""
    out, heap = np.zeros(max(seen, default=0) + 1, np.int64), [(0, p) for p in range(parts)]
    for bit in sorted(seen, key=lambda b: (-seen[b], b)):
        load, part = heapq.heappop(heap)
        out[bit] = part
        heapq.heappush(heap, (load + seen[bit], part))
    return out


def bit_counts(prints: DataFrame) -> dict[int, int]:
    """How many fingerprints have each bit: one number for each bit of the width."""

    def run(batches):
        for batch in batches:
            many = np.bincount(_bits(batch.column("fp"))[1])
            some = np.flatnonzero(many)
            yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(many[some].astype(np.int64))], names=["bit", "n"])

    return {r["bit"]: r["n"] for r in prints.select("fp").mapInArrow(run, "bit int, n bigint").groupBy("bit").agg(F.sum("n").alias("n")).collect()}


def alike(prints: DataFrame, group: int) -> bool:
    """Whether all fingerprints have as many bits as each other in each group of ``group`` bits in a row."""

    def run(batches):
        for batch in batches:
            row, bit = _bits(batch.column("fp"))
            many = np.zeros((len(batch), int(bit.max(initial=0)) // group + 1), np.int32)
            np.add.at(many, (row, bit // group), 1)
            kinds = {",".join(f"{g}:{n}" for g, n in enumerate(x) if n) for x in np.unique(many, axis=0).tolist()}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(kinds), pa.string())], names=["kind"])

    return len(prints.select("fp").mapInArrow(run, "kind string").distinct().take(2)) < 2


def signatures(prints: DataFrame, least: float, group: int = 1, halved: bool = False) -> DataFrame:
    """key, id, n and parts of every fingerprint that has a bit: what similar ones meet by.

    Two sets with a similarity of ``least`` differ in at most d = (|a| + |b|) (1 - least) / (1 + least) bits, so if all bits
    are dealt to d + 1 parts, the sets are the same in one of them: the keys are the contents of the parts.  d follows
    from the larger set: a fingerprint gives the keys of each number of parts that a similar one of its size or more, of the
    sizes that there are, may ask for.  Bits are dealt so that each part has about as many that are set.

    ``halved``: all are ``alike`` in their groups, so two of them differ in a group by two bits at least, in d / 2 groups at
    most, and whole groups are dealt to half as many parts, which say twice as much."""
    kind = prints.schema["id"].dataType.simpleString()
    seen = bit_counts(prints)
    group = group if halved else 1
    groups: dict[int, int] = {}
    for b, n in seen.items():
        groups[b // group] = groups.get(b // group, 0) + n
    # numbers of set bits, as many as the width has bits at most
    there = sorted(r[0] for r in prints.where("fp is not null").select(set_bits(F.col("fp"))).distinct().collect())
    dealt: dict[int, np.ndarray] = {}

    def run(batches):
        mark = np.array([xxhash.xxh64_intdigest(b.to_bytes(4, "little")) for b in range(max(seen, default=0) + 1)], np.uint64)
        for batch in batches:
            row, bit = _bits(batch.column("fp"))
            n = np.bincount(row, minlength=len(batch))
            lists: dict[int, list[int]] = {}
            for size in np.unique(n[n > 0]).tolist():
                for k in {_parts(m, least, halved) for m in there if size <= m <= int(size / least + 1e-9)}:
                    lists.setdefault(k, []).append(size)
            for k, sizes in lists.items():
                if k not in dealt:
                    dealt[k] = np.repeat(_dealt(groups, k), group)
                own = np.isin(n, sizes)
                rows = np.flatnonzero(own)
                place = np.cumsum(own) - 1
                mine = own[row]
                content = np.zeros(len(rows) * k, np.uint64)
                np.add.at(content, place[row[mine]] * k + dealt[k][bit[mine]], mark[bit[mine]])
                salt = np.array([xxhash.xxh64_intdigest(b"%d,%d" % (k, p)) for p in range(k)], np.uint64)
                key = (content.reshape(-1, k) ^ salt) * np.uint64(0x9E3779B97F4A7C15)
                at = np.repeat(rows, k)
                yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), batch.column("id").take(pa.array(at)), pa.array(n[at].astype(np.int32)), pa.array(np.full(len(at), k, np.int32))], names=["key", "id", "n", "parts"])

    return prints.select("id", "fp").mapInArrow(run, f"key bigint, id {kind}, n int, parts int")


def links(prints: DataFrame, least: float, group: int = 1) -> DataFrame:
    """All fingerprints (id, fp) against all, itself included: query_id, id, similarity of those from ``least`` (over 0)
    on, once per ordered pair of distinct fingerprints; those without a bit are like none.

    An end is the least id of its fingerprint (``members`` has the others), so copies do not multiply links.  Candidates
    have the same bits in one part (``signatures``) and sizes that allow the threshold; similarities are exact.  ``group``:
    that many bits in a row are levels of one value; where all are ``alike`` in them, candidates are far fewer."""
    one = settled(prints.groupBy("fp").agg(F.min("id").alias("id")).select("id", "fp"))
    halved = group > 1 and alike(one, group)
    given = signatures(one, least, group, halved)
    a, b = (given.select("key", *[F.col(c).alias(f"{x}_{c}") for c in ("id", "n", "parts")]) for x in "ab")
    low, high = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    differ = F.floor(2 * high * (1 - least) / (1 + least) + 1e-9)
    asked = (F.floor(differ / 2) if halved else differ) + 1
    near = (F.col("a_id") < F.col("b_id")) & (F.col("a_parts") == F.col("b_parts")) & (low >= high * least - 1e-9) & (F.col("a_parts") == asked)
    met = a.join(b, "key").where(near).select("a_id", "b_id").distinct()
    full = met.join(one.select(F.col("id").alias("a_id"), F.col("fp").alias("a_fp")), "a_id").join(one.select(F.col("id").alias("b_id"), F.col("fp").alias("b_fp")), "b_id")
    found = full.withColumn("score", tanimoto(F.col("a_fp"), F.col("b_fp"))).where(F.col("score") >= least).select("a_id", "b_id", F.round("score", 6).alias("similarity"))
    both = found.select(F.explode(F.array(F.struct(F.col("a_id").alias("query_id"), F.col("b_id").alias("id")), F.struct(F.col("b_id").alias("query_id"), F.col("a_id").alias("id")))).alias("p"), "similarity").select("p.*", "similarity")
    own = one.where(set_bits(F.col("fp")) > 0).select(F.col("id").alias("query_id"), "id", F.lit(1.0).alias("similarity"))
    return both.unionByName(own)


def every_link(prints: DataFrame, least: float, group: int = 1) -> DataFrame:
    """``links`` with copies as ends of their own: query_id, id, similarity once per ordered pair of different ids."""
    one = members(prints)
    ends = [one.select(F.col("least").alias(c), F.col("id").alias(f"own_{c}")) for c in ("query_id", "id")]
    out = links(prints, least, group).join(ends[0], "query_id").join(ends[1], "id").where("own_query_id <> own_id")
    return out.select(F.col("own_query_id").alias("query_id"), F.col("own_id").alias("id"), "similarity")
