"""Dense and sparse vectors: similarity, top-k, centroids, two-stage search."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Null where a vector is zero."""
    return F.try_divide(dot(a, b), length(a) * length(b))


def length(v: Column) -> Column:
    return F.sqrt(dot(v, v))


#: Queries that one task compares at a time, and vectors that they are compared with; where all pairs are results, queries
#: that are multiplied at a time.
FEW, SHARD, PAIRS = 4096, 8192, 256
#: Queries and vectors that one task compares at most by cosine: the wider, the less often each is sent.
WIDE = 32_768
#: Queries whose scores are held together.
_RUN = 256


def _dealt(df: DataFrame, key: str, own: str, other: str, parts: int, others: int) -> DataFrame:
    """``df`` dealt to ``parts`` by the hash of ``key`` (column ``own``), once for each of the ``others``."""
    return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")).withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))


def met(queries: DataFrame, vectors: DataFrame, block: int, n_queries: int, n_vectors: int, run, schema: str, shard: int = SHARD) -> DataFrame:
    """``run(queries, vectors)`` over each block of queries and each shard of vectors, as Arrow tables."""
    blocks, shards = max(1, -(-n_queries // block)), max(1, -(-n_vectors // shard))
    q = _dealt(queries, "query_id", "block", "shard", blocks, shards)
    v = _dealt(vectors, "id", "shard", "block", shards, blocks)
    # both sides may be made of one table's columns: those of the vectors get other names on the way
    v = v.withColumnsRenamed({c: f"{c}_of_v" for c in v.columns})

    def renamed(left: pa.Table, right: pa.Table) -> pa.Table:
        return run(left, right.rename_columns([c.removesuffix("_of_v") for c in right.column_names]))

    return q.groupBy("block", "shard").cogroup(v.groupBy("block_of_v", "shard_of_v")).applyInArrow(renamed, schema)


#: Members that meet a run of queries together.
_STEP = 2048


def streamed(queries: DataFrame, members: DataFrame, n_queries: int, n_members: int, run, schema: str) -> DataFrame:
    """What ``run(queries, members)`` gives, as Arrow tables, for runs of at most ``PAIRS`` queries and ``_STEP`` members.

    For queries (query_id and more) that are few beside the members (id and more): each shard of members has a copy of the
    queries, ``WIDE`` at most, so members are shuffled once for each ``WIDE`` queries, and results are handed on run by run.
    Columns of one name are of one type."""
    blocks, shards = max(1, -(-n_queries // WIDE)), max(1, -(-n_members // SHARD), min(4 * queries.sparkSession.sparkContext.defaultParallelism, -(-n_members // _STEP)))
    q, v = _dealt(queries, "query_id", "block", "shard", blocks, shards), _dealt(members, "id", "shard", "block", shards, blocks)
    cell = (F.col("block") * shards + F.col("shard")).cast("int").alias("cell")
    kinds = {f.name: f.dataType for f in [*members.schema.fields, *queries.schema.fields]}
    side = lambda df, own, kind: df.select(cell, F.lit(kind).alias("kind"), *(F.col(c) if c in own else F.lit(None).cast(t).alias(c) for c, t in kinds.items()))
    both = side(q, queries.columns, 0).unionByName(side(v, members.columns, 1))

    def work(batches):
        asking, runs = [], None
        for batch in batches:
            # queries come before members
            own = pc.equal(batch.column("kind"), 0)
            asking += [b for b in [batch.filter(own)] if len(b)]
            others = pa.Table.from_batches([batch.filter(pc.invert(own))])
            if not len(others) or not asking:
                continue
            if runs is None:
                whole = pa.Table.from_batches(asking)
                runs = [whole.take(pa.array(np.arange(at, min(at + PAIRS, len(whole))))) for at in range(0, len(whole), PAIRS)]
            for at in range(0, len(others), _STEP):
                step = others.take(pa.array(np.arange(at, min(at + _STEP, len(others)))))
                for left in runs:
                    yield from run(left, step).combine_chunks().to_batches()

    return both.repartitionById(blocks * shards, F.col("cell")).sortWithinPartitions("kind").mapInArrow(work, schema)


def _rows(column: pa.ChunkedArray) -> np.ndarray:
    """A matrix of lists of one length."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(flat), -1)


def _rounded(x: np.ndarray) -> np.ndarray:
    """To six places, halves away from zero as Spark rounds a double's shortest decimal form."""
    scaled = np.abs(x) * 1e6
    out = np.copysign(np.floor(scaled + 0.5) / 1e6, x)
    # near a half, and where a double has hardly six places, the decimal form decides
    for i in np.flatnonzero(np.abs(scaled - np.floor(scaled) - 0.5) < np.maximum(1e-6, scaled * 1e-15)).tolist():
        out[i] = float(Decimal(repr(float(x[i]))).quantize(Decimal("0.000001"), ROUND_HALF_UP))
    return out + 0.0


def _sizes(spark, n_queries: int, n_vectors: int) -> tuple[int, int]:
    """How wide blocks of queries and shards of vectors are: as few as give each core some, and ``WIDE`` at most."""
    cores = 4 * spark.sparkContext.defaultParallelism
    blocks = max(-(-n_queries // WIDE), min(-(-n_queries // FEW), ceil(sqrt(cores))), 1)
    shards = max(-(-n_vectors // WIDE), min(-(-n_vectors // SHARD), -(-cores // blocks)), 1)
    return max(1, -(-n_queries // blocks)), max(1, -(-n_vectors // shards))


def _kth(near: np.ndarray, k: int) -> np.ndarray:
    """Of each row no more than its ``k``-th largest value: that of the largest of groups of columns, if they are many."""
    groups = near.shape[1] // 64
    if groups > 8 * k:
        near = near[:, : groups * 64].reshape(len(near), 64, groups).max(axis=1)
    return np.partition(near, near.shape[1] - k, axis=1)[:, -k]


def _best(near: np.ndarray, exact, place: np.ndarray, k: int, error: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and score of the ``k`` best of each row of ``near`` (-inf: none), which may be wrong by ``error``, by
    ``exact(rows, columns)`` to six places, then by ``place``."""
    if near.shape[1] > k:
        least = _kth(near, k) - near.dtype.type(2e-6 + 2 * error)
        i, j = np.nonzero((near >= least[:, None]) & (near > -np.inf))
    else:
        i, j = np.nonzero(near > -np.inf)
    score = np.concatenate([np.zeros(0), *(exact(i[at : at + 200_000], j[at : at + 200_000]) for at in range(0, len(i), 200_000))])
    order = np.lexsort((place[j], -_rounded(score), i))
    i, j, score = i[order], j[order], score[order]
    first = np.searchsorted(i, i)
    keep = np.arange(len(i)) - first < k
    return i[keep], j[keep], score[keep]


def _place(ids: pa.ChunkedArray) -> np.ndarray:
    """Where each id stands among them in order."""
    out = np.empty(len(ids), np.int64)
    out[pc.sort_indices(ids).to_numpy()] = np.arange(len(ids))
    return out


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    rounded = found.select("query_id", "id", F.round("score", 6).alias("score"))
    return rounded.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _types(queries: DataFrame, vectors: DataFrame) -> str:
    return f"query_id {queries.schema['query_id'].dataType.simpleString()}, id {vectors.schema['id'].dataType.simpleString()}"


def _finite(v: str) -> Column:
    return (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))


def cosine_topk(queries: DataFrame, vectors: DataFrame, k: int) -> DataFrame:
    """A stated set of queries (query_id, q) against all vectors (id, v): query_id, id, score, rank.

    Blocks of queries meet shards of vectors; a matrix product in single precision tells, with its error, which can be among
    the best of the shard, their scores are then summed in order in double precision, and only the best of each shard are
    shuffled.  Of equal vectors of a shard the ``k`` first are compared.  Zero vectors, null ones and those with null or
    non-finite components are like nothing: they find nothing and are not found, as are vectors of other lengths.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [empty]
        if len(left) and len(right):
            sizes = [pc.list_value_length(t.column(c)).to_numpy() for t, c in ((left, "q"), (right, "v"))]
            for size in np.intersect1d(*sizes).tolist():
                mine, others = left.filter(pa.array(sizes[0] == size)), right.filter(pa.array(sizes[1] == size))
                a, b, place = _rows(mine.column("q")), _rows(others.column("v")), _place(others.column("id"))
                long = [np.sqrt(_sums(x, x)) for x in (a, b)]
                some = [np.flatnonzero(x > 0) for x in long]
                some[1] = some[1][_first_equal(b[some[1]], place[some[1]], k)]
                b, place = b[some[1]], place[some[1]]
                unit = (b / long[1][some[1], None]).astype(np.float32).T
                for at in range(0, len(some[0]), _RUN) if len(b) else ():
                    which = some[0][at : at + _RUN]
                    x, lengths = a[which], long[0][which]
                    exact = lambda i, j: _sums(x[i], b[j]) / (lengths[i] * long[1][some[1][j]])  # noqa: B023, E731
                    # unit vectors: rounded once each, and once for each product and sum
                    i, j, score = _best((x / lengths[:, None]).astype(np.float32) @ unit, exact, place, k, (size + 8) * 2**-23)
                    out.append(pa.table({"query_id": mine.column("query_id").take(which[i]), "id": others.column("id").take(some[1][j]), "score": score}))
        return pa.concat_tables(out)

    some = lambda v: _finite(v) & F.exists(v, lambda x: x != 0)
    q, v = queries.select("query_id", "q").where(some("q")), vectors.select("id", "v").where(some("v"))
    empty, n = _empty(q, v), (q.count(), v.count())
    block, shard = _sizes(q.sparkSession, *n)
    return _ranked(met(q, v, block, *n, run, f"{_types(q, v)}, score double", shard), k)


def _first_equal(rows: np.ndarray, place: np.ndarray, k: int) -> np.ndarray:
    """Where the rows are of which fewer than ``k`` equal ones stand before them by ``place``."""
    if not len(rows):
        return np.zeros(0, np.int64)
    _, same = np.unique(np.ascontiguousarray(rows).view(f"V{rows.shape[1] * 8}").ravel(), return_inverse=True)
    order = np.lexsort((place, same))
    first = np.searchsorted(same[order], same[order])
    return np.sort(order[np.arange(len(order)) - first < k])


def _empty(q: DataFrame, v: DataFrame) -> pa.Table:
    kinds = [to_arrow_type(q.schema["query_id"].dataType), to_arrow_type(v.schema["id"].dataType)]
    return pa.schema([("query_id", kinds[0]), ("id", kinds[1]), ("score", pa.float64())]).empty_table()


def _sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed in order."""
    out = np.zeros(len(a))
    for k in range(a.shape[1]):
        out += a[:, k] * b[:, k]
    return out


def _asked(queries: DataFrame, members: DataFrame, sparse: DataFrame, cluster: str, k: int) -> tuple[DataFrame, DataFrame]:
    """Queries with their best clusters (hits) and sparse entries, and members in clusters with theirs."""
    centroid = dense_centroids(members, cluster).groupBy(cluster).agg(F.array_sort(F.collect_list(F.struct("index", "value"))).alias("c"))
    centroid = centroid.select(F.col(cluster).alias("id"), F.transform("c", lambda x: x["value"]).alias("v"))
    dense_hits = cosine_topk(queries, centroid, k).select("query_id", F.col("id").alias(cluster), F.lit(1).alias("d"), F.lit(0).alias("s"))
    sparse_queries = sparse.join(F.broadcast(queries.select(F.col("query_id").alias("id"))), "id").withColumnRenamed("id", "query_id")
    sums = sparse_centroids(sparse.join(members.select("id", cluster), "id"), cluster).withColumnRenamed(cluster, "id")
    sparse_hits = sparse_dot_topk(sparse_queries, sums, k).select("query_id", F.col("id").alias(cluster), F.lit(0).alias("d"), F.lit(1).alias("s"))
    hits = dense_hits.unionByName(sparse_hits).groupBy("query_id", cluster).agg(F.max("d").alias("in_dense"), F.max("s").alias("in_sparse"))
    hits = hits.where(F.col(cluster).isNotNull()).groupBy("query_id").agg(F.collect_list(F.struct(F.col(cluster).alias("cluster"), "in_dense", "in_sparse")).alias("hits"))
    entries = lambda df, key: df.groupBy(key).agg(F.collect_list(F.struct("index", F.col("value").cast("double").alias("value"))).alias("entries"))
    asked = queries.select("query_id", "q").join(hits, "query_id").join(entries(sparse_queries, "query_id"), "query_id", "left")
    every = members.select("id", "v", F.col(cluster).alias("cluster")).where("cluster is not null").join(entries(sparse, "id"), "id", "left")
    return asked, every


def two_stage(queries: DataFrame, members: DataFrame, sparse: DataFrame, cluster: str, k: int = 5) -> DataFrame:
    """Clusters first, their members then: query_id, id, dense and sparse (scores divided by the query's best, to six
    places), in_dense and in_sparse (1 where the member's cluster is among the ``k`` best by that score).

    ``queries``: query_id, q; ``members``: id, v, the cluster; ``sparse``: id, index, value of all members, queries
    among them by their id.  Zero vectors have a dense score of 0.
    """
    asked, every = _asked(queries, members, sparse, cluster, k)
    n_queries, n_members = queries.count(), members.count()

    def scores(left: pa.Table, right: pa.Table):
        """Of one block and shard: rows and columns of the pairs, flags and both scores."""
        flags = _flags(left.column("hits"), right.column("cluster"))
        i, j = np.nonzero(flags >= 0)
        sparse = _products(_listed(left.column("entries")), _listed(right.column("entries")), flags.shape)[0]
        return i, j, flags[i, j], _cosines(left.column("q"), right.column("v"))[i, j], sparse[i, j]

    def largest(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return most.empty_table()
        i, _, _, *both = scores(left, right)
        some = np.unique(i)
        begin = np.searchsorted(i, some)
        return pa.table([left.column("query_id").take(pa.array(some)), *(np.maximum.reduceat(x, begin) if len(i) else x for x in both)], schema=most)

    def shares(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left) or not len(right):
            return out.empty_table()
        i, j, flag, *both = scores(left, right)
        for k, c in enumerate(("best_dense", "best_sparse")):
            best = left.column(c).to_numpy()[i]
            both[k] = np.where(best == 0, 0.0, both[k] / np.where(best == 0, 1.0, best))
        return pa.table([left.column("query_id").take(pa.array(i)), right.column("id").take(pa.array(j)), *both, flag // 2, flag % 2], schema=out)

    types = _types(queries, members)
    query_kind, id_kind = (to_arrow_type(d.schema[c].dataType) for d, c in ((queries, "query_id"), (members, "id")))
    most = pa.schema([("query_id", query_kind), ("best_dense", pa.float64()), ("best_sparse", pa.float64())])
    out = pa.schema([("query_id", query_kind), ("id", id_kind), ("dense", pa.float64()), ("sparse", pa.float64()), ("in_dense", pa.int32()), ("in_sparse", pa.int32())])
    best = streamed(asked, every, n_queries, n_members, largest, f"{types.split(', ')[0]}, best_dense double, best_sparse double")
    best = best.groupBy("query_id").agg(F.max("best_dense").alias("best_dense"), F.max("best_sparse").alias("best_sparse"))
    found = streamed(asked.join(best, "query_id"), every, n_queries, n_members, shares, f"{types}, dense double, sparse double, in_dense int, in_sparse int")
    return found.select("query_id", "id", F.round("dense", 6).alias("dense"), F.round("sparse", 6).alias("sparse"), "in_dense", "in_sparse")


#: Queries whose hits a task holds and ranks at a time.
RANKED = 16
#: Blocks of queries for each core at most: each has a copy of the members.
_COPIES = 2
#: Rows of a report that are handed on at a time.
_HANDED = 20_000


def two_stage_report(queries: DataFrame, members: DataFrame, sparse: DataFrame, cluster: str, names: DataFrame, k: int = 5) -> DataFrame:
    """``two_stage`` with the total of both scores, and label and text of query and hit: in order of query_id (a number), best
    total first, then by id.

    ``names``: id, label and text; pairs of which an end has none are left out.  Hits are nearly all pairs, so they are never
    shuffled: a task takes a block of queries in a row, to which the members come, holds these, and hands on the hits of
    ``RANKED`` queries after the other in their order; partitions are in the order of queries.  There are no more blocks than
    ``_COPIES`` for each core, so what is shuffled grows with the members, not with their product with the queries."""
    asked, every = _asked(queries, members, sparse, cluster, k)
    blocks = max(1, min(-(-queries.count() // (3 * RANKED)), int(_COPIES * queries.sparkSession.sparkContext.defaultParallelism)))
    # the first query of each block but one: as many numbers as there are blocks
    ends = queries.agg(F.percentile_approx("query_id", [b / blocks for b in range(1, blocks)], 20 * blocks)).first()[0] if blocks > 1 else []
    block = F.size(F.filter(F.lit(ends), lambda e: e < F.col("query_id"))) if ends else F.lit(0)
    name = names.select("id", "label", "text", F.lit(True).alias("named"))
    asked = asked.join(name.withColumnRenamed("id", "query_id"), "query_id")
    every = every.join(name, "id", "left")
    parts = [F.col(f"entries.{c}").alias(c) for c in ("index", "value")]
    left = asked.select(block.alias("block"), F.lit(0).alias("kind"), "query_id", F.lit(None).cast(every.schema["id"].dataType).alias("id"), F.col("q").alias("v"), F.lit(None).cast(every.schema["cluster"].dataType).alias("cluster"), "hits", *parts, "label", "text", "named")
    right = every.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), F.lit(None).cast(asked.schema["query_id"].dataType).alias("query_id"), "id", "v", "cluster", F.lit(None).cast(asked.schema["hits"].dataType).alias("hits"), *parts, "label", "text", F.coalesce("named", F.lit(False)).alias("named"))
    kinds = {c: d.schema[c].dataType for d, c in ((asked, "query_id"), (name, "label"), (name, "text"), (every, "id"))}
    out = {"query_id": kinds["query_id"], "query_label": kinds["label"], "query_text": kinds["text"], "id": kinds["id"], "hit_label": kinds["label"], "hit_text": kinds["text"]}
    arrow = pa.schema([*((c, to_arrow_type(t)) for c, t in out.items()), ("dense", pa.float64()), ("sparse", pa.float64()), ("in_dense", pa.int32()), ("in_sparse", pa.int32()), ("total", pa.float64())])

    def run(batches):
        asking, members = [], []
        for batch in batches:
            # queries come before members
            own = pc.equal(batch.column("kind"), 0)
            asking += [b for b in [batch.filter(own)] if len(b)]
            others = batch.filter(pc.invert(own))
            if len(others) and asking:
                members.append(pa.Table.from_batches([others]).select(["id", "v", "cluster", "index", "value", "label", "text", "named"]))
        if members:
            whole = pa.Table.from_batches(asking)
            order = pc.sort_indices(whole.column("query_id"))
            known = pa.concat_tables([m.select(["id", "label", "text", "named"]) for m in members]).combine_chunks()
            place = _place(known.column("id"))
            for at in range(0, len(whole), RANKED):
                left = whole.take(order[at : at + RANKED])
                yield from ranked(left, [met_with(left, m) for m in members], known, place)

    def met_with(left: pa.Table, right: pa.Table):
        """Flags of all pairs, both scores of those that are hits, and where each query's begin."""
        flags = _flags(left.column("hits"), right.column("cluster"))
        some = flags >= 0
        sparse = _products(_split(left), _split(right), flags.shape)[0]
        return flags.astype(np.int8), _cosines(left.column("v"), right.column("v"))[some], sparse[some], np.append(0, some.sum(axis=1).cumsum())

    def ranked(left: pa.Table, hits: list, known: pa.Table, ids: np.ndarray):
        named = known.column("named").to_numpy()
        for i in range(len(left)):
            flag = np.concatenate([h[0][i] for h in hits])
            both = [np.concatenate([h[c][h[3][i] : h[3][i + 1]] for h in hits]) for c in (1, 2)]
            j = np.flatnonzero(flag >= 0)
            kept, j = named[j], j[named[j]]
            for c in (0, 1) if len(j) else ():
                best = both[c].max()
                both[c] = _rounded(both[c][kept] / best) if best else np.zeros(len(j))
            total = _rounded(both[0] + both[1]) if len(j) else np.zeros(0)
            at = np.lexsort((ids[j], -total))
            for lo in range(0, len(j), _HANDED):
                some = at[lo : lo + _HANDED]
                rows, f = pa.array(j[some]), flag[j[some]].astype(np.int32)
                mine = [left.column(c).take(pa.array(np.full(len(some), i))).combine_chunks() for c in ("query_id", "label", "text")]
                yield pa.RecordBatch.from_arrays([*mine, *(known.column(c).take(rows).combine_chunks() for c in ("id", "label", "text")), pa.array(both[0][some]), pa.array(both[1][some]), pa.array(f // 2), pa.array(f % 2), pa.array(total[some])], schema=arrow)

    types = ", ".join(f"{c} {t.simpleString()}" for c, t in out.items())
    sides = left.unionByName(right).repartitionById(blocks, F.col("block")).sortWithinPartitions("kind")
    return sides.mapInArrow(run, f"{types}, dense double, sparse double, in_dense int, in_sparse int, total double")


def _split(table: pa.Table) -> tuple:
    """Row, index and value of the entries in two lists."""
    index, value = (table.column(c).combine_chunks() for c in ("index", "value"))
    row = np.repeat(np.arange(len(table)), pc.fill_null(pc.list_value_length(index), 0).to_numpy(zero_copy_only=False))
    return row, index.flatten().to_numpy(zero_copy_only=False), value.flatten().to_numpy(zero_copy_only=False)


def _flags(hits: pa.ChunkedArray, clusters: pa.ChunkedArray) -> np.ndarray:
    """For each query and member: -1 where its cluster is no hit, else twice in_dense, plus in_sparse."""
    coded = clusters.combine_chunks().dictionary_encode()
    place = {c: k for k, c in enumerate(coded.dictionary.to_pylist())}
    table = np.full((len(hits), len(place)), -1, np.int32)
    for i, listed in enumerate(hits.to_pylist()):
        for h in listed:
            if h["cluster"] in place:
                table[i, place[h["cluster"]]] = 2 * h["in_dense"] + h["in_sparse"]
    return table[:, coded.indices.to_numpy()]


def _listed(entries: pa.ChunkedArray) -> tuple:
    """Row, index and value of the entries in lists."""
    whole = entries.combine_chunks()
    flat = whole.flatten()
    row = np.repeat(np.arange(len(whole)), pc.fill_null(pc.list_value_length(whole), 0).to_numpy(zero_copy_only=False))
    return row, flat.field("index").to_numpy(zero_copy_only=False), flat.field("value").to_numpy(zero_copy_only=False)


def _plain(column: pa.ChunkedArray) -> np.ndarray | None:
    """A matrix of lists of one length that hold no null, or None."""
    whole = column.combine_chunks()
    size = pc.list_value_length(whole)
    if whole.null_count or not len(whole) or pc.min(size) != pc.max(size) or not size[0].as_py() or whole.flatten().null_count:
        return None
    return _rows(whole)


def _cosines(queries: pa.ChunkedArray, vectors: pa.ChunkedArray) -> np.ndarray:
    """Cosines of all pairs, 0 where a vector is zero or null, has such a component or another length."""
    out = np.zeros((len(queries), len(vectors)))
    plain = [_plain(c) for c in (queries, vectors)]
    if all(x is not None for x in plain):
        if plain[0].shape[1] == plain[1].shape[1]:
            x, y = (np.where(np.isfinite(m).all(axis=1, keepdims=True), m, 0) for m in plain)
            long = [np.sqrt((m * m).sum(axis=1)) for m in (x, y)]
            out = (x @ y.T) / (np.where(long[0] == 0, 1, long[0])[:, None] * np.where(long[1] == 0, 1, long[1]))
        return out
    a, b = ([np.array([], float) if x is None else np.array([np.nan if y is None else y for y in x], float) for x in c.to_pylist()] for c in (queries, vectors))
    for size in {len(x) for x in a} & {len(x) for x in b} - {0}:
        i, j = ([k for k, x in enumerate(c) if len(x) == size and np.isfinite(x).all() and x.any()] for c in (a, b))
        if i and j:
            x, y = np.stack([a[k] for k in i]), np.stack([b[k] for k in j])
            out[np.ix_(i, j)] = (x @ y.T) / (np.sqrt((x * x).sum(axis=1))[:, None] * np.sqrt((y * y).sum(axis=1)))
    return out


def cluster_nodes(members: DataFrame, sparse: DataFrame, cluster: str, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """A node for each cluster - members (ids, ascending), dense (its mean) and sparse (index and value) - and its members'
    texts: cluster, id, text.  ``members``: id, v, the cluster and the text; ``sparse``: id, index, value."""
    ids = members.groupBy(cluster).agg(F.sort_array(F.collect_list("id")).alias("members"))
    dense = dense_centroids(members, cluster).groupBy(cluster).agg(F.array_sort(F.collect_list(F.struct("index", "value"))).alias("dense"))
    sums = sparse_centroids(sparse.join(members.select("id", cluster), "id"), cluster)
    sums = sums.groupBy(cluster).agg(F.array_sort(F.collect_list(F.struct("index", "value"))).alias("sparse"))
    nodes = ids.join(dense, cluster).join(sums, cluster, "left")
    nodes = nodes.select(cluster, "members", F.transform("dense", lambda x: x["value"]).alias("dense"), F.coalesce("sparse", F.array().cast("array<struct<index:int,value:double>>")).alias("sparse"))
    return nodes, members.select(cluster, "id", text)


def scroll(points: DataFrame, payload: dict[str, str], most: int, order: str = "id") -> DataFrame:
    """The first ``most`` points whose payload (a map) has the values."""
    out = points
    for key, value in payload.items():
        out = out.where(F.try_element_at("payload", F.lit(key)) == value)
    return out.orderBy(order).limit(most)


def with_payload(points: DataFrame, changes: dict[str, Column | None]) -> DataFrame:
    """Points with payload entries set, or dropped where None; vectors stay as they are."""
    kept = F.map_filter("payload", lambda k, _: ~k.isin(list(changes)))
    new = [x for k, c in changes.items() if c is not None for x in (F.lit(k), c.cast("string"))]
    return points.withColumn("payload", F.map_concat(kept, F.create_map(*new)) if new else kept)


def to_sparse(vectors: DataFrame, least: float) -> DataFrame:
    """Long form: id, index (from 0), value of the components above ``least``."""
    long = vectors.select("id", F.posexplode("v").alias("index", "value")).withColumn("value", F.col("value").cast("double"))
    return long.where(F.col("value") > least)


#: Indexes of sparse vectors that are multiplied at a time.
_INDEXES = 512


def _products(left: tuple, right: tuple, shape: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of sparse rows (row, index, value of each entry), and whether two share an index."""
    names, at = np.unique(np.concatenate([left[1], right[1]]), return_inverse=True)
    at = at[: len(left[1])], at[len(left[1]) :]
    total, shared = np.zeros(shape), np.zeros(shape, np.float32)
    for lo in range(0, len(names), _INDEXES):
        width, tiles = min(_INDEXES, len(names) - lo), []
        for (row, _, value), where, n in ((left, at[0], shape[0]), (right, at[1], shape[1])):
            some = np.flatnonzero((where >= lo) & (where < lo + width))
            tile, has = np.zeros((n, width)), np.zeros((n, width), np.float32)
            np.add.at(tile, (row[some], where[some] - lo), value[some])
            has[row[some], where[some] - lo] = 1
            tiles.append((tile, has))
        total += tiles[0][0] @ tiles[1][0].T
        shared += tiles[0][1] @ tiles[1][1].T
    return total, shared > 0


def _entries(table: pa.Table, key: str, value: str) -> tuple[pa.Array, tuple]:
    """The ids of long rows, and row, index and value of each entry."""
    coded = table.column(key).combine_chunks().dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    return coded.dictionary, (coded.indices.to_numpy(), table.column("index").to_numpy(), table.column(value).to_numpy())


def sparse_dot_topk(queries: DataFrame, sparse: DataFrame, k: int) -> DataFrame:
    """Dot products over shared indexes, best k of each query.

    Blocks of queries, a stated set, meet shards of vectors, all entries of one in a shard, so that an index which most
    vectors have is no task's work alone; only the best of each shard are shuffled."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [empty]
        if len(left) and len(right):
            (queried, a), (ids, b) = _entries(left, "query_id", "qv"), _entries(right, "id", "value")
            place, order = _place(ids), np.argsort(a[0], kind="stable")
            a = tuple(x[order] for x in a)
            for at in range(0, len(queried), _RUN):
                n = min(_RUN, len(queried) - at)
                lo, hi = np.searchsorted(a[0], [at, at + n])
                total, shared = _products((a[0][lo:hi] - at, a[1][lo:hi], a[2][lo:hi]), b, (n, len(ids)))
                i, j, score = _best(np.where(shared, total, -np.inf), lambda i, j: total[i, j], place, k)  # noqa: B023
                out.append(pa.table({"query_id": queried.take(pa.array(i + at)), "id": ids.take(pa.array(j)), "score": score}))
        return pa.concat_tables(out)

    known = "id is not null and index is not null and value is not null"
    q = queries.withColumnRenamed("query_id", "id").where(known).select(F.col("id").alias("query_id"), "index", F.col("value").cast("double").alias("qv"))
    v = sparse.where(known).select("id", "index", F.col("value").cast("double").alias("value"))
    empty = _empty(q, v)
    # ids are counted nearly enough for the number of blocks and shards
    n = [d.agg(F.approx_count_distinct(c)).first()[0] for d, c in ((q, "query_id"), (v, "id"))]
    return _ranked(met(q, v, FEW, *n, run, f"{_types(q, v)}, score double"), k)


def dense_centroids(vectors: DataFrame, cluster: str) -> DataFrame:
    """Mean of each component within a cluster, in long form: cluster, index, value."""
    long = vectors.select(cluster, F.posexplode("v").alias("index", "value"))
    return long.groupBy(cluster, "index").agg(F.round(F.avg(F.col("value").cast("double")), 6).alias("value"))


def sparse_centroids(sparse: DataFrame, cluster: str) -> DataFrame:
    """Sums per index; the largest ``floor(average number of dims)`` stay, scaled to the members' average length.

    The length of a vector of n dims is the n-th root of its sum of squares.
    """
    member = sparse.groupBy(cluster, "id").agg(F.count("*").alias("dims"), F.sum(F.col("value") * F.col("value")).alias("sq"))
    member = member.withColumn("len", F.pow("sq", F.lit(1.0) / F.col("dims")))
    average = member.groupBy(cluster).agg(F.floor(F.avg("dims")).alias("keep"), F.avg("len").alias("avg_len"))
    sums = sparse.groupBy(cluster, "index").agg(F.sum("value").alias("total"))
    w = Window.partitionBy(cluster).orderBy(F.round("total", 9).desc(), "index")
    top = sums.withColumn("rn", F.row_number().over(w)).join(average, cluster).where("rn <= keep")
    own = top.groupBy(cluster).agg(F.pow(F.sum(F.col("total") * F.col("total")), F.lit(1.0) / F.count("*")).alias("own_len"))
    return top.join(own, cluster).select(cluster, "index", F.round(F.col("total") * F.col("avg_len") / F.col("own_len"), 6).alias("value"))
