"""Hard negatives: trees over anchors and over candidates, searched in pairs of nodes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from medloom.llm.shared import drop_stored, small_or_hashed, store

#: Distinct candidates of a shard, and anchors of a group, about: what is sent is their blocks in pairs.
SHARD, GROUP = 16_384, 16_384
#: Rows that pivots and first thresholds are taken from, at most; they decide speed, never results.
SAMPLE = 4_096
#: Rows of a leaf of the tree over candidates, and of that over anchors.
LEAF, ANCHOR_LEAF = 256, 64
NONE = np.iinfo(np.int64).max
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of integer rows as longs: exact wherever a long holds them, at its ends beyond."""
    size = lambda x: float(np.sqrt((x.astype(np.float64) ** 2).sum(axis=1)).max(initial=0))
    most = size(a) * size(b)
    if 2**52 <= most < 9.2e18:
        return a.astype(np.int64) @ b.astype(np.int64).T
    found = a.astype(np.float64) @ b.astype(np.float64).T
    return found.astype(np.int64) if most < 2**52 else np.where(np.abs(found) < 9.2e18, np.clip(found, -9.2e18, 9.2e18).astype(np.int64), np.where(found > 0, _HIGH, _LOW))


class Tree:
    """Rows in the order of the leaves; of each node the rows, its left child (the right one is next; -1: a leaf), the
    centre, radius and greatest norm, and the range of labels.  Labels are parted first, then the widest dimension."""

    def __init__(self, x: np.ndarray, label: np.ndarray, leaf: int):
        self.order = np.arange(len(x))
        nodes = [[0, len(x), -1]]
        at = 0
        while at < len(nodes):
            start, end, _ = nodes[at]
            if end - start > leaf:
                own = self.order[start:end]
                labels = label[own]
                if labels.min() < labels.max():
                    by = np.argsort(labels, kind="stable")
                    edges = np.flatnonzero(np.diff(labels[by])) + 1
                    cut = int(edges[np.argmin(np.abs(edges - len(own) // 2))])
                else:
                    rows = x[own].astype(np.float64)
                    by = np.argsort(rows[:, int(np.argmax(rows.var(axis=0)))], kind="stable") if rows.shape[1] else np.arange(len(own))
                    cut = len(own) // 2
                self.order[start:end] = own[by]
                nodes[at][2] = len(nodes)
                nodes += [[start, start + cut, -1], [start + cut, end, -1]]
            at += 1
        self.start, self.end, self.left = np.array(nodes, np.int64).T
        self.x, self.label = x[self.order], label[self.order]
        real = self.x.astype(np.float64)
        self.centre = np.stack([real[s:e].mean(axis=0) if e > s else np.zeros(x.shape[1]) for s, e in zip(self.start, self.end, strict=True)])
        far = lambda s, e, c: np.sqrt(((real[s:e] - c) ** 2).sum(axis=1)).max(initial=0)
        self.radius = np.array([far(s, e, c) for s, e, c in zip(self.start, self.end, self.centre, strict=True)])
        self.norm = np.array([far(s, e, 0) for s, e in zip(self.start, self.end, strict=True)])
        self.low = np.array([self.label[s:e].min(initial=NONE) for s, e in zip(self.start, self.end, strict=True)])
        self.high = np.array([self.label[s:e].max(initial=_LOW) for s, e in zip(self.start, self.end, strict=True)])


def interval(centre_a, radius_a, norm_a, centre_b, radius_b, norm_b) -> tuple[np.ndarray, np.ndarray]:
    """Between which values the inner products of each pair of nodes lie, with room for rounding."""
    middle = centre_a @ centre_b.T
    ca, cb = np.sqrt((centre_a**2).sum(axis=1)), np.sqrt((centre_b**2).sum(axis=1))
    wide = ca[:, None] * radius_b + radius_a[:, None] * cb + radius_a[:, None] * radius_b
    most = norm_a[:, None] * norm_b
    room = 0.5 + 1e-9 * most
    return np.maximum(middle - wide, -most) - room, np.minimum(middle + wide, most) + room


def search(anchors: Tree, ids: np.ndarray, least: np.ndarray, most: np.ndarray, same: bool, rows: Tree, first: np.ndarray, second: np.ndarray, k: int):
    """The best ``k`` of ``rows`` for every anchor and window: score between ``least`` and ``most`` (anchors by windows,
    in the order of the tree), label the ``same`` or not, not the anchor itself; ties to the smaller ``first`` id.

    Pairs of nodes go on while their interval meets a window of the anchors below and their labels allow it; leaves are
    scored exactly, those of the greatest bound first.  ``least`` rises to the k-th best score found.  Returns anchor,
    window, row and score of what is kept."""
    low, high = interval(anchors.centre, anchors.radius, anchors.norm, rows.centre, rows.radius, rows.norm)
    if same:
        apart = (anchors.low[:, None] > rows.high) | (anchors.high[:, None] < rows.low)
    else:
        apart = (anchors.low == anchors.high)[:, None] & (rows.low == rows.high) & (anchors.low[:, None] == rows.low)
    need = np.array([least[s:e].min(initial=_HIGH) for s, e in zip(anchors.start, anchors.end, strict=True)], np.float64)
    allow = np.array([most[s:e].max(initial=_LOW) for s, e in zip(anchors.start, anchors.end, strict=True)], np.float64)
    meets = (high >= need[:, None]) & (low <= allow[:, None]) & ~apart
    a = b = np.zeros(1, np.int64)
    leaves = []
    while len(a):
        on = meets[a, b]
        a, b = a[on], b[on]
        la, lb = anchors.left[a] < 0, rows.left[b] < 0
        leaves.append((a[la & lb], b[la & lb]))
        split = ~la & (lb | (anchors.end[a] - anchors.start[a] >= rows.end[b] - rows.start[b]))
        other = ~split & ~lb
        left = anchors.left[a[split]]
        down = rows.left[b[other]]
        a, b = np.concatenate([left, left + 1, a[other], a[other]]), np.concatenate([b[split], b[split], down, down + 1])
    a, b = (np.concatenate(x) for x in zip(*leaves, strict=True))
    order = np.argsort(-high[a, b], kind="stable")
    kept: dict[int, tuple[np.ndarray, ...]] = {}
    alone = second == NONE
    for i, j in zip(a[order].tolist(), b[order].tolist(), strict=True):
        s, e, t, u = anchors.start[i], anchors.end[i], rows.start[j], rows.end[j]
        if high[i, j] < least[s:e].min():
            continue
        score = products(anchors.x[s:e], rows.x[t:u])
        fits = (anchors.label[s:e, None] == rows.label[t:u]) == same
        if same:
            fits &= ~((first[t:u] == ids[s:e, None]) & alone[t:u])
        found = []
        for w in range(least.shape[1]):
            r, c = np.nonzero(fits & (score >= least[s:e, w, None]) & (score <= most[s:e, w, None]))
            found.append((r, np.full(len(r), w), c + t, score[r, c]))
        r, w, c, score = (np.concatenate(x) for x in zip(*found, strict=True))
        if not len(r):
            continue
        if i in kept:
            r, w, c, score = (np.concatenate(x) for x in zip(kept[i], (r, w, c, score), strict=True))
        by_id = np.where(same & (first[c] == ids[s + r]), second[c], first[c])
        slot = r * least.shape[1] + w
        best = np.lexsort((by_id, ~score, slot))
        slot = slot[best]
        place = np.arange(len(slot)) - np.searchsorted(slot, slot)
        best = best[place < k]
        kept[i] = r[best], w[best], c[best], score[best]
        full = place == k - 1
        at = slot[full]
        least[s + at // least.shape[1], at % least.shape[1]] = kept_scores(slot, place, k, kept[i][3])
    if not kept:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    parts = [(anchors.start[i] + x[0], *x[1:]) for i, x in kept.items()]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def kept_scores(slot: np.ndarray, place: np.ndarray, k: int, score: np.ndarray) -> np.ndarray:
    """The k-th score of each slot that has k."""
    return score[(place < k).cumsum()[place == k - 1] - 1]


def _integers(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _narrow(x: np.ndarray) -> tuple[bytes, int]:
    """Bytes of the integers in as few bytes each as hold them all."""
    for width in (2, 4):
        if -(1 << (8 * width - 1)) <= x.min(initial=0) and x.max(initial=0) < 1 << (8 * width - 1):
            return x.astype(f"<i{width}").tobytes(), width
    return x.tobytes(), 8


def _wide(data: bytes, width: int, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{width}").astype(np.int64 if width == 8 else np.float64).reshape(n, dim)


_SUMMARY = "dim int, block bigint, centre binary, radius double, norm double, low bigint, high bigint"


def _nearest_pivot(rows: DataFrame, pivots: np.ndarray, vector: str, name: str) -> DataFrame:
    """Rows with the number of the pivot of least distance; rows of another length have pivot 0."""
    if len(pivots) < 2:
        return rows.withColumn(name, F.lit(0))
    sent = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        p = sent.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(vector))
            own = np.asarray(column.value_lengths()) == p.shape[1]
            cell = np.zeros(len(batch), np.int32)
            if own.any():
                x = _integers(column.filter(pa.array(own)), p.shape[1]).astype(np.float64)
                cell[own] = np.argmin((p**2).sum(axis=1) - 2 * x @ p.T, axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=[*batch.schema.names, name])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(run, f"{own}, `{name}` int")


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """Rows with ``block``: those of one length and cell, dealt out by hash where they are more than ``most``."""
    sizes = store(rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / most).alias("parts")), "cells")
    small = small_or_hashed(sizes)
    return rows.join(small, ["dim", "cell"]).withColumn("block", F.shiftleft(F.col("cell").cast("bigint"), 32) + F.pmod(F.xxhash64("vec", "label"), F.col("parts"))).drop("cell", "parts")


def _sample_tree(sample: pa.Table, dim: int):
    """Tree, first and second ids of the sampled rows of one length."""
    mine = sample.filter(pa.array(np.asarray(sample.column("dim")) == dim)) if len(sample) else sample
    x = _integers(mine.column("vec").combine_chunks(), dim)
    tree = Tree(x, mine.column("label").to_numpy().astype(np.int64), LEAF)
    ids = [i[:2] for i in mine.column("ids").to_pylist()]
    first = np.array([i[0] for i in ids], np.int64)
    second = np.array([i[1] if len(i) > 1 else NONE for i in ids], np.int64)
    return tree, first[tree.order], second[tree.order]


def _best(anchors: DataFrame, shards: DataFrame, sample: pa.Table, windows: int, same: bool, k: int) -> DataFrame:
    """``anchors``: dim, block, id, key, label, vec, low and high (arrays, one value a window).  Returns id, key, bound
    (the window's upper end), score and row (an id), the best ``k`` of every shard at least."""
    spark = anchors.sparkSession
    sent = spark.sparkContext.broadcast(sample)

    def pack(key, table):
        dim, n = key[0].as_py(), len(table)
        table = table.sort_by([("id", "ascending"), ("key", "ascending")])
        x, label = _integers(table.column("vec").combine_chunks(), dim), table.column("label").to_numpy().astype(np.int64)
        tree = Tree(x, label, ANCHOR_LEAF)
        ids = table.column("id").to_numpy()[tree.order]
        least, most = np.full((n, windows), _HIGH), np.full((n, windows), _LOW)
        for bound, column in ((least, "low"), (most, "high")):
            lists = table.column(column).combine_chunks()
            sizes = np.asarray(lists.value_lengths())
            bound[np.arange(windows) < sizes[:, None]] = lists.flatten().to_numpy()
        least, most = least[tree.order], most[tree.order]
        rows, first, second = _sample_tree(sent.value, dim)
        if len(rows.x):
            search(tree, ids, least, most, same, rows, first, second, k)
        data, width = _narrow(tree.x)
        lasting = [tree.centre[0].tobytes()], [float(tree.radius[0])], [float(tree.norm[0])], [int(tree.low[0])], [int(tree.high[0])]
        return pa.table(
            [pa.array([dim], pa.int32()), pa.array([key[1].as_py()], pa.int64()), *map(pa.array, lasting), pa.array([float(least.min())]), pa.array([float(most.max())]),
             pa.array([data]), pa.array([width], pa.int32()), pa.array([ids.tobytes()]), pa.array([table.column("key").to_numpy()[tree.order].tobytes()]), pa.array([tree.label.tobytes()]), pa.array([least.tobytes()]), pa.array([most.tobytes()])],
            names=["dim", "block", "centre", "radius", "norm", "low", "high", "need", "allow", "vecs", "width", "ids", "keys", "labels", "least", "most"],
        )

    groups = store(anchors.groupBy("dim", "block").applyInArrow(pack, f"{_SUMMARY}, need double, allow double, vecs binary, width int, ids binary, keys binary, labels binary, least binary, most binary"), "anchors")
    mine = groups.select("dim", F.col("block").alias("group"), *[F.col(c).alias(f"a_{c}") for c in ("centre", "radius", "norm", "low", "high", "need", "allow")])
    pairs = mine.join(shards.select("dim", "block", "centre", "radius", "norm", "low", "high"), "dim")

    def meeting(batches):
        for batch in batches:
            keep = []
            for r in batch.to_pylist():
                ball = lambda c, x, y: (np.frombuffer(c)[None], np.array([x]), np.array([y]))
                low, high = interval(*ball(r["a_centre"], r["a_radius"], r["a_norm"]), *ball(r["centre"], r["radius"], r["norm"]))
                labels = r["a_low"] <= r["high"] and r["low"] <= r["a_high"] if same else not r["a_low"] == r["a_high"] == r["low"] == r["high"]
                keep.append(bool(high[0, 0] >= r["a_need"] and low[0, 0] <= r["a_allow"] and labels))
            yield batch.select(["dim", "group", "block"]).filter(pa.array(keep, pa.bool_()))

    cells = pairs.mapInArrow(meeting, "dim int, `group` bigint, block bigint")
    held = groups.select("dim", F.col("block").alias("group"), *[F.col(c).alias(f"a_{c}") for c in ("vecs", "width", "ids", "keys", "labels", "least", "most")])
    both = cells.join(held.hint("shuffle_hash"), ["dim", "group"]).join(shards.select("dim", "block", "vecs", "width", "ids", "many", "labels").hint("shuffle_hash"), ["dim", "block"])

    def meet(batches):
        for batch in batches:
            for at in range(len(batch)):
                r = batch.slice(at, 1).to_pylist()[0]
                dim, long = r["dim"], lambda x: np.frombuffer(x, np.int64)
                ids, label = long(r["a_ids"]), long(r["a_labels"])
                anchors = Tree(_wide(r["a_vecs"], r["a_width"], dim, len(ids)), label, ANCHOR_LEAF)
                order = anchors.order
                least, most = (long(r[x]).reshape(-1, windows)[order] for x in ("a_least", "a_most"))
                many = np.frombuffer(r["many"], np.int32)
                rows = Tree(_wide(r["vecs"], r["width"], dim, len(many)), long(r["labels"]), LEAF)
                all_ids, begin = long(r["ids"]), (np.cumsum(many) - many)[rows.order]
                many = many[rows.order]
                first = all_ids[begin]
                second = np.where(many > 1, all_ids[np.minimum(begin + 1, len(all_ids) - 1)], NONE)
                ids, keys = ids[order], long(r["a_keys"])[order]
                a, w, c, score = search(anchors, ids, least, most, same, rows, first, second, k)
                # each class of equal rows stands for its ids
                sizes = many[c]
                step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                a, w, c, score = (np.repeat(x, sizes) for x in (a, w, c, score))
                row = all_ids[begin[c] + step]
                real = row != ids[a] if same else np.ones(len(a), bool)
                a, w, row, score = a[real], w[real], row[real], score[real]
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(keys[a]), pa.array(most[a, w]), pa.array(score), pa.array(row)], names=["id", "key", "bound", "score", "row"])

    out = store(both.mapInArrow(meet, "id bigint, key bigint, bound bigint, score bigint, row bigint"), "best")
    drop_stored(groups)
    return out


def _pack_shard(key, table):
    dim = key[0].as_py()
    x, label = _integers(table.column("vec").combine_chunks(), dim), table.column("label").to_numpy().astype(np.int64)
    ids = table.column("ids").combine_chunks()
    real = x.astype(np.float64)
    centre = real.mean(axis=0)
    data, width = _narrow(x)
    far = lambda c: float(np.sqrt(((real - c) ** 2).sum(axis=1)).max())
    return pa.table(
        [pa.array([dim], pa.int32()), pa.array([key[1].as_py()], pa.int64()), pa.array([centre.tobytes()]), pa.array([far(centre)]), pa.array([far(0)]), pa.array([int(label.min())]), pa.array([int(label.max())]),
         pa.array([data]), pa.array([width], pa.int32()), pa.array([ids.flatten().to_numpy().tobytes()]), pa.array([np.asarray(ids.value_lengths()).astype(np.int32).tobytes()]), pa.array([label.tobytes()])],
        names=["dim", "block", "centre", "radius", "norm", "low", "high", "vecs", "width", "ids", "many", "labels"],
    )


def mine(rows: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, least: int = 80, id_col: str = "vec_id", vector: str = "vec", label: str = "label") -> DataFrame:
    """Hard negatives of each anchor (a row whose id is divisible by ``every``) and each of its positives.

    ``vector`` holds integers, ``label`` is an integer; the score of two rows is the inner product.  Positives are the
    anchor's first ``positives`` other rows of its label by score, ties to the smaller id.  Negatives of a positive of
    score p are the first ``negatives`` rows of other labels with ``least`` percent of p <= score <= p.  Returns
    anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score; fewer rows where there are fewer.

    A null id, label, vector or component takes no part; vectors of different lengths never meet; rows that repeat are
    one row, and rows of the anchor's own id are not its positives.  An id with several vectors is an anchor for each.
    Scores are exact in a long and stay at its ends beyond.

    Candidates of equal label and vector are one point with its smallest ids, as many as a result can hold.  They are
    dealt to shards by nearest pivot, anchors to groups likewise; pairs of a group and a shard whose bounding balls
    cannot meet a window are never sent.  In a pair the trees' nodes are pruned by intervals of inner products.  A first
    threshold for each anchor comes from a bounded sample.
    """
    spark = rows.sparkSession
    whole = F.col(vector).cast("array<bigint>")
    part = store(
        rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label).cast("bigint").alias("label"), whole.alias("vec"))
        .where("id is not null and label is not null and vec is not null and not exists(vec, x -> x is null)").distinct().withColumn("dim", F.size("vec")),
        "vectors",
    )
    most = max(positives, negatives) + 1
    ranked = part.withColumn("r", F.dense_rank().over(Window.partitionBy("label", "vec").orderBy("id"))).where(F.col("r") <= most)
    points = store(ranked.groupBy("label", "vec", "dim").agg(F.sort_array(F.collect_set("id")).alias("ids")), "points")
    anchors = part.where(F.pmod(F.col("id"), F.lit(every)) == 0).withColumn("key", F.xxhash64("label", "vec"))
    n_points, n_anchors = points.count(), anchors.count()
    empty = spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    if not n_anchors:
        drop_stored(part, points)
        return empty
    sample = points.orderBy(F.xxhash64("vec", "label"), "label", "vec").limit(SAMPLE).toArrow()
    dims = np.asarray(sample.column("dim"))
    usual = int(np.bincount(dims).argmax())
    pivots = _integers(sample.column("vec").combine_chunks().filter(pa.array(dims == usual)), usual).astype(np.float64)
    cut = lambda n, size: pivots[: max(1, min(512, n // size))]
    dealt = _blocks(_nearest_pivot(points, cut(n_points, SHARD), "vec", "cell"), SHARD)
    shards = store(dealt.groupBy("dim", "block").applyInArrow(_pack_shard, f"{_SUMMARY}, vecs binary, width int, ids binary, many binary, labels binary"), "shards")
    grouped = store(_blocks(_nearest_pivot(anchors, cut(n_anchors, GROUP), "vec", "cell"), GROUP), "grouped")
    open_window = grouped.withColumn("low", F.array(F.lit(_LOW))).withColumn("high", F.array(F.lit(_HIGH)))
    found = _best(open_window, shards, sample, 1, True, positives)
    by_score = Window.partitionBy("id", "key").orderBy(F.desc("score"), "row")
    good = store(found.withColumn("r", F.row_number().over(by_score)).where(F.col("r") <= positives).select("id", "key", "score", "row"), "positives")
    floor = F.ceil(F.col("score").cast("decimal(20,0)") * least / 100).cast("bigint")
    windows = good.select("id", "key", "score").distinct().withColumn("low", floor).where("low <= score")
    listed = windows.groupBy("id", "key").agg(F.sort_array(F.collect_list(F.struct(F.col("score"), F.col("low")))).alias("w")).select("id", "key", F.col("w.low").alias("low"), F.col("w.score").alias("high"))
    hard = _best(grouped.join(listed, ["id", "key"]), shards, sample, positives, False, negatives)
    in_window = Window.partitionBy("id", "key", "bound").orderBy(F.desc("score"), "row")
    bad = hard.withColumn("rank", F.row_number().over(in_window)).where(F.col("rank") <= negatives).select("id", "key", F.col("bound").alias("score"), F.col("rank").cast("int").alias("rank"), F.col("row").alias("negative_id"), F.col("score").alias("negative_score"))
    out = store(
        good.withColumnRenamed("row", "positive_id").join(bad, ["id", "key", "score"])
        .select(F.col("id").alias("anchor_id"), "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"),
        "hard-negatives",
    )
    drop_stored(part, points, shards, grouped, found, good, hard)
    return out
