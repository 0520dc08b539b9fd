"""Embedding near-duplicates: PCA-ordered tiles, leading dimensions first, the rest bounded by suffix norms."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm.components import components
from medloom.llm.shared import drop_stored, store
from medloom.llm.vectors import matrix, usable

#: Vectors of a tile at most, about: what is sent is the square of all vectors over this.
TILE = 16_384
#: Vectors that the rotation and the cells are fitted on at most, and their bytes; they decide speed, never results.
FIT_ROWS, FIT_BYTES = 16_384, 32 << 20
#: Cells of the leading components at most.
CELLS = 512


class Frame:
    """A rotation to principal components, and cells: boxes of a k-d tree over the leading ones."""

    def __init__(self, sample: np.ndarray, cells: int):
        dim = sample.shape[1]
        values, vectors = np.linalg.eigh(sample.T @ sample / max(1, len(sample)))
        self.rotation = np.ascontiguousarray(vectors[:, np.argsort(-values)])
        energy = np.cumsum(np.sort(values)[::-1]) / max(values.sum(), 1e-300)
        # enough leading dimensions for the bound to reject nearly every pair of a large threshold
        self.lead = int(min(dim, max(8, -(-int(np.searchsorted(energy, 0.45) + 1) // 8) * 8)))
        rotated = sample @ self.rotation
        self.cuts: list[tuple[int, int, float]] = []  # of inner nodes: node, component, value
        self.boxes: list[np.ndarray] = []
        depth = max(0, min(int(math.log2(cells)) if cells > 1 else 0, int(math.log2(CELLS))))
        free = np.stack([np.full(dim, -np.inf), np.full(dim, np.inf)])
        self.tree = self._split(rotated, free, depth)

    def _split(self, rows: np.ndarray, box: np.ndarray, depth: int):
        if depth == 0 or len(rows) < 16:
            self.boxes.append(box)
            return len(self.boxes) - 1
        axis = int(np.argmax(rows.var(axis=0)))
        at = float(np.median(rows[:, axis]))
        low, high = box.copy(), box.copy()
        low[1, axis], high[0, axis] = at, at
        below = rows[:, axis] < at
        if below.all() or not below.any():
            self.boxes.append(box)
            return len(self.boxes) - 1
        return (axis, at, self._split(rows[below], low, depth - 1), self._split(rows[~below], high, depth - 1))

    def cell(self, rotated: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rotated), np.int32)

        def go(node, which):
            if isinstance(node, int):
                out[which] = node
                return
            axis, at, low, high = node
            below = rotated[which, axis] < at
            go(low, which[below])
            go(high, which[~below])

        go(self.tree, np.arange(len(rotated)))
        return out

    def near(self, threshold: float) -> list[list[int]]:
        """For each cell those, itself included, that hold unit vectors of the threshold's cosine or more."""
        most = 2 - 2 * threshold + 1e-9
        low, high = np.stack([b[0] for b in self.boxes]), np.stack([b[1] for b in self.boxes])
        out = []
        for lo, hi in zip(low, high, strict=True):
            gap = np.maximum(0, np.maximum(low - hi, lo - high))
            out.append(np.flatnonzero((np.where(np.isfinite(gap), gap, 0) ** 2).sum(axis=1) <= most).tolist())
        return out


def tile_links(a: np.ndarray, b: np.ndarray | None, lead: int, threshold: float, wa: np.ndarray, wb: np.ndarray, exact) -> tuple[np.ndarray, ...]:
    """Links between the unit rows of a and of b (of a alone, where b is None).

    Products of the ``lead`` first dimensions come from one matrix product a block; a pair goes on only while what it
    has, and the product of the norms of what is left of both, can reach the threshold, 16 dimensions at a time.
    ``exact(i, j)`` decides the pairs that get to the end.  Returns for the rows of a and b the sum of their partners'
    weights and a label, the least position in a link-connected group (a's rows first; -1 without a link).
    """
    own = b is None
    b = a if own else b
    dim = a.shape[1]
    low = threshold - 1e-9
    na = len(a)
    n = na if own else na + len(b)
    degree, label = np.zeros(n, np.int64), np.arange(n)
    linked = np.zeros(n, bool)
    steps = [*range(lead, dim, 16), dim]
    rest_a = [np.sqrt(np.maximum(0, (a[:, k:] ** 2).sum(axis=1))) for k in steps]
    rest_b = rest_a if own else [np.sqrt(np.maximum(0, (b[:, k:] ** 2).sum(axis=1))) for k in steps]
    lead_b = np.ascontiguousarray(b[:, :lead].T)
    for at in range(0, na, 256):
        rows = slice(at, min(na, at + 256))
        from_b = at if own else 0  # below the diagonal of a tile with itself nothing is new
        part = a[rows, :lead] @ lead_b[:, from_b:]
        i, j = np.nonzero(part >= low - rest_a[0][rows, None] * rest_b[0][None, from_b:])
        got = part[i, j]
        i, j = i + at, j + from_b
        if own:
            later = j > i
            i, j, got = i[later], j[later], got[later]
        for s, (k, up) in enumerate(zip(steps, steps[1:], strict=False), 1):
            if not len(i):
                break
            kept = []
            for x in range(0, len(i), 200_000):
                y = slice(x, x + 200_000)
                got[y] += np.einsum("ij,ij->i", a[i[y], k:up], b[j[y], k:up])
                kept.append(got[y] + rest_a[s][i[y]] * rest_b[s][j[y]] >= low)
            kept = np.concatenate(kept)
            i, j, got = i[kept], j[kept], got[kept]
        if not len(i):
            continue
        sure = exact(i, j)
        i, j = i[sure], j[sure]
        np.add.at(degree, i, wb[j])
        jj = j if own else j + na
        np.add.at(degree, jj, wa[i])
        linked[i] = linked[jj] = True
        while len(i):  # least label over the links of this block, until none changes
            least = np.minimum(label[i], label[jj])
            if (label[i] == least).all() and (label[jj] == least).all():
                break
            for end in (i, jj):
                np.minimum.at(label, label[end], least)
                np.minimum.at(label, end, least)
            label = label[label]
    while True:
        up = label[label]
        if (up == label).all():
            break
        label = up
    return degree, np.where(linked, label, -1)


def embedding_groups(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """One row per vector: ``id_col``, n_links (other vectors of cosine >= ``threshold``), component_id (least id
    reachable over links) and kept (the id is the component's).

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, nor do vectors of
    different lengths.  Equal vectors are one node with a count.  Nodes fall into cells of the leading principal
    components; cells whose boxes are further apart than the threshold allows never meet, and tiles of the others are
    sent to each other packed, two tiles a task.  A pair of tiles returns a row for each linked node, never its pairs.
    Null ids stay; repeated ids of different vectors are different vectors.
    """
    spark = rows.sparkSession
    kind = rows.schema[id_col].dataType.simpleString()
    base = store(rows.select(F.col(id_col).alias("id"), F.when(usable(vector), F.col(vector)).alias("vec")).withColumn("node", F.when(F.col("vec").isNotNull(), F.xxhash64("vec"))), "vectors")
    nodes = store(base.where("vec is not null").groupBy("vec").agg(F.first("node").alias("node"), F.count("*").alias("n"), F.min("id").alias("least")).withColumn("dim", F.size("vec")), "nodes")
    sizes = {r["dim"]: r["count"] for r in nodes.groupBy("dim").count().collect()}
    found = None
    for dim, count in sorted(sizes.items()):
        one = _dimension(nodes.where(F.col("dim") == dim), dim, count, threshold)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return base.select(F.col("id").alias(id_col), F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    found = store(found, "tiles")
    roots = components(found.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))
    degree = found.groupBy("node").agg(F.sum("n_links").alias("m"))
    joined = nodes.select("node", "n", "least").join(degree, "node", "left").join(roots, "node", "left")
    joined = joined.select("node", (F.coalesce("m", F.lit(0)) + F.col("n") - 1).alias("n_links"), "least", F.coalesce("root", "node").alias("root"))
    least = joined.groupBy("root").agg(F.min("least").alias("component_id"))
    named = store(joined.join(least, "root").select("node", "n_links", "component_id"), "named")
    drop_stored(nodes, found, roots)
    out = base.select("id", "node").join(named, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")).cast(kind)
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))


def _dimension(nodes: DataFrame, dim: int, count: int, threshold: float) -> DataFrame:
    spark = nodes.sparkSession
    sample = nodes.select("vec").orderBy(F.xxhash64("node", F.lit(1)), "node").limit(min(FIT_ROWS, FIT_BYTES // (8 * dim) + 1)).toArrow().column("vec").combine_chunks()
    x = matrix(sample)
    x /= np.linalg.norm(x / np.abs(x).max(axis=1, keepdims=True), axis=1, keepdims=True) * np.abs(x).max(axis=1, keepdims=True)
    frame = Frame(x, min(CELLS, max(1, count // TILE)))
    near = frame.near(threshold)
    sent = spark.sparkContext.broadcast(frame)

    def unit(v):
        big = np.abs(v).max(axis=1, keepdims=True)
        v = v / big
        return v / np.linalg.norm(v, axis=1, keepdims=True)

    def place(batches):
        frame = sent.value
        for batch in batches:
            if len(batch):
                cells = frame.cell(unit(matrix(batch.column("vec"))) @ frame.rotation)
                yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n"), batch.column("vec"), pa.array(cells)], names=["node", "n", "vec", "cell"])

    element = nodes.schema["vec"].dataType.simpleString()
    placed = store(nodes.select("node", "n", "vec").mapInArrow(place, f"node bigint, n bigint, vec {element}, cell int"), "placed")
    per_cell = {r["cell"]: r["count"] for r in placed.groupBy("cell").count().collect()}
    chunks = {c: -(-k // TILE) for c, k in per_cell.items()}
    # the list is as long as there are cells, a fixed number
    plan = spark.createDataFrame([(c, chunks[c], [(o, chunks[o]) for o in near[c] if o in chunks]) for c in chunks], "cell int, chunks int, near array<struct<cell:int,chunks:int>>")
    tiled = placed.join(F.broadcast(plan), "cell").withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(2)), F.col("chunks")).cast("int"))

    def pack(key, table):
        v = matrix(table.column("vec").combine_chunks())
        return pa.table({"cell": pa.array([key[0].as_py()], pa.int32()), "chunk": pa.array([key[1].as_py()], pa.int32()), "nodes": [table.column("node").to_numpy().tobytes()], "ns": [table.column("n").to_numpy().tobytes()], "vecs": [(v.astype(np.float32) if (v.astype(np.float32) == v).all() else v).tobytes()]})

    packed = tiled.select("cell", "chunk", "node", "n", "vec").groupBy("cell", "chunk").applyInArrow(pack, "cell int, chunk int, nodes binary, ns binary, vecs binary")
    packed = packed.join(F.broadcast(plan), "cell")
    name = lambda cell, chunk: F.shiftleft(cell.cast("bigint"), 40).bitwiseOR(chunk.cast("bigint"))
    partners = F.flatten(F.transform("near", lambda o: F.transform(F.sequence(F.lit(0), o["chunks"] - 1), lambda k: name(o["cell"], k))))
    meet = packed.select(name(F.col("cell"), F.col("chunk")).alias("me"), "nodes", "ns", "vecs", F.explode(partners).alias("other"))
    meet = meet.select(F.least("me", "other").alias("a"), F.greatest("me", "other").alias("b"), "me", "nodes", "ns", "vecs")

    def compare(key, table):
        frame = sent.value
        table = table.sort_by("me")
        nodes = [np.frombuffer(x.as_py(), np.int64) for x in table.column("nodes")]
        ns = [np.frombuffer(x.as_py(), np.int64) for x in table.column("ns")]
        raw = [x.as_py() for x in table.column("vecs")]
        vecs = [np.frombuffer(x, np.float32 if len(x) == 4 * dim * len(k) else np.float64).reshape(-1, dim).astype(np.float64) for x, k in zip(raw, nodes, strict=True)]
        turned = [unit(v) @ frame.rotation for v in vecs]
        own = len(vecs) == 1
        va, vb = vecs[0], vecs[-1]
        norm_a, norm_b = np.linalg.norm(va, axis=1), np.linalg.norm(vb, axis=1)

        def exact(i, j):
            out = []
            for x in range(0, len(i), 200_000):
                p, q = i[x : x + 200_000], j[x : x + 200_000]
                with np.errstate(all="ignore"):
                    cos = np.einsum("ij,ij->i", va[p], vb[q]) / (norm_a[p] * norm_b[q])
                odd = ~np.isfinite(cos)  # norms out of range: by the scaled vectors
                if odd.any():
                    cos[odd] = np.einsum("ij,ij->i", unit(va[p[odd]]), unit(vb[q[odd]]))
                out.append(cos >= threshold)
            return np.concatenate(out)

        degree, label = tile_links(turned[0], None if own else turned[1], frame.lead, threshold, ns[0], ns[-1], exact)
        everyone = nodes[0] if own else np.concatenate(nodes)
        some = np.flatnonzero(label >= 0)
        return pa.table({"node": everyone[some], "n_links": degree[some], "root": everyone[label[some]]})

    # pairs of tiles cost alike: deal them out one by one
    return meet.groupBy("a", "b").applyInArrow(compare, "node bigint, n_links bigint, root bigint")
