"""Quality: a byte-level convolutional network in numpy, over overlapping chunks that cover the whole text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm.shared import drop_stored, fresh, store, text_batches
from medloom.llm.textcols import column, held, slices, utf8

#: Labelled rows that a model is fitted on at most, and the bytes of their texts: those of least hash of id and text, up
#: to the first text that does not fit.
FIT_ROWS, FIT_BYTES = 4_000, 10 << 20
#: Numbers that stand for a byte, bytes that a filter covers, filters, units that look at a chunk.
EMBED, WIDTH, FILTERS, UNITS = 8, 6, 16, 16
#: Bytes of a cell; a chunk is two neighbouring cells, so that chunks overlap by half.
CELL = 128
#: Cells that are laid out at once, and bytes that are convolved at once.
_AT_ONCE, _SLICE = 4096, 1 << 15
#: Steps of fitting at least, in whole passes over the labelled texts, texts of a step, and the first step size.
STEPS, STEP_TEXTS, RATE = 750, 32, 0.01
_PAD = 256
_SHAPES = {"embed": (257, EMBED), "filters": (WIDTH * EMBED, FILTERS), "shift": (FILTERS,), "chunk": (FILTERS, UNITS), "chunk_shift": (UNITS,), "last": (2 * UNITS,), "bias": ()}


def cells_of(data: np.ndarray, offsets: np.ndarray, low: int = 0, high: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of every cell (from number ``low`` to ``high``) and the ``WIDTH`` - 1 behind it, a number beyond bytes where
    the text has ended; and the first cell of every text.  Each text has a cell at least."""
    size = np.diff(offsets)
    many = np.maximum(1, -(-size // CELL))
    first = np.concatenate([[0], np.cumsum(many)])
    number = np.arange(low, first[-1] if high is None else min(high, first[-1]))
    row = np.searchsorted(first, number, "right") - 1
    at = ((number - first[row]) * CELL)[:, None] + np.arange(CELL + WIDTH - 1)
    inside = at < size[row, None]
    return np.where(inside, data[np.minimum(offsets[row, None] + at, max(len(data) - 1, 0))].astype(np.int32) if len(data) else 0, _PAD), first


@dataclass
class Network:
    """Bytes become vectors; filters slide over them one byte at a time; the greatest value of each filter in a chunk
    goes through a layer of units; the greatest and the mean value of each unit over all chunks give one probability."""

    weights: dict[str, np.ndarray]

    @classmethod
    def start(cls, seed: int = 11) -> Network:
        rng = np.random.default_rng(seed)
        scale = {"embed": 0.5, "filters": (2 / (WIDTH * EMBED)) ** 0.5, "chunk": (2 / FILTERS) ** 0.5, "last": (1 / UNITS) ** 0.5}
        return cls({k: (rng.normal(0, scale[k], s) if k in scale else np.zeros(s)).astype(np.float32) for k, s in _SHAPES.items()})

    def _windows(self, cells: np.ndarray) -> np.ndarray:
        x = self.weights["embed"][cells]
        view = np.lib.stride_tricks.sliding_window_view(x.reshape(len(cells), -1), WIDTH * EMBED, axis=1)[:, ::EMBED]
        return view.reshape(-1, WIDTH * EMBED)

    def pooled(self, cells: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """The greatest value of each filter in each cell, and where it was."""
        w = self.weights
        out, at = np.empty((len(cells), FILTERS), np.float32), np.empty((len(cells), FILTERS), np.int64) if where else None
        step = max(1, _SLICE // CELL)
        for i in range(0, len(cells), step):
            part = cells[i : i + step]
            value = (self._windows(part) @ w["filters"]).reshape(len(part), CELL, FILTERS)
            if where:
                at[i : i + step] = value.argmax(axis=1)
                out[i : i + step] = np.take_along_axis(value, at[i : i + step][:, None], axis=1)[:, 0]
            else:
                out[i : i + step] = value.max(axis=1)
        return np.maximum(out + w["shift"], 0), at

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        cells, first = cells_of(data, offsets, 0, _AT_ONCE)
        parts = [self.pooled(cells)[0]] + [self.pooled(cells_of(data, offsets, i, i + _AT_ONCE)[0])[0] for i in range(_AT_ONCE, first[-1], _AT_ONCE)]
        return _logistic(self._top(np.concatenate(parts), first)["z"])

    def _top(self, cell: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
        """From cells to the sum that the logistic function turns into a score."""
        w = self.weights
        last = np.zeros(len(cell), bool)
        last[first[1:] - 1] = True
        right = np.where(last, np.arange(len(cell)), np.arange(len(cell)) + 1)
        # a chunk for every cell but a text's last, which has one only if it is alone
        alone = np.zeros(len(cell), bool)
        alone[first[:-1]] = np.diff(first) == 1
        chunks = np.flatnonzero(~last | alone)
        a, b = cell[chunks], cell[right[chunks]]
        value = np.maximum(a, b)
        unit = np.maximum(value @ w["chunk"] + w["chunk_shift"], 0)
        begin = np.searchsorted(chunks, first[:-1])
        count = np.diff(np.append(begin, len(chunks)))[:, None].astype(np.float32)
        most, mean = np.maximum.reduceat(unit, begin), np.add.reduceat(unit, begin) / count
        z = np.concatenate([most, mean], axis=1) @ w["last"] + w["bias"]
        return {"z": z, "most": most, "mean": mean, "unit": unit, "value": value, "chunks": chunks, "right": right[chunks], "left_wins": a >= b, "begin": begin, "count": count}

    def gradient(self, cells: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        w = self.weights
        cell, at = self.pooled(cells, where=True)
        t = self._top(cell, first)
        dz = ((_logistic(t["z"]) - y) / len(y)).astype(np.float32)
        out = {"last": np.concatenate([t["most"], t["mean"]], axis=1).T @ dz, "bias": dz.sum()}
        row = np.repeat(np.arange(len(y)), t["count"][:, 0].astype(np.int64))
        d_most, d_mean = dz[:, None] * w["last"][:UNITS], dz[:, None] * w["last"][UNITS:] / t["count"]
        top = t["unit"] == t["most"][row]
        shared = np.add.reduceat(top.astype(np.float32), t["begin"])
        d_unit = (top * (d_most / shared)[row] + d_mean[row]) * (t["unit"] > 0)
        out["chunk"], out["chunk_shift"] = t["value"].T @ d_unit, d_unit.sum(axis=0)
        d_value = d_unit @ w["chunk"].T
        d_cell = np.zeros_like(cell)
        np.add.at(d_cell, t["chunks"], d_value * t["left_wins"])
        np.add.at(d_cell, t["right"], d_value * ~t["left_wins"])
        d_cell *= cell > 0
        out["shift"] = d_cell.sum(axis=0)
        # only the place of a filter's greatest value in a cell has a part in it
        i, f = np.nonzero(d_cell)
        places = cells[i[:, None], at[i, f][:, None] + np.arange(WIDTH)]
        d = d_cell[i, f][:, None]
        d_filters = np.zeros((FILTERS, WIDTH * EMBED), np.float32)
        seen = w["embed"][places].reshape(len(i), -1)
        for k in range(FILTERS):
            own = f == k
            d_filters[k] = d[own, 0] @ seen[own]
        out["filters"] = d_filters.T
        d_embed = np.zeros_like(w["embed"])
        flat = (d * w["filters"].T[f]).reshape(-1, EMBED)
        for e in range(EMBED):
            d_embed[:, e] = np.bincount(places.ravel(), flat[:, e], minlength=257)
        out["embed"] = d_embed
        return out


def _logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(texts: pa.Array, good: np.ndarray, steps: int = STEPS, seed: int = 11) -> Network:
    """A network fitted by Adam steps over the texts in shuffled order; the same texts give the same network.  Without one
    of the classes it always answers the share of good texts."""
    good = good.astype(np.float32)
    net = Network.start(seed)
    w = net.weights
    share = (good.sum() + 1) / (len(good) + 2)
    w["bias"] = np.float32(np.log(share / (1 - share)))
    if not 0 < good.sum() < len(good):
        w["last"] = np.zeros_like(w["last"])
        return net
    data, offsets = utf8(texts)
    m = {k: np.zeros_like(v) for k, v in w.items()}
    v = {k: np.zeros_like(x) for k, x in w.items()}
    rng = np.random.default_rng(seed)
    passes = -(-steps // -(-len(good) // STEP_TEXTS))
    steps = passes * -(-len(good) // STEP_TEXTS)
    t = 0
    for _ in range(passes):
        order = rng.permutation(len(good))
        for at in range(0, len(order), STEP_TEXTS):
            some = order[at : at + STEP_TEXTS]
            parts = [data[offsets[i] : offsets[i + 1]] for i in some]
            cells, first = cells_of(np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])]))
            g = net.gradient(cells, first, good[some])
            t += 1
            rate = RATE * min(1, t / 20) * (1 - 0.95 * t / steps)
            for k in w:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.99 * v[k] + 0.01 * np.square(g[k])
                w[k] = (w[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.99**t)) + 1e-7)).astype(np.float32)
    return net


def fit_model(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text: str = "text", rows: int = FIT_ROWS, most_bytes: int = FIT_BYTES) -> Network:
    """A network from at most ``rows`` labelled documents of at most ``most_bytes`` together: a bounded sample, in the
    order of a hash of id and text up to the first text that does not fit, fitted on the driver.  An id that is labelled
    more than once counts with its largest label; null labels and null ids don't count; a null text is empty; texts that
    repeat under an id count once."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label).alias("y"))
    # the ids of the sample come first, so that only their texts are gathered
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(rows)
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    sample = store(own.join(F.broadcast(chosen), "id").dropDuplicates(["id", "t"]).select("id", "t", "y", F.octet_length("t").alias("size"), F.xxhash64("id", "t").alias("h")), "labelled")
    left, last = most_bytes, None
    for r in sample.select("h", "size").orderBy("h").limit(rows).collect():
        left -= r["size"]
        if left < 0:
            break
        last = r["h"]
    got = sample.where(F.lit(False) if last is None else F.col("h") <= last).orderBy("h", "id").limit(rows).select("t", "y").toArrow()
    drop_stored(sample)
    return fit(got.column("t").combine_chunks(), got.column("y").to_numpy() > 0)


def score_documents(docs: DataFrame, model: Network, keep: tuple[str, ...] = ("doc_id",), text: str = "text", score: str = "score") -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1, the probability that the text is good) of the whole text; null is empty.
    The network, of a fixed size, is broadcast.  Rows that repeat have one score; null ids are scored."""
    text_batches(docs.sparkSession)
    name = fresh(docs, "whole_text")
    source = docs.select(*keep, F.col(text).cast("string").alias(name))
    own = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    sent = docs.sparkSession.sparkContext.broadcast(model.weights)
    mark = xxhash.xxh64_intdigest(b"".join(np.ascontiguousarray(model.weights[k]).tobytes() for k in _SHAPES))

    def run(batches):
        mine = held("quality", mark, lambda: Network(sent.value))
        for batch in batches:
            for piece in slices(batch, name, 1 << 18):
                scores = mine.scores(*utf8(column(piece, name))).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*(column(piece, k) for k in keep), pa.array(scores)], names=[*keep, score])

    return source.mapInArrow(run, f"{own}, `{score}` double")
