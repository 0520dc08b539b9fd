"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medloom.llm.shared import drop_stored, fresh, store, text_batches
from medloom.llm.textcols import column, held, slices, utf8

#: Labelled rows that a model is fitted on at most: those of least hash of id and text.
FIT_ROWS = 4_000
#: Bytes of all texts that a model is fitted on at most; a text that does not fit in what is left is not in the sample.
FIT_BYTES = 16 << 20
#: Characters of an n-gram.
SIZES = (4, 6, 8)
#: Features at most; by cross-validation on labelled rows that are not held out.
FEATURES = 8_000
#: Texts with an n-gram, at least, for it to be a feature.
LEAST_TEXTS = 5
_BUCKET_BITS = 21
_PRIME, _MIX = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)

#: Which code points stay: letters, marks on letters and the apostrophe; all beyond the first plane do.
_KEEP = np.array([chr(c) == "'" or unicodedata.category(chr(c))[0] in "LM" for c in range(1 << 16)] + [True])


def folded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts in lower case, what is no letter as single spaces, each text between two spaces; and the
    places of the spaces that bound them."""
    data, offsets = utf8(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    offsets = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    out = np.insert(np.where(_KEEP[np.minimum(points, 1 << 16)], points, np.uint32(0x20)), offsets, np.uint32(0x20))
    bound = np.zeros(len(out), bool)
    bound[offsets + np.arange(len(offsets))] = True
    # of spaces in a row one stays, none beside a bound: those behind a space go first, then those before a bound
    space = out == 0x20
    keep = bound | ~space
    keep[1:] |= ~space[:-1]
    out, bound = out[keep], bound[keep]
    keep = bound | (out != 0x20)
    keep[:-1] |= ~bound[1:]
    return out[keep], np.flatnonzero(bound[keep])


def gram_codes(text: np.ndarray) -> list[np.ndarray]:
    """For each of ``SIZES`` the 64-bit code of the n-gram that begins at every place."""
    out, code = [], np.zeros(len(text), np.uint64)
    for k in range(max(SIZES)):
        n = max(0, len(text) - k)
        code = code[:n] * _PRIME + text[k : k + n]
        if k + 1 in SIZES:
            mixed = (code ^ np.uint64(k + 1)) * _MIX
            mixed ^= mixed >> np.uint64(29)
            out.append(mixed * _MIX)
    return out


def code_of(gram: str) -> int:
    """The code of one n-gram of one of the sizes."""
    return int(gram_codes(np.array([ord(c) for c in gram], np.uint32))[SIZES.index(len(gram))][0])


@dataclass
class Model:
    """Features by ascending code, and the weight of each where present; the score is the logistic of their sum."""

    codes: np.ndarray
    weight: np.ndarray
    bias: float
    first: np.ndarray = field(init=False)

    def __post_init__(self):
        # ascending codes are ascending buckets: a bucket's features lie between two numbers
        self.first = np.searchsorted(self.codes >> np.uint64(64 - _BUCKET_BITS), np.arange((1 << _BUCKET_BITS) + 1, dtype=np.uint64)).astype(np.int32)
        self.deep = int(np.diff(self.first).max(initial=0))

    def present(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Texts and features in them, each pair once."""
        text, bounds = folded(texts)
        pairs = []
        for size, code in zip(SIZES, gram_codes(text), strict=True):
            bucket = (code >> np.uint64(64 - _BUCKET_BITS)).astype(np.int64)
            at = np.flatnonzero(self.first[bucket + 1] > self.first[bucket])
            row = np.searchsorted(bounds, at, "right") - 1
            inside = (row < len(bounds) - 1) & (at + size <= bounds[np.minimum(row + 1, len(bounds) - 1)] + 1)
            at, row = at[inside], row[inside]
            for k in range(self.deep):
                feature = self.first[bucket[at]] + k
                same = (feature < self.first[bucket[at] + 1]) & (self.codes[np.minimum(feature, len(self.codes) - 1)] == code[at])
                pairs.append(row[same] * len(self.codes) + feature[same])
        seen = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        return seen // max(1, len(self.codes)), seen % max(1, len(self.codes))

    def scores(self, texts: pa.Array) -> np.ndarray:
        row, feature = self.present(texts)
        total = np.bincount(row, self.weight[feature], minlength=len(texts))[: len(texts)]
        return 1 / (1 + np.exp(-np.clip(total + self.bias, -30, 30)))


def _ratios(toxic_with: np.ndarray, clean_with: np.ndarray, toxic: int, clean: int) -> tuple[np.ndarray, np.ndarray]:
    """Naive Bayes log-count ratios, from the texts with an n-gram by class, and by how many deviations they tell."""
    p, q = toxic_with.astype(float), clean_with.astype(float)
    ratio = np.log((p + 1) / (toxic + 2)) - np.log((q + 1) / (clean + 2))
    return ratio, np.abs(ratio) / np.sqrt(1 / (p + 1) + 1 / (q + 1))


def _best(telling: np.ndarray, code: np.ndarray, most: int) -> np.ndarray:
    """Indexes of the ``most`` most telling, ties to the lesser code."""
    return np.lexsort((code, -telling))[:most]


def features(texts: pa.Array, toxic: np.ndarray, most: int = FEATURES) -> tuple[np.ndarray, np.ndarray]:
    """Codes, ascending, and log-count ratios of the most telling n-grams.

    Texts are counted by n-gram in two passes: by bucket of the code for all, then by code in the most telling buckets
    alone, so that what is held does not grow with the number of n-grams."""
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    grams = lambda i: np.unique(np.concatenate(gram_codes(folded(texts.slice(i, 1))[0])))
    shift = np.uint64(64 - _BUCKET_BITS)
    in_bucket = np.zeros((2, 1 << _BUCKET_BITS), np.int32)
    for i, y in enumerate(toxic.tolist()):
        in_bucket[int(y)][np.unique((grams(i) >> shift).astype(np.int64))] += 1
    some = np.flatnonzero((in_bucket[1] > 0) & (in_bucket[0] + in_bucket[1] >= LEAST_TEXTS))
    chosen = np.zeros(1 << _BUCKET_BITS, bool)
    chosen[some[_best(_ratios(in_bucket[1][some], in_bucket[0][some], n1, n0)[1], some, 2 * most)]] = True
    del in_bucket
    found: list[list[np.ndarray]] = [[], []]
    for i, y in enumerate(toxic.tolist()):
        code = grams(i)
        found[int(y)].append(code[chosen[(code >> shift).astype(np.int64)]])
    both = [np.unique(np.concatenate(x), return_counts=True) for x in found]
    code = np.union1d(both[0][0], both[1][0])
    with_gram = np.zeros((2, len(code)), np.int64)
    for y, (mine, many) in enumerate(both):
        with_gram[y][np.searchsorted(code, mine)] = many
    enough = (with_gram[1] > 0) & (with_gram.sum(axis=0) >= LEAST_TEXTS)
    code, with_gram = code[enough], with_gram[:, enough]
    ratio, telling = _ratios(with_gram[1], with_gram[0], n1, n0)
    best = np.sort(_best(telling, code, most))
    return code[best], ratio[best]


def fit(texts: pa.Array, toxic: np.ndarray, turns: int = 150) -> Model:
    """A logistic regression with an L2 penalty over the most telling n-grams, each scaled by its log-count ratio and
    present or not.  Without one of the classes, or without features, the model always answers the share of toxic texts."""
    toxic = toxic.astype(bool)
    prior = (toxic.sum() + 1) / (len(toxic) + 2)
    code, ratio = features(texts, toxic) if toxic.any() and not toxic.all() else (np.zeros(0, np.uint64), np.zeros(0))
    if not len(code):
        return Model(code, ratio, float(np.log(prior / (1 - prior))))
    plain, rows = Model(code, ratio, 0.0), []
    for at in range(0, len(texts), 200):
        row, feature = plain.present(texts.slice(at, 200))
        rows.append(np.stack([row + at, feature]))
    row, feature = np.concatenate(rows, axis=1)
    weight, bias = _logistic(row, feature, ratio[feature], toxic.astype(float), len(code), turns)
    return Model(code, weight * ratio, bias)


def _logistic(row, feature, value, y, n, turns, penalty: float = 0.5):
    """Weights and bias by Adam steps over all rows; deterministic."""
    w, b = np.zeros(n), float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    m, v, mb, vb = np.zeros(n), np.zeros(n), 0.0, 0.0
    for t in range(1, turns + 1):
        z = np.bincount(row, w[feature] * value, minlength=len(y)) + b
        g = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        gw = np.bincount(feature, g[row] * value, minlength=n) + penalty * w
        gb = g.sum()
        m, v = 0.9 * m + 0.1 * gw, 0.999 * v + 0.001 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        step = 0.02 * (1 - 0.5 * t / turns)
        w -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        b -= step * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.999**t)) + 1e-8)
    return w, b


def fit_model(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text: str = "text", rows: int = FIT_ROWS, most_bytes: int = FIT_BYTES) -> Model:
    """A model from at most ``rows`` labelled documents of at most ``most_bytes`` together (a bounded sample, of least
    hash), fitted on the driver.  An id that is labelled more than once counts with its largest label; null labels and
    null ids don't count; a null text is empty."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max(label).alias("y"))
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("t"))
    # the ids of the sample come first, so that only their texts are gathered
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(rows)
    sample = store(own.join(F.broadcast(chosen), "id").select("id", "t", "y", F.octet_length("t").alias("size"), F.xxhash64("id", "t").alias("h")), "labelled")
    taken, left = set(), most_bytes
    for r in sample.select("id", "h", "size").distinct().orderBy(F.xxhash64("id"), "id", "h").limit(rows).collect():
        if r["size"] <= left:
            taken.add(r["h"])
            left -= r["size"]
    if not taken:
        drop_stored(sample)
        return fit(pa.array([], pa.string()), np.zeros(0, bool))
    chosen = docs.sparkSession.createDataFrame([(h,) for h in sorted(taken)], "h bigint")
    got = sample.join(F.broadcast(chosen), "h", "left_semi").dropDuplicates(["id", "h"]).orderBy("h", "id").toArrow()
    drop_stored(sample)
    return fit(got.column("t").combine_chunks(), got.column("y").to_numpy())


def score_documents(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text: str = "text", score: str = "score") -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1) of the whole text; null is empty.  The model, of a fixed size, is broadcast.
    Rows that repeat have one score."""
    text_batches(docs.sparkSession)
    # a text that is kept anyway is not sent twice
    kept = text in keep and docs.schema[text].dataType.simpleString() == "string"
    name = text if kept else fresh(docs, "__text")
    source = docs.select(*keep) if kept else docs.select(*keep, F.col(text).cast("string").alias(name))
    own = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    sent = docs.sparkSession.sparkContext.broadcast((model.codes, model.weight, model.bias))
    mark = xxhash.xxh64_intdigest(model.codes.tobytes() + model.weight.tobytes() + np.float64(model.bias).tobytes())

    def run(batches):
        mine = held("toxicity", mark, lambda: Model(*sent.value))
        for batch in batches:
            for piece in slices(batch, name, 1 << 18):
                yield pa.RecordBatch.from_arrays([*(column(piece, k) for k in keep), pa.array(mine.scores(column(piece, name)))], names=[*keep, score])

    return source.mapInArrow(run, f"{own}, `{score}` double")
