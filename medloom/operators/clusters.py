"""Soft clusters of a document's vectors: components, mixtures of normal distributions, choice by BIC."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from medloom.session import spread


def reduce(x: np.ndarray, dim: int) -> np.ndarray:
    """The leading principal components."""
    centred = x - x.mean(axis=0)
    _, _, v = np.linalg.svd(centred, full_matrices=False)
    turned = centred @ v[:dim].T
    sign = np.sign(v[np.arange(min(dim, len(v))), np.abs(v[:dim]).argmax(axis=1)])
    return turned * np.where(sign == 0, 1, sign)


def neighbour_weights(x: np.ndarray, k: int) -> np.ndarray:
    """Symmetric weights (0 to 1) of the graph of nearest neighbours by cosine: a neighbour's weight falls off with its
    distance beyond the nearest one's, at a width that gives each row's k neighbours log2(k) in all; two rows are joined
    as either sees the other.  Zero vectors are at distance 1 from all."""
    length = np.linalg.norm(x, axis=1, keepdims=True)
    u = x / np.where(length == 0, 1, length)
    gap = np.maximum(1 - u @ u.T, 0)
    np.fill_diagonal(gap, np.inf)
    near = gap.argsort(axis=1, kind="stable")[:, :k]
    beyond = np.take_along_axis(gap, near, 1)
    beyond = beyond - beyond[:, :1]
    low, high = np.full((len(x), 1), 1e-9), np.full((len(x), 1), 1e3)
    for _ in range(50):
        width = np.sqrt(low * high)
        much = np.exp(-beyond / width).sum(axis=1, keepdims=True) > max(np.log2(k), 1.0)
        low, high = np.where(much, low, width), np.where(much, width, high)
    w = np.zeros_like(gap)
    np.put_along_axis(w, near, np.exp(-beyond / np.sqrt(low * high)), 1)
    return w + w.T - w * w.T


def manifold(x: np.ndarray, dim: int, k: int, turns: int = 200) -> np.ndarray:
    """Rows in ``dim`` dimensions, so that neighbours stay neighbours: the graph's leading eigenvectors, then moved along the
    gradient of the cross entropy between its weights and 1 / (1 + squared distance).  All pairs repel in each step, in
    place of a sample of them, so nothing is left to chance and runs agree."""
    n, k = len(x), min(k, len(x) - 1)
    w = neighbour_weights(x, max(k, 2))
    # a trace of every other row holds parts together that no neighbour joins
    whole = w + 1e-6
    root = np.sqrt(whole.sum(axis=1))
    _, vectors = np.linalg.eigh(np.eye(n) - whole / root[:, None] / root[None])
    y = vectors[:, 1 : dim + 1]
    y = y * np.where(y[np.abs(y).argmax(axis=0), np.arange(y.shape[1])] < 0, -1, 1)
    y = y * (10 / max(np.abs(y).max(), 1e-12))
    away = 5 * w.sum() / n / n
    for t in range(turns):
        square = (y**2).sum(axis=1)
        far = np.maximum(square[:, None] + square[None] - 2 * y @ y.T, 0)
        close = 1 / (1 + far)
        pull = 2 * close * ((1 - w) * away / (1e-3 + far) - w)
        np.fill_diagonal(pull, 0)
        y = y + np.clip(pull.sum(axis=1)[:, None] * y - pull @ y, -4, 4) * (1 - t / turns)
    return y


def densities(x: np.ndarray, share: np.ndarray, mean: np.ndarray, cov: np.ndarray) -> np.ndarray:
    """Logarithms of each component's share times its density at every row, by Cholesky factors."""
    low = np.linalg.cholesky(cov)
    z = (x[None] - mean[:, None]) @ np.swapaxes(np.linalg.inv(low), 1, 2)
    half = np.log(np.diagonal(low, axis1=1, axis2=2)).sum(axis=1)
    return (np.log(share) - half - 0.5 * x.shape[1] * np.log(2 * np.pi))[None] - 0.5 * (z**2).sum(axis=2).T


def _parts(x: np.ndarray, k: int, turns: int = 10) -> np.ndarray:
    """Which of k parts every row begins in: the nearest of centres that are spread by distance, then moved to means."""
    centres = [int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())]
    gap = ((x - x[centres[0]]) ** 2).sum(axis=1)
    while len(centres) < k:
        centres.append(int(gap.argmax()))
        gap = np.minimum(gap, ((x - x[centres[-1]]) ** 2).sum(axis=1))
    mean = x[centres].copy()
    for _ in range(turns):
        part = ((x[:, None] - mean) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.stack([x[part == j].mean(axis=0) if (part == j).any() else mean[j] for j in range(k)])
        if (moved == mean).all():
            break
        mean = moved
    return part


def _ridge(x: np.ndarray, floor: float = 1e-3) -> float:
    """The variance that a covariance has at least in every direction."""
    return floor * float(x.var(axis=0).mean()) + 1e-12


def _free(k: int, d: int) -> int:
    """Free parameters of k normal distributions."""
    return k - 1 + k * d + k * d * (d + 1) // 2


def mixture(x: np.ndarray, k: int, turns: int = 60, floor: float = 1e-3) -> tuple[np.ndarray, float]:
    """Membership probabilities under k normal distributions of full covariance, and the BIC; there is no chance in it, so
    runs agree.  Covariances have at least ``floor`` of the mean variance in every direction.

    Of two beginnings the likelier end counts: parts of the rows as they are, and of the rows with equal variance in all
    directions, where long clusters side by side come apart."""
    ridge = _ridge(x, floor) * np.eye(x.shape[1])
    starts = [_parts(x, k)]
    if k > 1:
        low = np.linalg.cholesky(np.atleast_2d(np.cov(x.T, bias=True)) + ridge)
        starts.append(_parts(np.linalg.solve(low, (x - x.mean(axis=0)).T).T, k))
    return min((_fitted(x, np.eye(k)[s], ridge, turns) for s in starts), key=lambda f: f[1])


def _fitted(x: np.ndarray, p: np.ndarray, ridge: np.ndarray, turns: int) -> tuple[np.ndarray, float]:
    (n, d), k = x.shape, p.shape[1]
    last = -np.inf
    for _ in range(turns):
        weight = p.sum(axis=0) + 1e-10
        mean = p.T @ x / weight[:, None]
        off = x[None] - mean[:, None]
        cov = np.swapaxes(off * p.T[:, :, None], 1, 2) @ off / weight[:, None, None] + ridge
        log = densities(x, weight / weight.sum(), mean, cov)
        top = log.max(axis=1, keepdims=True)
        total = top[:, 0] + np.log(np.exp(log - top).sum(axis=1))
        p = np.exp(log - total[:, None])
        now = total.sum()
        if abs(now - last) < 1e-6 * max(1, abs(now)):
            break
        last = now
    return p, _free(k, d) * np.log(n) - 2 * now


def best_mixture(x: np.ndarray, most: int = 50) -> np.ndarray:
    """Of mixtures of 1 to ``most`` - 1 parts, fewer than rows, the one of least BIC.

    No density is above that of the least covariance, so the BIC of k parts is at least ``free`` parameters' share less that;
    numbers of parts that cannot come below the least BIC so far are not fitted."""
    n, d = x.shape
    peak = -0.5 * d * np.log(2 * np.pi * _ridge(x)) * n
    best, found = None, np.inf
    for k in range(1, max(2, min(most, n))):
        # rounding is far below one in a million
        if best is not None and _free(k, d) * np.log(n) - 2 * peak - 1e-6 * abs(peak) > found:
            break
        p, bic = mixture(x, k)
        if bic < found or best is None:
            best, found = p, bic
    return best


def soft_labels(x: np.ndarray, dim: int, threshold: float, method: str = "components") -> list[np.ndarray]:
    """Members of each cluster: global clusters, then local ones within; few rows are one cluster.  Rows are reduced to
    principal ``components``, or by ``manifold``: the cosine's neighbours (the root of the rows' number in the first step,
    10 in the second), which suits vectors whose length says nothing."""
    shrink = manifold if method == "manifold" else lambda x, dim, k: reduce(x, dim)
    if len(x) <= dim + 1:
        return [np.arange(len(x))]
    out = []
    for column in best_mixture(shrink(x, dim, int(np.sqrt(len(x) - 1)))).T:
        inside = np.flatnonzero(column > threshold)
        if not len(inside):
            continue
        if len(inside) <= dim + 1:
            out.append(inside)
            continue
        for local in best_mixture(shrink(x[inside], dim, 10)).T:
            members = inside[local > threshold]
            if len(members):
                out.append(members)
    return out


def clusters(x: np.ndarray, tokens: np.ndarray, dim: int = 10, threshold: float = 0.1, most_tokens: int = 10_000, before: int | None = None, method: str = "components") -> list[np.ndarray]:
    """Clusters whose tokens exceed the limit are clustered again while that makes them smaller."""
    out = []
    for members in soft_labels(x, dim, threshold, method):
        total = int(tokens[members].sum())
        if len(members) > 1 and total > most_tokens and (before is None or total < before):
            out += [members[m] for m in clusters(x[members], tokens[members], dim, threshold, most_tokens, total, method)]
        else:
            out.append(members)
    return out


def soft_clusters(nodes: DataFrame, dim: int = 10, threshold: float = 0.1, most_tokens: int = 10_000, method: str = "components") -> DataFrame:
    """``nodes`` (doc, section, id, vec, tokens): doc, section, cluster, id for each membership; ``method`` as for
    ``soft_labels``.  A section of a
    document is one task's work, as it is a text's worth of chunks."""

    def run(key, table):
        table = table.sort_by("id")
        x = np.array(table.column("vec").to_pylist(), np.float64)
        ids = table.column("id").to_numpy()
        found = clusters(x, table.column("tokens").to_numpy(), dim, threshold, most_tokens, method=method)
        n = sum(map(len, found))
        return pa.table({"doc": pa.array([key[0].as_py()] * n, pa.int64()), "section": pa.array([key[1].as_py()] * n, pa.string()), "cluster": pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]).astype(np.int32)), "id": pa.array(ids[np.concatenate(found)], pa.int64())})

    # a section takes seconds, whatever its bytes: sections are dealt to more tasks than adaptive execution would leave
    return spread(nodes, "doc", "section").groupBy("doc", "section").applyInArrow(run, "doc bigint, section string, cluster int, id bigint")
