from collections import defaultdict

import numpy as np
import pytest

from medloom.operators import clusters
from medloom.plans import catalogue


def _planted(groups=12, each=25, seed=3):
    """Curved clusters in 64 dimensions, more of them than the dimensions that are kept."""
    r = np.random.default_rng(seed)
    out = []
    for _ in range(groups):
        centre, a, b = (r.normal(size=64) for _ in range(3))
        t = r.uniform(0, 2 * np.pi, each)[:, None]
        out.append(3 * centre + np.cos(t) * a + np.sin(t) * b + 0.05 * r.normal(size=(each, 64)))
    return np.concatenate(out), np.repeat(np.arange(groups), each)


def _neighbours(x, k, cosine=False):
    if cosine:
        u = x / np.linalg.norm(x, axis=1, keepdims=True)
        gap = 1 - u @ u.T
    else:
        gap = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(gap, np.inf)
    return gap.argsort(axis=1)[:, :k]


def _kept(x, y, k=10):
    a, b = _neighbours(x, k, True), _neighbours(y, k)
    return np.mean([len(np.intersect1d(p, q)) / k for p, q in zip(a, b, strict=True)])


@pytest.mark.parametrize("seed", [3, 4, 5, 6])
def test_neighbourhoods_are_kept_better_than_by_components(seed):
    x, label = _planted(seed=seed)
    y = clusters.manifold(x, 2, 15)
    assert _kept(x, y) > _kept(x, clusters.reduce(x, 2))
    assert (label[_neighbours(y, 5)] == label[:, None]).mean() > 0.95
    assert np.array_equal(y, clusters.manifold(x, 2, 15))


def test_planted_groups_are_found():
    x, label = _planted(6, 30)
    found = clusters.soft_labels(x, 5, 0.1, "manifold")
    assert all(len(set(label[m])) == 1 for m in found) and set(np.concatenate(found)) == set(range(len(x)))


def test_weights_are_symmetric_and_each_row_has_a_neighbour():
    x, _ = _planted(3, 10)
    w = clusters.neighbour_weights(x, 5)
    assert np.allclose(w, w.T) and w.min() >= 0 and w.max() <= 1 + 1e-12 and (np.isclose(w.max(axis=1), 1)).all() and (np.diagonal(w) == 0).all()


@pytest.mark.parametrize("x", [np.zeros((20, 8)), np.ones((20, 8)), np.concatenate([np.zeros((5, 8)), np.eye(8), np.eye(8)])], ids=["zero", "equal", "copies"])
def test_odd_rows_have_finite_places(x):
    assert np.isfinite(clusters.manifold(x, 3, 4)).all()
    assert set(np.concatenate(clusters.soft_labels(x, 3, 0.1, "manifold"))) == set(range(len(x)))


def test_fewer_rows_than_neighbours():
    x, _ = _planted(1, 6)
    assert clusters.manifold(x, 3, 50).shape == (6, 3)


def test_query_against_a_plain_run(spark):
    sf = "/root/testdata/sf0.001"
    sections, got = defaultdict(list), defaultdict(lambda: defaultdict(set))
    for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect():
        sections[r["label"], str(r["vec_id"] // 1000)].append((r["vec_id"], r["embedding"]))
    for r in catalogue.QUERIES["manifold_clusters"](spark, sf).collect():
        got[r["doc"], r["section"]][r["cluster"]].add(r["id"])
    for key, rows in sections.items():
        rows.sort()
        found = clusters.clusters(np.array([v for _, v in rows], np.float64), np.full(len(rows), 300), method="manifold")
        assert [{rows[m][0] for m in members} for members in found] == [got[key][c] for c in sorted(got[key])]
