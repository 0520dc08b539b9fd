"""The registered clustering query runs the clustering."""

from collections import defaultdict

import numpy as np

from medloom.operators import clusters
from medloom.plans import catalogue


def test_sections_are_clustered(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(8.0 * (i // 2 % 2), 0.3, 16)], i % 2) for i in range(160)]
    spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    ids, found = defaultdict(set), defaultdict(set)
    for r in catalogue.QUERIES["soft_clusters"](spark, str(tmp_path)).collect():
        ids[r["doc"], r["section"]].add(r["id"])
        found[r["doc"], r["section"]].add(r["cluster"])
    assert min(map(len, ids.values())) > 11 and min(map(len, found.values())) > 1
    assert set().union(*ids.values()) == set(range(160))


def test_densities_against_the_formula():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(20, 3))
    share, mean = np.array([0.3, 0.7]), rng.normal(size=(2, 3))
    half = rng.normal(size=(2, 3, 3))
    cov = half @ np.swapaxes(half, 1, 2) + 0.1 * np.eye(3)
    want = [[np.log(share[k]) - 0.5 * (np.log((2 * np.pi) ** 3 * np.linalg.det(cov[k])) + (r - mean[k]) @ np.linalg.inv(cov[k]) @ (r - mean[k])) for k in range(2)] for r in x]
    assert np.allclose(clusters.densities(x, share, mean, cov), want)


def test_elongated_clusters_are_whole():
    rng = np.random.default_rng(2)
    turn = np.array([[1, 1], [-1, 1]]) / 2**0.5
    long = lambda: rng.normal(size=(150, 2)) * [6, 0.25]
    x = np.concatenate([long() @ turn, (long() + [0, 4]) @ turn])
    p = clusters.best_mixture(x, 12)
    part = p.argmax(axis=1)
    assert p.shape[1] == 2 and len(set(part[:150])) == 1 and len(set(part[150:])) == 1 and part[0] != part[-1]
    # the rows that an own variance in each dimension alone describes need more components
    spread = lambda rows: np.diag(rows.var(axis=0) + 1e-9)
    whole = [np.cov(x[part == k].T) for k in (0, 1)]
    assert all(np.linalg.det(c) < 0.05 * np.linalg.det(spread(x[part == k])) for k, c in enumerate(whole))


def test_steps_raise_the_likelihood_and_agree():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(60, 4)) + 5 * k for k in range(3)])
    bics = [clusters.mixture(x, 3, turns=t)[1] for t in (1, 3, 10, 60)]
    assert all(b <= a + 1e-6 for a, b in zip(bics, bics[1:], strict=False)) and clusters.mixture(x, 3)[1] == clusters.mixture(x, 3)[1]
    p, _ = clusters.mixture(x, 3)
    assert np.allclose(p.sum(axis=1), 1) and clusters.best_mixture(x, 8).shape[1] == 3
    assert clusters.mixture(np.ones((12, 3)), 2)[0].shape == (12, 2)


def test_query_against_a_plain_run(spark):
    """What the query returns is what the clustering of each section returns, section by section, outside of Spark."""
    sf = "/root/testdata/sf0.001"
    want = set()
    sections = defaultdict(list)
    for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect():
        sections[r["label"], r["vec_id"] // 1000].append((r["vec_id"], r["embedding"]))
    for (label, section), rows in sections.items():
        rows.sort()
        for c, members in enumerate(clusters.clusters(np.array([v for _, v in rows], np.float64), np.full(len(rows), 300))):
            want |= {(label, str(section), c, rows[m][0]) for m in members}
    assert {tuple(r) for r in catalogue.QUERIES["soft_clusters"](spark, sf).collect()} == want
