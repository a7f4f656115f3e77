"""K-means and principal components against plain arrays."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettermill.operators import spectral, svm


def vertices(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "seq_id string")


def lloyd(x, seeds, passes):
    sums, n = x[seeds].T.copy(), np.ones(len(seeds))
    for _ in range(passes + 1):
        at = np.argmin((sums * sums).sum(axis=0) / (n * n) - 2 * (x @ sums) / n, axis=1)
        for c in set(at):
            sums[:, c], n[c] = x[at == c].sum(axis=0), (at == c).sum()
    return at


@pytest.mark.parametrize("passes", [0, 1, 50])
def test_kmeans_equals_plain_steps(spark, monkeypatch, passes):
    monkeypatch.setattr(spectral, "CELLS", 60)
    monkeypatch.setattr(svm, "PIECE", 5)
    rng = np.random.default_rng(passes)
    x = (rng.random((60, 12)) < 0.4).astype(float)
    x[5], x[9], x[10] = 0, x[8], x[8]
    ids = [f"s{i:02}" for i in range(60)]
    pairs = spark.createDataFrame([(ids[i], f"k{j:02}") for i, j in zip(*np.nonzero(x), strict=True)], "seq_id string, kmer string")
    hashes = {r.seq_id: r.h for r in vertices(spark, ids).select("seq_id", F.md5("seq_id").alias("h")).collect()}
    firsts = {tuple(x[i]): i for i in reversed(range(60)) if x[i].any()}
    seeds = sorted(firsts.values(), key=lambda i: hashes[ids[i]])[:4]
    expected = lloyd(x, seeds, passes)
    for parts in (1, 7):
        found = {r.seq_id: r.cluster for r in spectral.cluster_presence(pairs.repartition(parts), vertices(spark, ids), 4, passes).collect()}
        assert [found[i] for i in ids] == expected.tolist()


def test_kmeans_of_few_or_no_sets(spark):
    pairs = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "seq_id string, kmer string")
    found = {r.seq_id: r.cluster for r in spectral.cluster_presence(pairs, vertices(spark, "abcd"), 5).collect()}
    assert len(found) == 4 and found["a"] == found["b"] != found["c"] and set(found.values()) == {0, 1}
    assert {r.cluster for r in spectral.cluster_presence(pairs.limit(0), vertices(spark, "ab"), 5).collect()} == {0}
    assert spectral.cluster_presence(pairs.limit(0), vertices(spark, ""), 5).count() == 0


@pytest.mark.parametrize("numbers", [30, 1_000_000])
def test_components_equal_a_dense_decomposition(spark, monkeypatch, numbers):
    monkeypatch.setattr(spectral, "CELLS", 60)
    monkeypatch.setattr(spectral, "NUMBERS", numbers)
    monkeypatch.setattr(svm, "PIECE", 5)
    rng = np.random.default_rng(2)
    x = rng.integers(0, 4, (80, 15)) * (rng.random((80, 15)) < 0.5) + np.outer(np.arange(80) % 2, np.arange(15) % 3)
    x[:, 3], x[11] = 2, 0
    x[11, 3] = 2
    x[:, 4] = x[:, 5]
    ids = [f"s{i:02}" for i in range(80)]
    cells = spark.createDataFrame([(ids[i], f"k{j:02}", float(x[i, j])) for i, j in zip(*np.nonzero(x), strict=True)], "seq_id string, kmer string, value double")
    explained, loadings, scores = spectral.kmer_components(cells, vertices(spark, ids), 3, tol=1e-8, extra=2)
    spread = x.std(axis=0)
    z = (x - x.mean(axis=0)) / np.where(spread > 0, spread, 1)
    values, vectors = np.linalg.eigh(z.T @ z / 80)
    values, vectors = values[::-1], vectors[:, ::-1]
    rows = explained.orderBy("component").collect()
    assert np.allclose([r.explained for r in rows], values[:3] / values.sum(), atol=1e-10)
    assert np.allclose([r.cumulative for r in rows], (values / values.sum()).cumsum()[:3], atol=1e-10)
    loading = {(r.component, r.kmer): r.loading for r in loadings.collect()}
    score = {(r.component, r.seq_id): r.score for r in scores.collect()}
    assert len(loading) == 45 and len(score) == 240
    for c in range(3):
        own = np.array([loading[c + 1, f"k{j:02}"] for j in range(15)])
        assert own[np.argmax(np.abs(own))] > 0 and own[3] == 0 and abs(abs(own @ vectors[:, c]) - 1) < 1e-9
        assert np.allclose([score[c + 1, i] for i in ids], z @ own, atol=1e-6)
    left = spectral.component_residuals(cells, vertices(spark, ids), explained, loadings).collect()
    assert len(left) == 42 and max(abs(r.residual) for r in left) < 1e-6


def test_more_components_than_features_and_none(spark):
    cells = spark.createDataFrame([("a", "x", 1.0), ("b", "y", 1.0), ("c", "x", 1.0), ("c", "y", 3.0)], "seq_id string, kmer string, value double")
    explained, _, scores = spectral.kmer_components(cells, vertices(spark, "abcd"), 5)
    assert explained.count() == 2 and scores.count() == 8 and abs(explained.agg(F.sum("explained")).first()[0] - 1) < 1e-12
    assert [t.count() for t in spectral.kmer_components(cells.limit(0), vertices(spark, "ab"), 5)] == [0, 0, 0]
