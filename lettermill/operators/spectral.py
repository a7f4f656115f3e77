"""K-means and principal components of sparse k-mer vectors, at any number of sequences.

Rows stay where they are. A pass broadcasts an array of k-mers by columns (cluster
sums, or a block of directions), tasks go through their rows and sum up an array of
the same shape, and the sums meet piece by piece. So the driver and each task hold
such arrays of the basis, never rows, and no product of two bases is made.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.operators.kmers import indexed
from lettermill.operators.similarity import set_classes
from lettermill.operators.store import written
from lettermill.operators.svm import CELLS, NUMBERS, summed


def sparse_rows(cells: DataFrame, vertices: DataFrame, basis: DataFrame) -> DataFrame:
    """seq_id, idx, value: the vector of each sequence of vertices over basis (kmer, idx); one without cells (seq_id, kmer, value) has empty arrays."""
    pair = F.struct(F.col("idx").cast("int").alias("idx"), F.col("value").cast("double").alias("value"))
    own = cells.join(basis, "kmer").groupBy("seq_id").agg(F.array_sort(F.collect_list(pair)).alias("cells"))
    every = vertices.select("seq_id").join(own, "seq_id", "left")
    return written(every.select("seq_id", F.coalesce("cells.idx", F.array().cast("array<int>")).alias("idx"), F.coalesce("cells.value", F.array().cast("array<double>")).alias("value")))


def blocks(batch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows (.., idx, value) of a batch as (first, end, features that occur, matrix over them), each of at most CELLS cells or one row."""
    idx, values = batch.column("idx"), batch.column("value")
    items, edges, weights, start = idx.flatten().to_numpy(), np.append(0, np.cumsum(idx.value_lengths().to_numpy())), values.flatten().to_numpy(), 0
    while start < batch.num_rows:
        # as many rows as keep rows times items, at least rows times features, within bounds
        ahead = edges[start + 1 :] - edges[start]
        stop = start + max(1, int(np.searchsorted(ahead * np.arange(1, len(ahead) + 1), CELLS, "right")))
        own = slice(edges[start], edges[stop])
        used, at = np.unique(items[own], return_inverse=True)
        x = np.zeros((stop - start, len(used)))
        x[np.repeat(np.arange(stop - start), np.diff(edges[start : stop + 1])), at] = weights[own]
        yield start, stop, used, x
        start = stop


def nearest(x: np.ndarray, sums: np.ndarray, n: np.ndarray, squares: np.ndarray) -> np.ndarray:
    """The cluster of each row of x whose mean, sums / n, is nearest; of equal ones the first. squares are those of the sums, over all features.

    On presence all sums are whole numbers, so equal distances compare as equal.
    """
    return np.argmin(squares / (n * n) - 2 * (x @ sums) / n, axis=1)


def cluster_presence(pairs: DataFrame, vertices: DataFrame, k: int, passes: int = 50) -> DataFrame:
    """seq_id, cluster (from 0): k-means of k-mer presence (seq_id, kmer) by Lloyd's steps, until no mean moves or after so many passes.

    The first means are k distinct sets of k-mers, chosen by the MD5 of their smallest seq_id,
    so the result doesn't depend on partitions or order; with fewer distinct sets there
    are fewer clusters. A cluster that loses all its members keeps its mean. A sequence
    without k-mers goes to the mean of the smallest norm. Arrays have basis times k numbers.
    """
    spark, basis = pairs.sparkSession, written(indexed(pairs))
    p = basis.count()
    rows = sparse_rows(pairs.withColumn("value", F.lit(1.0)), vertices, basis)
    firsts = set_classes(pairs).select("rep").distinct().orderBy(F.md5("rep"), "rep").limit(k)
    seeds = rows.join(F.broadcast(firsts), F.col("seq_id") == F.col("rep"), "left_semi").orderBy(F.md5("seq_id"), "seq_id").select("idx").toArrow()
    k = seeds.num_rows
    if not k:
        return vertices.select("seq_id", F.lit(0).alias("cluster"))
    sums, n = np.zeros((p, k)), np.ones(k)
    for c, own in enumerate(seeds.column("idx")):
        sums[own.values.to_numpy(), c] = 1
    for _ in range(passes):
        shared = spark.sparkContext.broadcast((sums, n, (sums * sums).sum(axis=0)))

        def add(batch, total, shared=shared):
            sums, n, squares = shared.value
            for _, _, used, x in blocks(batch):
                inside = np.eye(len(n))[nearest(x, sums[used], n, squares)]
                total[used] += x.T @ inside
                total[-1] += inside.sum(axis=0)

        found = summed(rows.select("idx", "value"), (p + 1, k), add)
        shared.destroy()
        filled = found[-1] > 0
        after, n_after = np.where(filled, found[:-1], sums), np.where(filled, found[-1], n)
        same = np.array_equal(after * n, sums * n_after)
        sums, n = after, n_after
        if same:
            break
    shared = spark.sparkContext.broadcast((sums, n, (sums * sums).sum(axis=0)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n, squares = shared.value
        for batch in batches:
            if batch.num_rows:
                found = np.concatenate([nearest(x, sums[used], n, squares) for _, _, used, x in blocks(batch)])
                yield pa.RecordBatch.from_arrays([batch.column("seq_id"), pa.array(found, pa.int32())], names=["seq_id", "cluster"])

    return written(rows.mapInArrow(place, "seq_id string, cluster int"))


def leading(apply, x: np.ndarray, k: int, tol: float, passes: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest eigenvalues of a symmetric matrix, and their vectors, from products apply(block) alone.

    Each pass looks for the best block in the span of the present one, its residuals and the last
    step (conjugate gradients of blocks), until the residuals are at most tol times the largest value.
    """
    x = np.linalg.qr(x)[0]
    ax, step, astep = apply(x), np.zeros((len(x), 0)), np.zeros((len(x), 0))
    for left in range(passes, -1, -1):
        values, turn = np.linalg.eigh(x.T @ ax)
        values, turn = values[::-1], turn[:, ::-1]
        x, ax = x @ turn, ax @ turn
        rest = ax - x * values
        if not left or np.linalg.norm(rest[:, :k], axis=0).max() <= tol * max(values[0], 1e-300):
            break
        for _ in range(2):
            rest = rest - x @ (x.T @ rest)
        sizes = np.linalg.norm(rest, axis=0)
        rest = rest[:, sizes > 1e-14 * max(values[0], 1e-300)]
        if not rest.shape[1]:
            break
        rest = np.linalg.qr(rest)[0]
        span, aspan = np.hstack([x, rest, step]), np.hstack([ax, apply(rest), astep])
        # directions that the others already hold are left out
        inner, basis = np.linalg.eigh(span.T @ span)
        basis = basis[:, inner > 1e-10 * inner[-1]] / np.sqrt(inner[inner > 1e-10 * inner[-1]])
        inside = basis.T @ (span.T @ aspan) @ basis
        best = basis @ np.linalg.eigh((inside + inside.T) / 2)[1][:, ::-1][:, : x.shape[1]]
        other = best.copy()
        other[: x.shape[1]] = 0
        x, ax, step, astep = span @ best, aspan @ best, span @ other, aspan @ other
        size = np.maximum(np.linalg.norm(step, axis=0), 1e-300)
        step, astep = step / size, astep / size
    return values[:k], x[:, :k]


def kmer_components(cells: DataFrame, vertices: DataFrame, k: int, tol: float = 1e-6, passes: int = 100, extra: int = 8, seed: int = 0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Principal components of standardised k-mer features, (seq_id, kmer, value) with 0 for absent cells.

    Returns explained (component from 1, explained, cumulative: shares of the whole
    variance), loadings (component, kmer, loading; unit vectors whose largest loading is positive) and scores
    (seq_id, component, score) of all vertices. Means are subtracted inside the products, so
    vectors stay sparse. Features are scaled by the deviation over all vertices; a
    feature of equal values has loading 0. There are at most as many components as features;
    without any cell all three are empty. Arrays have basis times k + extra numbers, six of them on the driver; a pass
    takes as many columns as keep them within NUMBERS, at least one.
    """
    spark, basis = cells.sparkSession, written(indexed(cells))
    p, n = basis.count(), vertices.count()
    rows = sparse_rows(cells, vertices, basis)
    moments = cells.join(basis, "kmer").groupBy("idx").agg(F.sum("value").cast("double").alias("s"), F.sum(F.col("value") * F.col("value")).cast("double").alias("q")).toArrow()
    mean, spread = np.zeros(p), np.zeros(p)
    at, s, q = (moments.column(c).to_numpy() for c in ("idx", "s", "q"))
    mean[at], spread[at] = s / max(n, 1), q / max(n, 1) - (s / max(n, 1)) ** 2
    varied = spread > 1e-12 * np.maximum(mean * mean, 1e-300)
    scale = np.where(varied, 1 / np.sqrt(np.where(varied, spread, 1)), 0)

    def apply(block: np.ndarray) -> np.ndarray:
        out, width = np.zeros_like(block), max(1, NUMBERS // max(1, p))
        for start in range(0, block.shape[1], width):
            v = scale[:, None] * block[:, start : start + width]
            shared = spark.sparkContext.broadcast((v, mean @ v))

            def add(batch, total, shared=shared):
                v, offset = shared.value
                for _, _, used, x in blocks(batch):
                    t = x @ v[used] - offset
                    total[used] += x.T @ t
                    total[-1] += t.sum(axis=0)

            found = summed(rows.select("idx", "value"), (p + 1, v.shape[1]), add)
            shared.destroy()
            out[:, start : start + width] = scale[:, None] * (found[:-1] - np.outer(mean, found[-1])) / n
        return out

    wide = min(k + extra, int(varied.sum()))
    values, vectors = np.zeros(0), np.zeros((p, 0))
    if wide:
        start = np.random.default_rng(seed).standard_normal((p, wide)) * varied[:, None]
        values, vectors = leading(apply, start, min(k, wide), tol, passes)
        vectors = vectors * varied[:, None]  # equal values are 0 up to rounding
    k = len(values)
    vectors = vectors * np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(k)]) if k else vectors
    shares = values / max(1, varied.sum())
    explained = spark.createDataFrame([(i + 1, float(x), float(y)) for i, (x, y) in enumerate(zip(shares, shares.cumsum(), strict=True))], "component int, explained double, cumulative double")
    shared = spark.sparkContext.broadcast((vectors, scale[:, None] * vectors, (mean * scale) @ vectors))

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, names = shared.value[0][batch.column("idx").to_numpy()], np.array(batch.column("kmer").to_pylist(), object)
            yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(own))), pa.array(np.repeat(names, k), pa.string()), pa.array(own.reshape(-1))], names=["component", "kmer", "loading"])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, v, offset = shared.value
        for batch in batches:
            for start, stop, used, x in blocks(batch):
                names = np.array(batch.column("seq_id").slice(start, stop - start).to_pylist(), object)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(names, k), pa.string()), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(names))), pa.array((x @ v[used] - offset).reshape(-1))], names=["seq_id", "component", "score"])

    loadings = written(basis.select("idx", "kmer").mapInArrow(load, "component int, kmer string, loading double"))
    scores = written(rows.mapInArrow(project, "seq_id string, component int, score double"))
    shared.destroy()
    return explained, loadings, scores


def component_residuals(cells: DataFrame, vertices: DataFrame, explained: DataFrame, loadings: DataFrame) -> DataFrame:
    """component, kmer, residual: what the covariance of the standardised features makes of a component's loadings, by its variance, less the loadings.

    0 for a principal component. Joins and sums alone, so it checks components by what their fit does not use.
    """
    n = written(vertices.agg(F.count("*").cast("double").alias("n")))
    sums = cells.groupBy("kmer").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"))
    moments = written(sums.select("kmer", (F.col("s") / n.scalar()).alias("mean"), F.sqrt(F.col("q") / n.scalar() - (F.col("s") / n.scalar()) ** 2).alias("sd")).where("sd > 1e-6 * mean"))
    ways = written(loadings.join(moments, "kmer").select("component", "kmer", "mean", "sd", "loading", (F.col("loading") / F.col("sd")).alias("v")))
    middle = written(ways.groupBy("component").agg(F.sum(F.col("mean") * F.col("v")).alias("middle")))
    scores = cells.join(ways, "kmer").groupBy("seq_id", "component").agg(F.sum(F.col("value") * F.col("v")).alias("t"))
    every = vertices.select("seq_id").join(middle, F.lit(True)).join(scores, ["seq_id", "component"], "left").select("seq_id", "component", (F.coalesce("t", F.lit(0.0)) - F.col("middle")).alias("t"))
    every = written(every)
    lean = written(every.groupBy("component").agg(F.sum("t").alias("lean")))
    pulls = cells.join(every, "seq_id").groupBy("component", "kmer").agg(F.sum(F.col("value") * F.col("t")).alias("pull"))
    own = written(explained.join(written(moments.agg(F.count("*").alias("varied"))), F.lit(True)).select("component", (F.col("explained") * F.col("varied")).alias("variance")))
    met = ways.join(lean, "component").join(own, "component").join(pulls, ["component", "kmer"])
    image = (F.col("pull") - F.col("mean") * F.col("lean")) / F.col("sd") / n.scalar()
    return met.select("component", "kmer", (image / F.col("variance") - F.col("loading")).alias("residual"))
