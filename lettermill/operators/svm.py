"""Linear support vector machines for many labellings of the same sequences at once.

Each fit has balanced classes, the squared hinge and an offset that is a feature
like others. All fits of a group read the rows together: a pass broadcasts their
weights, every task sums up the gradients of its rows, and the sums meet piece by
piece. The driver holds weights, of at most NUMBERS numbers a group, never rows.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.operators.kmers import indexed
from lettermill.operators.store import written

#: Labellings whose memberships of a sequence are the bits of one number.
BITS = 60
#: Weights of one group of fits, cells of a dense block of rows, and numbers in one piece of a sum.
NUMBERS, CELLS, PIECE = 4_000_000, 4_000_000, 16_384
#: The most frequent features, whose products precondition the steps; other features count for themselves.
HEAVY = 2000


def labelling_bits(labellings: DataFrame, family: str) -> DataFrame:
    """seq_id and masks, BITS labellings to a number, of (perm from 1, seq_id, label): whether the sequence belongs to the family."""
    inside = F.when(F.col("label") == family, F.expr(f"shiftleft(1L, int(pmod(perm - 1, {BITS})))")).otherwise(F.lit(0).cast("long"))
    chunks = labellings.groupBy("seq_id", F.expr(f"(perm - 1) div {BITS}").alias("chunk")).agg(F.sum(inside).alias("mask"))
    return chunks.groupBy("seq_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "mask"))), lambda c: c["mask"]).alias("masks"))


def dense_blocks(batch, n_features: int, fits: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows (idx, masks) of a batch as (features that occur, 0/1 matrix over them and the offset, memberships in the fits)."""
    lists = batch.column(0)
    items, edges = lists.values.to_numpy(), lists.offsets.to_numpy()
    masks = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
    place, start = fits // BITS, 0
    while start < batch.num_rows:
        stop = start + 1
        # as many rows as keep rows times items, at least rows times features, within bounds
        while stop < batch.num_rows and (stop + 1 - start) * min(n_features, edges[stop + 1] - edges[start]) <= CELLS:
            stop += 1
        own = items[edges[start] : edges[stop]]
        used, at = np.unique(own, return_inverse=True)
        x = np.zeros((stop - start, len(used) + 1))
        x[np.repeat(np.arange(stop - start), np.diff(edges[start : stop + 1])), at] = 1
        x[:, -1] = 1
        yield np.append(used, n_features), x, (masks[start:stop][:, place] >> (fits % BITS)) & 1 == 1
        start = stop


def summed(rows: DataFrame, shape: tuple[int, ...], each: Callable) -> np.ndarray:
    """Sum over all rows of what each(batch, total) adds to an array of the given shape in a task; the tasks' sums meet piece by piece."""
    size = int(np.prod(shape))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                each(batch, total)
        flat = total.reshape(-1)
        for piece in range(-(-size // PIECE)):
            yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([flat[piece * PIECE : (piece + 1) * PIECE].tobytes()], pa.binary())], names=["piece", "data"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, piece = 0.0, None
        for batch in batches:
            for data in batch.column(1).to_pylist():
                total, piece = total + np.frombuffer(data), batch.column(0)[0].as_py()
        yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["piece", "data"])

    pieces = rows.mapInArrow(run, "piece int, data binary").groupBy("piece").applyInArrow(add, "piece int, data binary").collect()
    out = np.zeros(size)
    for r in pieces:
        out[r.piece * PIECE : r.piece * PIECE + len(r.data) // 8] = np.frombuffer(r.data)
    return out.reshape(shape)


def minimised(value: Callable, precondition: Callable, shape: tuple[int, int], tol: float, passes: int, memory: int = 8) -> np.ndarray:
    """Each column minimised for itself by limited-memory quasi-Newton steps: value(x, columns) gives their values and gradients in one pass.

    A column is done when no part of its gradient exceeds tol times that at 0. A step that does not help is halved in the next pass, while other columns go on.
    """
    x, (f, g) = np.zeros(shape), value(np.zeros(shape), np.arange(shape[1]))
    first, past = np.maximum(np.abs(g).max(axis=0), 1e-300), []
    step, way, fresh = np.ones(shape[1]), np.zeros(shape), np.ones(shape[1], bool)
    for _ in range(passes):
        columns = np.flatnonzero(np.abs(g).max(axis=0) > tol * first)
        if not len(columns):
            break
        q, shares = g.copy(), []
        for s, y, r in reversed(past):
            shares.append(r * (s * q).sum(axis=0))
            q -= shares[-1] * y
        q = precondition(q)
        for (s, y, r), share in zip(past, reversed(shares), strict=True):
            q += (share - r * (y * q).sum(axis=0)) * s
        way, step = np.where(fresh, -q, way), np.where(fresh, 1.0, step)
        at, ft, gt = x.copy(), f.copy(), g.copy()
        at[:, columns] += step[columns] * way[:, columns]
        ft[columns], gt[:, columns] = value(at[:, columns], columns)
        moved = np.isin(np.arange(shape[1]), columns) & (ft <= f + 1e-4 * step * (g * way).sum(axis=0))
        s, y = np.where(moved, at - x, 0.0), np.where(moved, gt - g, 0.0)
        bend = (s * y).sum(axis=0)
        if moved.any():
            past = [*past, (s, y, np.where(bend > 1e-12, 1 / np.where(bend > 1e-12, bend, 1), 0.0))][-memory:]
        x, f, g = np.where(moved, at, x), np.where(moved, ft, f), np.where(moved, gt, g)
        step, fresh = np.where(moved, step, step / 2), moved
    return x


def fit_labellings(pairs: DataFrame, bits: DataFrame, n_fits: int, cost: float = 1.0, tol: float = 1e-4, passes: int = 400) -> DataFrame:
    """fit (from 1), kmer, weight: a linear SVM on k-mer presence for each labelling of (seq_id, masks), as labelling_bits() gives them; the offset has a null kmer.

    Minimises w.w / 2 + cost * sum of c (1 - y w.x)^2 over the rows below their
    margin; c is rows / (2 * rows of the class), and a labelling of one class has
    weights of 0. Sequences without a k-mer of pairs count for the offset.
    """
    spark, basis = pairs.sparkSession, written(indexed(pairs))
    d, n = basis.count(), bits.count()
    own = pairs.join(bits.select("seq_id"), "seq_id", "left_semi").join(basis, "kmer").groupBy("seq_id").agg(F.array_sort(F.collect_list(F.col("idx").cast("int"))).alias("idx"))
    rows = written(bits.join(own, "seq_id", "left").select(F.coalesce("idx", F.array().cast("array<int>")).alias("idx"), "masks"))
    # one number per feature, as many as a fit has weights
    counts = np.zeros(d + 1)
    found = own.select(F.explode("idx").alias("idx")).groupBy("idx").agg(F.count("*").alias("n")).toArrow()
    counts[found.column("idx").to_numpy()] = found.column("n").to_numpy()
    heavy, none = np.append(np.sort(np.argsort(-counts[:d], kind="stable")[:HEAVY]), d), np.zeros(0, np.int64)

    def products(batch, total):
        for used, x, _ in dense_blocks(batch, d, none):
            wanted = np.isin(used, heavy)
            at = np.searchsorted(heavy, used[wanted])
            total[np.ix_(at, at)] += x[:, wanted].T @ x[:, wanted]

    gram = summed(rows, (len(heavy), len(heavy)), products)
    inverse = np.linalg.inv(np.eye(len(heavy)) + cost * gram)
    found = []
    for start in range(0, n_fits, max(1, NUMBERS // (d + 1))):
        fits = np.arange(start, min(n_fits, start + max(1, NUMBERS // (d + 1))))

        def count(batch, total, fits=fits):
            for _, _, inside in dense_blocks(batch, d, fits):
                total += inside.sum(axis=0)

        inside = summed(rows, (len(fits),), count)
        both = (inside > 0) & (inside < n)
        heights = np.stack([n / (2 * np.maximum(inside, 1)), n / (2 * np.maximum(n - inside, 1))]) * both * cost

        def value(w, columns, fits=fits, heights=heights):
            shared = spark.sparkContext.broadcast((w, fits[columns], heights[:, columns]))

            def each(batch, total):
                w, fits, heights = shared.value
                for used, x, inside in dense_blocks(batch, d, fits):
                    y = np.where(inside, 1.0, -1.0)
                    below = np.maximum(0, 1 - y * (x @ w[used]))
                    force = np.where(inside, heights[0], heights[1]) * below
                    total[used] -= 2 * (x.T @ (force * y))
                    total[-1] += (force * below).sum(axis=0)

            out = summed(rows, (d + 2, len(columns)), each)
            shared.destroy()
            return out[-1] + (w * w).sum(axis=0) / 2, out[:-1] + w

        def precondition(q):
            out = q / (1 + cost * counts)[:, None]
            out[heavy] = inverse @ q[heavy]
            return out

        shared = spark.sparkContext.broadcast(minimised(value, precondition, (d + 1, len(fits)), tol, passes))

        def spread(batches: Iterator, shared=shared, start=start) -> Iterator:
            for batch in batches:
                w = shared.value[batch.column(0).to_numpy()]
                kmers = batch.column(1).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array(np.tile(np.arange(start + 1, start + 1 + w.shape[1], dtype=np.int32), len(w))), pa.array(np.repeat(np.array(kmers, object), w.shape[1]), pa.string()), pa.array(w.reshape(-1))], names=["fit", "kmer", "weight"])

        names = basis.select("idx", "kmer").unionByName(spark.range(1).select(F.lit(d).cast("long").alias("idx"), F.lit(None).cast("string").alias("kmer")))
        found.append(written(names.mapInArrow(spread, "fit int, kmer string, weight double")))
        shared.destroy()
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def over_largest(weights: DataFrame) -> DataFrame:
    """The k-mers' weights (fit, kmer, weight) divided by the largest of their fit, where that is above 0."""
    own = weights.where("kmer IS NOT NULL")
    top = own.groupBy("fit").agg(F.max("weight").alias("top"))
    return own.join(top, "fit").select("fit", "kmer", F.when(F.col("top") > 0, F.col("weight") / F.col("top")).otherwise(F.col("weight")).alias("weight"))


def residuals(pairs: DataFrame, labels: DataFrame, family: str, weights: DataFrame) -> DataFrame:
    """kmer, residual: the gradient of one fit's objective at its weights (kmer, weight) over the largest gradient at 0.

    Joins and sums alone, so it checks a fit by what the fit does not use; cost is 1.
    """
    own = labels.select("seq_id", F.when(F.col("label") == family, 1.0).otherwise(-1.0).alias("y"))
    sizes = own.groupBy("y").agg(F.count("*").alias("n_y"))  # two rows
    total, offset = written(own.agg(F.count("*").alias("n"))), written(weights.where("kmer IS NULL").select("weight"))
    score = pairs.join(weights, "kmer").groupBy("seq_id").agg(F.sum("weight").alias("s"))
    rows = own.join(F.broadcast(sizes), "y").join(score, "seq_id", "left").withColumns({"c": total.scalar() / (2 * F.col("n_y")), "b": offset.scalar()})
    below = F.greatest(1 - F.col("y") * (F.coalesce("s", F.lit(0.0)) + F.col("b")), F.lit(0.0))
    pulls = pairs.join(rows.select("seq_id", (F.col("c") * F.col("y")).alias("first"), (F.col("c") * below * F.col("y")).alias("now")), "seq_id").groupBy("kmer").agg(F.sum("first").alias("first"), F.sum("now").alias("now"))
    pulls = written(pulls)
    most = written(pulls.agg(F.max(F.abs(2 * F.col("first"))).alias("most")))
    return weights.join(pulls, "kmer").select("kmer", ((F.col("weight") - 2 * F.col("now")) / most.scalar()).alias("residual"))
