"""Motifs: k-mers ranked by how rarely shuffled labels give them a score as high as the real ones."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.operators.store import numbered, written
from lettermill.operators.svm import BITS, fit_labellings, labelling_bits, over_largest


def svm_weights(pairs: DataFrame, labels: DataFrame, family: str, cost: float = 1.0) -> DataFrame:
    """kmer, weight of a linear SVM (squared hinge) of family against the rest with balanced classes; weights are divided by the largest."""
    return over_largest(fit_labellings(pairs, labelling_bits(labels.select(F.lit(1).alias("perm"), "seq_id", "label"), family), 1, cost)).select("kmer", "weight")


def eliminate_features(pairs: DataFrame, labels: DataFrame, family: str, stop: float = -0.2, drop: float = -0.1, rounds: int | None = None) -> DataFrame:
    """kmer, weight after recursive elimination: while a weight is below `stop`, k-mers below `drop` go and the rest is fitted again.

    Each round loses a k-mer at least, so the condition itself ends it; `rounds` is a bound for trials.
    """
    if stop > drop:
        raise ValueError("stop must not be above drop, or a round may drop nothing")
    pairs = written(pairs)
    weights = written(svm_weights(pairs, labels, family))
    done = 0
    while done != rounds and not weights.where(F.col("weight") < stop).isEmpty():
        kept = weights.where(F.col("weight") >= drop).select("kmer")
        if kept.isEmpty():
            return weights.limit(0)
        pairs = written(pairs.join(kept, "kmer", "left_semi").select("seq_id", "kmer"))
        weights = written(svm_weights(pairs, labels, family))
        done += 1
    return weights


def permute_labels(labels: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """perm from 1 to n, seq_id, label: the labels shuffled over the sequences, anew for each perm.

    The label of the i-th sequence in the order of a seeded hash goes to the i-th
    sequence in order. Both orders are ranked by ranges, so no task has a whole one.
    """
    ids = written(numbered(labels.select("seq_id"), ["seq_id"], "i"))
    size = ids.count()
    perms = labels.withColumn("perm", F.explode(F.sequence(F.lit(1), F.lit(n)))).withColumn("draw", F.md5(F.concat_ws(":", F.lit(seed), "perm", "seq_id")))
    drawn = numbered(perms.select("perm", "draw", "seq_id", "label"), ["perm", "draw", "seq_id"], "i").withColumn("i", F.col("i") - (F.col("perm") - 1) * size)
    return drawn.select("perm", "label", "i").join(ids, "i").select("perm", "seq_id", "label")


def score_statistic(pairs: DataFrame, labels: DataFrame, family: str, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys), kmer, score: share of the family's sequences with the k-mer minus the share of the others'.

    labels: (keys, seq_id, label). A single aggregation for all keys; k-mers are counted per label before they meet the sizes.
    """
    marked = labels.select(*keys, "seq_id", (F.col("label") == family).alias("inside"))
    by = list(keys)
    sizes = marked.groupBy(*by).agg(F.count(F.when(F.col("inside"), 1)).alias("n_in"), F.count(F.when(~F.col("inside"), 1)).alias("n_out"))
    hits = pairs.join(marked, "seq_id").groupBy(*by, "kmer").agg(F.count(F.when(F.col("inside"), 1)).alias("c_in"), F.count(F.when(~F.col("inside"), 1)).alias("c_out"))
    joined = hits.join(sizes, by) if by else hits.join(F.broadcast(sizes), F.lit(True))  # one row
    return joined.select(*by, "kmer", (_share("c_in", "n_in") - _share("c_out", "n_out")).alias("score"))


def _share(c: str, n: str) -> Column:
    return F.when(F.col(n) > 0, F.col(c) / F.col(n)).otherwise(0.0)


def permuted_statistic(pairs: DataFrame, permuted: DataFrame, family: str) -> DataFrame:
    """perm, kmer, score: score_statistic for each perm of (perm, seq_id, label).

    A sequence's memberships are bits of numbers, BITS permutations each, and a
    k-mer's counts are sums over them: each (seq_id, kmer) is read once for BITS
    permutations and not once for each.
    """
    marked = permuted.select("seq_id", F.expr(f"(perm - 1) div {BITS}").alias("chunk"), F.expr(f"int(pmod(perm - 1, {BITS}))").alias("bit"), (F.col("label") == family).alias("inside"))
    sizes = marked.groupBy("chunk", "bit").agg(F.count(F.when(F.col("inside"), 1)).alias("n_in"), F.count(F.when(~F.col("inside"), 1)).alias("n_out"))
    masks = written(marked.groupBy("seq_id", "chunk").agg(F.sum(F.when(F.col("inside"), F.expr("shiftleft(1L, bit)")).otherwise(F.lit(0))).alias("mask")))
    width = (sizes.agg(F.max("bit")).first()[0] or 0) + 1
    counts = pairs.join(masks, "seq_id").groupBy("chunk", "kmer").agg(F.count("*").alias("c"), *[F.sum(F.expr(f"shiftright(mask, {b}) & 1L")).alias(f"b{b}") for b in range(width)])
    cells = counts.select("chunk", "kmer", "c", F.posexplode(F.array(*[f"b{b}" for b in range(width)])).alias("bit", "c_in")).withColumn("c_out", F.col("c") - F.col("c_in"))
    return cells.join(sizes, ["chunk", "bit"]).select((F.col("chunk") * BITS + F.col("bit") + 1).cast("int").alias("perm"), "kmer", (_share("c_in", "n_in") - _share("c_out", "n_out")).alias("score"))


def permutation_scores(pairs: DataFrame, labels: DataFrame, family: str, n: int, stat: str = "score", seed: int = 0) -> DataFrame:
    """perm, kmer, score under shuffled labels. stat "score": the share difference, one aggregation; "svm": the weights of svm_weights, all permutations in the same passes."""
    permuted = written(permute_labels(labels, n, seed))
    if stat == "score":
        return permuted_statistic(pairs, permuted, family)
    weights = over_largest(fit_labellings(written(pairs), labelling_bits(permuted, family), n))
    return weights.select(F.col("fit").alias("perm"), "kmer", F.col("weight").alias("score"))


def permutation_p_values(real: DataFrame, permuted: DataFrame) -> DataFrame:
    """kmer, real_score, false_positives, n, p: permutations whose score of the k-mer is at least the real one, and their share."""
    joined = permuted.join(real.select("kmer", F.col("score").alias("real_score")), "kmer")
    counts = joined.groupBy("kmer", "real_score").agg(F.count(F.when(F.col("score") >= F.col("real_score"), 1)).alias("false_positives"), F.count("*").alias("n"))
    return counts.select("kmer", "real_score", "false_positives", "n", (F.col("false_positives") / F.col("n")).alias("p"))


def permutation_matrix(permuted: DataFrame, n: int) -> DataFrame:
    """Wide form for export: kmer and a column per permutation."""
    return permuted.groupBy("kmer").pivot("perm", list(range(1, n + 1))).agg(F.first("score"))


def rank_motifs(p_values: DataFrame) -> DataFrame:
    return p_values.orderBy("p", F.desc("real_score"), "kmer")
