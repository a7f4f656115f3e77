"""Similarity of sequences, and of sequences with annotations, from long k-mer tables."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.operators.packed import LIST, Sets, packed
from lettermill.operators.store import written


def set_sizes(pairs: DataFrame) -> DataFrame:
    """seq_id, n: distinct k-mers of each sequence. pairs: distinct (seq_id, kmer)."""
    return pairs.groupBy("seq_id").agg(F.count("*").alias("n"))


def overlaps(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    """candidates (a, b, ...) with common: k-mers that both have. Pairs without any are left out. Only sets of candidates move, as one row each."""
    wanted = written(candidates.select(F.explode(F.array("a", "b")).alias("seq_id")).distinct())
    sets = written(pairs.join(wanted, "seq_id", "left_semi").groupBy("seq_id").agg(F.collect_list("kmer").alias("kmers")))
    a, b = (sets.select(F.col("seq_id").alias(x), F.col("kmers").alias(f"kmers_{x}")) for x in "ab")
    common = F.size(F.array_intersect("kmers_a", "kmers_b")).cast("long")
    return candidates.join(a, "a").join(b, "b").select(*candidates.columns, common.alias("common")).where("common > 0")


def set_classes(pairs: DataFrame) -> DataFrame:
    """seq_id, rep: the smallest seq_id with the same set of k-mers (told by its size and 128 bits of hash)."""
    marks = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("kmer")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "kmer")).alias("y")]
    marked = written(pairs.groupBy("seq_id").agg(*marks))
    return marked.join(marked.groupBy("n", "x", "y").agg(F.min("seq_id").alias("rep")), ["n", "x", "y"]).select("seq_id", "rep")


def jaccard_pairs(pairs: DataFrame, max_dist: float) -> DataFrame:
    """a, b, distance of all pairs of non-empty sets with Jaccard distance up to max_dist (below 1). Two empty sets, which have distance 0, have no rows here.

    pairs: distinct (seq_id, kmer), or sets in packed form, which are deleted when they have been compared.
    """
    return Sets(packed(pairs)).all_near(max_dist, LIST).select("a", "b", "distance")


def jaccard_links(pairs: DataFrame, max_dist: float) -> DataFrame:
    """a, b, distance: links that join what jaccard_pairs joins. Of equal sets only the first is compared, and the others hang on it, so M copies make M links and not M squared."""
    sets = Sets(packed(pairs))
    copies = sets.members.where("seq <> rep").select(F.col("rep_id").alias("a"), F.col("seq_id").alias("b"), F.lit(0.0).alias("distance"))
    return sets.named(sets.near(max_dist, LIST)).select("a", "b", "distance").unionByName(copies)


def near_hamming(sets: DataFrame, max_dist: float) -> DataFrame:
    """a, b, similarity: share of the basis of all packed sets on which both agree, of the pairs of jaccard_pairs."""
    sets = Sets(sets)
    near = sets.all_near(max_dist, LIST)
    return near.select("a", "b", (1 - (F.col("n_a") + F.col("n_b") - 2 * F.col("common")) / sets.basis_size).alias("similarity"))


def near_distance(sets: DataFrame, max_dist: float, metric: str) -> DataFrame:
    """a, b, distance of the count vectors of the pairs of jaccard_pairs of packed sets; metric as in pairwise_distance."""
    return Sets(sets, counted=True).all_near(max_dist, LIST).select("a", "b", vector_distance(metric).alias("distance"))


def hamming_similarity(pairs: DataFrame, candidates: DataFrame, n_basis: int | Column) -> DataFrame:
    """a, b, similarity: share of the basis on which both sets agree, for candidates (a, b, n_a, n_b)."""
    return overlaps(pairs, candidates).select("a", "b", (1 - (F.col("n_a") + F.col("n_b") - 2 * F.col("common")) / n_basis).alias("similarity"))


def vector_distance(metric: str) -> Column:
    """Distance of two count vectors from their sums s, sums of squares q, products dot and smaller counts low."""
    return {
        "cosine": 1 - F.col("dot") / (F.sqrt("q_a") * F.sqrt("q_b")),
        "euclidean": F.sqrt(F.col("q_a") + F.col("q_b") - 2 * F.col("dot")),
        "manhattan": (F.col("s_a") + F.col("s_b") - 2 * F.col("low")).cast("double"),
    }[metric]


def pairwise_distance(counts: DataFrame, candidates: DataFrame, metric: str) -> DataFrame:
    """a, b, distance of the count vectors of candidates (a, b); metric: cosine, euclidean or manhattan."""
    sums = counts.groupBy("seq_id").agg(F.sum("cnt").alias("s"), F.sum(F.col("cnt") * F.col("cnt")).alias("q"))
    a, b = (counts.select(F.col("seq_id").alias(x), "kmer", F.col("cnt").alias(f"c_{x}")) for x in "ab")
    shared = candidates.select("a", "b").join(a, "a").join(b, ["b", "kmer"]).groupBy("a", "b").agg(F.sum(F.col("c_a") * F.col("c_b")).alias("dot"), F.sum(F.least("c_a", "c_b")).alias("low"))
    for x in "ab":
        shared = shared.join(sums.select(F.col("seq_id").alias(x), F.col("s").alias(f"s_{x}"), F.col("q").alias(f"q_{x}")), x)
    return shared.select("a", "b", vector_distance(metric).alias("distance"))


def write_distances(distances: DataFrame, path: str) -> None:
    distances.write.mode("overwrite").parquet(path)


def cosine_scores(counts: DataFrame, annotation_counts: DataFrame) -> DataFrame:
    """seq_id, annotation, score: cosine of (seq_id, kmer, cnt) with (annotation, kmer, cnt) over the union of their k-mers.

    Norms take all k-mers of a side, also those that the other never has. Pairs
    without a common k-mer have score 0 and no row; a `Totals` row is left out.

    Counts are read once: each row meets the cells of its k-mer and itself, under
    no annotation, which sums up to the sequence's norm. The profiles are a table
    with a row per k-mer; Spark broadcasts it below its threshold.
    """
    profiles = written(annotation_counts.where("annotation <> 'Totals'"))
    cells = written(profiles.groupBy("kmer").agg(F.collect_list(F.struct("annotation", F.col("cnt").alias("c"))).alias("cells")))  # a row per k-mer, an entry per annotation
    own = F.array(F.struct(F.lit(None).cast("string").alias("annotation"), F.col("cnt").alias("c")))
    met = counts.join(cells, "kmer", "left").select("seq_id", "cnt", F.explode(F.when(F.col("cells").isNull(), own).otherwise(F.concat("cells", own))).alias("cell"))
    sums = met.groupBy("seq_id", "cell.annotation").agg(F.sum(F.col("cnt") * F.col("cell.c")).alias("dot"))
    # one row per annotation of a sequence
    both = sums.withColumn("q", F.sum(F.when(F.col("annotation").isNull(), F.col("dot"))).over(Window.partitionBy("seq_id"))).where("annotation IS NOT NULL")
    norms = profiles.groupBy("annotation").agg(F.sum(F.col("cnt") * F.col("cnt")).alias("p"))
    return both.join(norms, "annotation").select("seq_id", "annotation", (F.col("dot") / (F.sqrt("q") * F.sqrt("p"))).alias("score"))


def associations(annotation_counts: DataFrame, n_seqs: DataFrame) -> DataFrame:
    """annotation, kmer, association: counts by the annotation's sequences (annotation, n_seqs); zero cells have no row."""
    return annotation_counts.where("annotation <> 'Totals'").join(n_seqs, "annotation").select("annotation", "kmer", (F.col("cnt") / F.col("n_seqs")).alias("association"))


def association_scores(pairs: DataFrame, assoc: DataFrame) -> DataFrame:
    """seq_id, annotation, score: sum of the associations of the k-mers that a sequence has."""
    return pairs.join(assoc, "kmer").groupBy("seq_id", "annotation").agg(F.sum("association").alias("score"))


def enhanced_scores(pairs: DataFrame, assoc: DataFrame) -> DataFrame:
    """As association_scores, but each k-mer of the sequence that is known to some annotation and not to this one counts minus the mean association of this one.

    Sequences that share no k-mer with an annotation have no row for it.
    """
    means = assoc.groupBy("annotation").agg(F.avg("association").alias("m"))
    known = pairs.join(assoc.select("kmer").distinct(), "kmer", "left_semi")
    sizes = known.groupBy("seq_id").agg(F.count("*").alias("n"))
    hits = pairs.join(assoc, "kmer").groupBy("seq_id", "annotation").agg(F.sum("association").alias("s"), F.count("*").alias("hit"))
    return hits.join(sizes, "seq_id").join(means, "annotation").select("seq_id", "annotation", (F.col("s") - F.col("m") * (F.col("n") - F.col("hit"))).alias("score"))
