"""Learning annotations' k-mer counts, annotating sequences, and confidence from score differences."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.functions.names import accession
from lettermill.operators.kmers import check_compatible
from lettermill.operators.similarity import cosine_scores

#: Differences are rounded to hundredths: bins 0 to 100.
BINS = 101


def join_annotations(seqs: DataFrame, annotations: DataFrame) -> DataFrame:
    """Sequences whose accession is an id of annotations (id, annotation), with their annotation."""
    return seqs.withColumn("id", accession(F.col("seq_id"))).join(annotations, "id").drop("id")


def annotation_counts(rows: DataFrame) -> DataFrame:
    """annotation, kmer, cnt from one row per window (annotation, kmer)."""
    return rows.groupBy("annotation", "kmer").agg(F.count("*").alias("cnt"))


def annotation_sizes(annotated: DataFrame, counts: DataFrame) -> DataFrame:
    """annotation, n_seqs, n_kmers: sequences and occurrences of each annotation."""
    n = annotated.groupBy("annotation").agg(F.countDistinct("seq_id").alias("n_seqs"))
    return n.join(counts.groupBy("annotation").agg(F.sum("cnt").alias("n_kmers")), "annotation", "left").select("annotation", "n_seqs", F.coalesce("n_kmers", F.lit(0)).alias("n_kmers"))


def with_totals(counts: DataFrame, totals: DataFrame) -> DataFrame:
    """counts and the row of all sequences, annotated or not; totals: kmer, total."""
    return counts.unionByName(totals.select(F.lit("Totals").alias("annotation"), "kmer", F.col("total").alias("cnt")))


def sizes_with_totals(sizes: DataFrame, seqs: DataFrame, totals: DataFrame) -> DataFrame:
    """sizes (annotation, n_seqs, n_kmers) and the row `Totals`: all sequences, annotated or not, and the sum of totals (kmer, total)."""
    n = seqs.agg(F.count("*").alias("n_seqs")).withColumn("__all", F.lit(0))
    k = totals.agg(F.coalesce(F.sum("total"), F.lit(0)).cast("long").alias("n_kmers")).withColumn("__all", F.lit(0))
    return sizes.unionByName(n.join(k, "__all").select(F.lit("Totals").alias("annotation"), "n_seqs", "n_kmers"))


def merge_counts(*parts: DataFrame) -> DataFrame:
    """Sum per annotation and k-mer."""
    return reduce(DataFrame.unionByName, parts).groupBy("annotation", "kmer").agg(F.sum("cnt").alias("cnt"))


def merge_with_base(new: DataFrame, base: DataFrame) -> DataFrame:
    """new added to base if their k-mers have the same length and characters, else new alone."""
    return merge_counts(new, base) if check_compatible(new, base) else new


def tag_known(seqs: DataFrame, annotations: DataFrame) -> DataFrame:
    """seqs with accession, known and actual (its annotation or null)."""
    marked = seqs.withColumn("accession", accession(F.col("seq_id")))
    return marked.join(annotations.select(F.col("id").alias("accession"), F.col("annotation").alias("actual")), "accession", "left").withColumn("known", F.col("actual").isNotNull())


def ranked(scores: DataFrame) -> DataFrame:
    """scores with rank: best first, equal ones by annotation."""
    return scores.withColumn("rank", F.row_number().over(Window.partitionBy("seq_id").orderBy(F.desc("score"), "annotation")))


def top_two(scores: DataFrame) -> DataFrame:
    """The two best annotations of each sequence, with rank."""
    return ranked(scores).where("rank <= 2")


def top_n_summary(scores: DataFrame, n: int, digits: int = 6) -> DataFrame:
    """seq_id, top1 .. topn as `annotation,score`; null where there are fewer."""
    cell = F.concat_ws(",", "annotation", F.format_string(f"%.{digits}f", "score"))
    return ranked(scores).where(F.col("rank") <= n).groupBy("seq_id").agg(*[F.max(F.when(F.col("rank") == i, cell)).alias(f"top{i}") for i in range(1, n + 1)])


def predictions(scores: DataFrame, tagged: DataFrame, substring: bool = False) -> DataFrame:
    """seq_id, prediction, top, second, bin, actual, known, correct for the sequences of `tagged` (seq_id, actual, known).

    bin: hundredths of top minus second, half to even; null with one annotation
    only. correct: prediction equals actual (or is part of it, with substring),
    null for unknown ones. Sequences without score have a null prediction.
    """
    pick = lambda c, r: F.max(F.when(F.col("rank") == r, F.col(c)))
    best = top_two(scores).groupBy("seq_id").agg(pick("annotation", 1).alias("prediction"), pick("score", 1).alias("top"), pick("score", 2).alias("second"))
    best = best.withColumn("bin", F.rint((F.col("top") - F.col("second")) * 100).cast("int"))
    same = F.contains("actual", F.col("prediction")) if substring else F.col("actual") == F.col("prediction")
    return tagged.select("seq_id", "actual", "known").join(best, "seq_id", "left").select("seq_id", "prediction", "top", "second", "bin", "actual", "known", F.when(F.col("known"), same).alias("correct"))


def tf_crosstab(predicted: DataFrame) -> DataFrame:
    """prediction, bin, n_true, n_false of known sequences on the whole grid of bins; differences outside 0 to 1 are left out."""
    known = predicted.where("known AND prediction IS NOT NULL")
    cells = known.where(F.col("bin").between(0, BINS - 1)).groupBy("prediction", "bin").agg(F.count(F.when(F.col("correct"), 1)).alias("t"), F.count(F.when(~F.col("correct"), 1)).alias("f"))
    grid = known.select("prediction").distinct().select("prediction", F.explode(F.sequence(F.lit(0), F.lit(BINS - 1))).alias("bin"))
    return grid.join(cells, ["prediction", "bin"], "left").select("prediction", "bin", F.coalesce("t", F.lit(0)).alias("n_true"), F.coalesce("f", F.lit(0)).alias("n_false"))


def merge_crosstabs(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy("prediction", "bin").agg(F.sum("n_true").alias("n_true"), F.sum("n_false").alias("n_false"))


def confidence_matrix(crosstab: DataFrame) -> DataFrame:
    """crosstab with ratio: share of true ones; null for empty cells."""
    total = F.col("n_true") + F.col("n_false")
    return crosstab.withColumn("ratio", F.when(total > 0, F.col("n_true") / total))


def interpolated(value: str, keys: list[str], ends: bool) -> Column:
    """Gaps of `value` along bin: linear inside, the last value behind; before the first one null, or with `ends` the first value."""
    own = Window.partitionBy(*keys).orderBy("bin") if keys else Window.orderBy("bin")
    back, ahead = own.rowsBetween(Window.unboundedPreceding, 0), own.rowsBetween(0, Window.unboundedFollowing)
    at = F.when(F.col(value).isNotNull(), F.col("bin"))
    y0, x0 = F.last(value, True).over(back), F.last(at, True).over(back)
    y1, x1 = F.first(value, True).over(ahead), F.first(at, True).over(ahead)
    inside = y0 + (y1 - y0) * (F.col("bin") - x0) / (x1 - x0)
    return F.coalesce(F.col(value), inside, y0, y1) if ends else F.coalesce(F.col(value), inside, y0)


def global_confidence(crosstab: DataFrame, fill: str = "interpolate") -> DataFrame:
    """bin, confidence, weight, sum over all predictions. sum: known sequences of the bin; weight: those of all bins, the same in each row.

    fill: "interpolate" or "one" for empty bins.
    """
    sums = crosstab.groupBy("bin").agg(F.sum("n_true").alias("t"), F.sum(F.col("n_true") + F.col("n_false")).alias("sum"))
    raw = sums.withColumns({"ratio": F.when(F.col("sum") > 0, F.col("t") / F.col("sum")), "weight": F.sum("sum").over(Window.partitionBy())})  # BINS rows
    value = {"interpolate": interpolated("ratio", [], False), "one": F.coalesce("ratio", F.lit(1.0))}[fill]
    return raw.select("bin", value.alias("confidence"), "weight", "sum")


def impute_confidence(matrix: DataFrame) -> DataFrame:
    """prediction, bin, ratio with gaps filled inside and at both ends; predictions without any ratio go."""
    return matrix.withColumn("ratio", interpolated("ratio", ["prediction"], True)).where("ratio IS NOT NULL").select("prediction", "bin", "ratio")


def merge_confidence(current: DataFrame, prior: DataFrame | None = None, modifier: float = 1.0) -> DataFrame:
    """bin, confidence, weight, sum of current upon prior, both (bin, confidence, weight, sum); without a prior, current itself.

    The current one's weight is raised by k = 1 + modifier * cw / (cw + pw), of the
    weights of all bins. Confidence is null where either side has none, and where
    neither side has any weight.
    """
    c = current.select("bin", F.col("confidence").alias("cc"), F.col("weight").alias("cw"), F.col("sum").alias("cs"))
    if prior is None:
        return c.select("bin", F.col("cc").alias("confidence"), F.col("cw").alias("weight"), F.col("cs").alias("sum"))
    p = prior.select("bin", F.col("confidence").alias("pc"), F.col("weight").alias("pw"), F.col("sum").alias("ps"))
    raised = F.col("cw") * (1 + F.lit(modifier) * F.col("cw") / (F.col("cw") + F.col("pw")))
    merged = F.when(F.col("cw") + F.col("pw") > 0, (F.col("pc") * F.col("pw") + F.col("cc") * raised) / (F.col("pw") + raised))
    return c.join(p, "bin").select("bin", merged.alias("confidence"), (F.col("pw") + F.col("cw")).alias("weight"), (F.col("ps") + F.col("cs")).alias("sum"))


def apply_annotations(seq_ids: DataFrame, counts: DataFrame, profiles: DataFrame, confidence: DataFrame | None = None) -> DataFrame:
    """apply_scores with the cosines of counts (seq_id, kmer, cnt) and profiles (annotation, kmer, cnt)."""
    return apply_scores(seq_ids, cosine_scores(counts, profiles), confidence)


def apply_scores(seq_ids: DataFrame, scores: DataFrame, confidence: DataFrame | None = None) -> DataFrame:
    """seq_id, prediction, score, delta, confidence: the best annotation of each sequence by its scores.

    delta: top minus second, in hundredths; null with fewer than two annotations.
    Sequences without a k-mer of any annotation have a null prediction and score 0.
    """
    best = predictions(scores, seq_ids.select("seq_id", F.lit(None).cast("string").alias("actual"), F.lit(False).alias("known")))
    table = confidence.select("bin", "confidence") if confidence is not None else best.sparkSession.createDataFrame([], "bin int, confidence double")
    return best.join(table, "bin", "left").select("seq_id", "prediction", F.coalesce("top", F.lit(0.0)).alias("score"), (F.col("bin") / 100).alias("delta"), "confidence")


def score_matrix(scores: DataFrame, annotations: list[str]) -> DataFrame:
    """Wide form for export: seq_id and a column per given annotation, 0 where there is no score."""
    return scores.groupBy("seq_id").pivot("annotation", annotations).agg(F.first("score")).na.fill(0.0)
