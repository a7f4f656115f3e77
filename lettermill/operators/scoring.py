"""Family scores from k-mer presence. All families and folds are keys of one job, not a job each."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lettermill.operators.packed import label_counts, score_sums
from lettermill.operators.sequences import stratified_order
from lettermill.operators.store import written


def class_probabilities(pairs: DataFrame, labels: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, label, kmer, count, probability): sequences of a label with a k-mer, and their share of the label.

    pairs: distinct (seq_id, kmer); labels: (keys, seq_id, label). Cells of count 0 have no row.
    """
    by = [*keys, "label"]
    sizes = labels.groupBy(*by).agg(F.count("*").alias("n"))
    found = pairs.join(labels, "seq_id").groupBy(*by, "kmer").agg(F.count("*").alias("count"))
    return found.join(sizes, by).select(*by, "kmer", "count", (F.col("count") / F.col("n")).alias("probability"))


def of_models(rows: DataFrame, models: DataFrame, shared: list[str]) -> DataFrame:
    """rows, once for each distinct model that agrees in the shared columns, with the model's other columns and n_labels, the number of such models.

    The models (labels, or labels and folds) are read as one value of a subquery, so
    rows stay where they are and no join multiplies them.
    """
    others = [c for c in models.columns if c not in shared]
    groups = written(models.distinct().groupBy(*shared).agg(F.collect_list(F.struct(*others)).alias("models")))
    every = groups.agg(F.collect_list(F.struct(*shared, "models"))).scalar()
    own = F.filter("__every", lambda g: F.lit(True) if not shared else reduce(Column.__and__, [g[c] == F.col(c) for c in shared]))
    met = rows.withColumn("__every", every).withColumn("__own", F.get(own, F.lit(0))["models"])
    return met.select(*rows.columns, F.size("__own").alias("n_labels"), F.explode("__own").alias("__model")).select(*rows.columns, "n_labels", *[F.col(f"__model.{c}").alias(c) for c in others])


def label_probabilities(counts: DataFrame, labels: DataFrame) -> DataFrame:
    """As class_probabilities, from counts (label, kmer, count)."""
    sizes = labels.groupBy("label").agg(F.count("*").alias("n"))
    return counts.join(sizes, "label").select("label", "kmer", "count", (F.col("count") / F.col("n")).alias("probability"))


def background_sums(sets: DataFrame, k: int, alphabet, sample: DataFrame, background: DataFrame, n: int | float = 0.25, matched: bool = False, floor: float | None = 1.0) -> tuple[DataFrame | None, DataFrame]:
    """Scores of fit_family_scores (of matched only, else None) and background_scores, from sequence_sets() of sample and background.

    Counts and sums are made group by group of packed sets, so no row is a k-mer of one
    sequence; the weights of both results are taken up in one pass.
    """
    own = written(class_scores(label_probabilities(label_counts(sets, sample, k, alphabet), sample), sample))
    other = written(class_scores(label_probabilities(label_counts(sets, background, k, alphabet), background), background))
    chosen = top_kmers(own, n, order="probability").select("label", "kmer", "score")
    used = chosen.drop("score").join(other.select(F.col("label").alias("background_label"), "kmer", "score"), "kmer")
    if matched:
        used = used.where("label = background_label")
    keys = ("side", "label", "background_label")
    used = used.select(F.lit(True).alias("side"), "label", "background_label", "kmer", "score")
    if matched:
        used = used.unionByName(chosen.select(F.lit(False).alias("side"), "label", F.lit("").alias("background_label"), "kmer", "score"))
    totals = score_sums(sets, used, keys, k, alphabet)
    # rows without a seq_id have no set
    unnamed = sample.select("seq_id").unionByName(background.select("seq_id")).where("seq_id IS NULL").limit(1)
    totals = written(totals.unionByName(of_models(unnamed, used.select(*keys), []).select(*keys, "seq_id", F.lit(0.0).alias("total"))))
    back = normed(totals.where("side").drop("side"), ("label", "background_label"), None)
    return normed(totals.where("NOT side").drop("side", "background_label"), ("label",), floor) if matched else None, back


def class_scores(probabilities: DataFrame, labels: DataFrame, keys: tuple[str, ...] = (), weight: float | None = None, neg_only: bool = False) -> DataFrame:
    """probabilities on the full grid of labels and k-mers, with score = P - w * (sum of the other labels' P).

    w: 1 / (number of labels - 1), or 1 with one label. neg_only: without the first term.
    """
    by = list(keys)
    # a k-mer's cells are one row, from which every label of its keys takes its own
    cells = probabilities.groupBy(*by, "kmer").agg(F.sum("probability").alias("all"), F.map_from_entries(F.collect_list(F.struct("label", F.struct("count", "probability")))).alias("cells"))
    full = of_models(cells, labels.select(*by, "label"), by)
    full = full.withColumn("cell", F.try_element_at("cells", F.col("label"))).withColumns({c: F.coalesce(f"cell.{c}", F.lit(0)) for c in ("count", "probability")})
    w = F.lit(weight) if weight is not None else F.when(F.col("n_labels") > 1, 1 / (F.col("n_labels") - 1)).otherwise(1.0)
    positive = F.lit(0.0) if neg_only else F.col("probability")
    return full.select(*by, "label", "kmer", "count", "probability", (positive - w * (F.col("all") - F.col("probability"))).alias("score"))


def method_scores(sample: DataFrame, background: DataFrame, method: str, weight: float = 1.0) -> DataFrame:
    """label, kmer, score by documented method from (label, kmer, probability, score) and (kmer, probability) of the background.

    default: the class score; bg_only: P - P of the background; both: the class score minus weight * P of the background.
    """
    joined = sample.join(background.select("kmer", F.col("probability").alias("bg")), "kmer", "left").na.fill(0.0, ["bg"])
    value = {"default": F.col("score"), "bg_only": F.col("probability") - F.col("bg"), "both": F.col("score") - weight * F.col("bg")}[method]
    return joined.select("label", "kmer", value.alias("score"))


def top_kmers(scores: DataFrame, n: int | float, keys: tuple[str, ...] = ("label",), order: str = "score") -> DataFrame:
    """The n best k-mers of each key (n from 1), or the share n below 1 of its k-mers, rounded down; `index` from 0, best first, equal ones by k-mer."""
    own = Window.partitionBy(*keys)
    if isinstance(n, int) and n >= 1:
        limit: Column = F.lit(n)
    elif 0 < n < 1:
        limit = F.floor(F.count("*").over(own) * n)
    else:
        raise ValueError("n must be an integer from 1, or a share below 1")
    ranked = scores.withColumns({"index": F.row_number().over(own.orderBy(F.desc(order), "kmer")) - 1, "__limit": limit})
    return ranked.where(F.col("index") < F.col("__limit")).drop("__limit")


def select_kmers(pairs: DataFrame, top: DataFrame) -> DataFrame:
    return pairs.join(top.select("kmer").distinct(), "kmer", "left_semi").select(*pairs.columns)


def sequence_scores(pairs: DataFrame, scores: DataFrame, seqs: DataFrame, keys: tuple[str, ...] = ("label",)) -> DataFrame:
    """(keys, seq_id, total): sum of the scores of the k-mers that a sequence has.

    seqs: (seq_id) and those of the keys that a sequence belongs to, such as a
    fold; the sequences that have none of the k-mers have total 0.
    """
    shared = [c for c in seqs.columns if c != "seq_id"]
    # a sequence meets the scores of its own folds only
    own = pairs.join(seqs, "seq_id") if shared else pairs
    hits = own.join(scores.select(*keys, "kmer", "score"), [*shared, "kmer"]).groupBy(*keys, "seq_id").agg(F.sum("score").alias("total"))
    # the result has a row for every sequence and model
    grid = of_models(seqs, scores.select(*keys), shared).select(*keys, "seq_id", F.lit(0.0).alias("total"))
    return grid.unionByName(hits).groupBy(*keys, "seq_id").agg(F.sum("total").alias("total"))


def normed(totals: DataFrame, keys: tuple[str, ...], floor: float | None) -> DataFrame:
    """totals (keys, seq_id, total) with norm, the largest total of the keys and at least `floor`, and score = total / norm."""
    best = totals.groupBy(*keys).agg(F.max("total").alias("best"))
    norm = F.greatest(F.col("best"), F.lit(floor)) if floor is not None else F.col("best")
    scored = totals.join(best, list(keys)).withColumn("norm", norm)
    return scored.select(*keys, "seq_id", "total", "norm", F.when(F.col("norm") != 0, F.col("total") / F.col("norm")).otherwise(0.0).alias("score"))


def fit_family_scores(pairs: DataFrame, labels: DataFrame, n: int | float = 0.25, floor: float | None = 1.0, others: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Weights (label, kmer, score), and scored sequences (label, seq_id, total, norm, score).

    Each label's k-mers are chosen by its probability; all sequences, those of
    `others` (seq_id, such as background) too, are scored with them and divided
    by norm: the largest total, at least `floor`.
    """
    weights = class_scores(class_probabilities(pairs, labels), labels)
    rows = labels.select("seq_id") if others is None else labels.select("seq_id").unionByName(others.select("seq_id"))
    totals = sequence_scores(pairs, top_kmers(weights, n, order="probability"), rows)
    return weights.select("label", "kmer", "score"), normed(totals, ("label",), floor)


def background_scores(pairs: DataFrame, sample: DataFrame, background: DataFrame, n: int | float = 0.25, matched: bool = False) -> DataFrame:
    """label, background_label, seq_id, total, norm, score: all sequences, of sample and background (seq_id, label), by the background's class scores.

    Only the k-mers count that the sample's label chooses by its own probability;
    totals are divided by the largest one as it is. matched: only the pairs of equal
    labels, which are all that combine_background() uses.
    """
    chosen = top_kmers(class_scores(class_probabilities(pairs, sample), sample), n, order="probability").select("label", "kmer")
    scores = class_scores(class_probabilities(pairs, background), background).select(F.col("label").alias("background_label"), "kmer", "score")
    keys = ("label", "background_label")
    used = chosen.join(scores, "kmer")
    if matched:
        used = used.where("label = background_label")
    return normed(sequence_scores(pairs, used, sample.select("seq_id").unionByName(background.select("seq_id")), keys), keys, None)


def combine_background(scores: DataFrame, background: DataFrame) -> DataFrame:
    """label, seq_id, score, weighted = s (1 - b), subtracted = s - b of the labels that the background has too.

    scores: (label, seq_id, score) of fit_family_scores with the background as
    others; background: the result of background_scores.
    """
    b = background.where("label = background_label").select("label", "seq_id", F.col("score").alias("b"))
    return scores.join(b, ["label", "seq_id"]).select("label", "seq_id", "score", (F.col("score") * (1 - F.col("b"))).alias("weighted"), (F.col("score") - F.col("b")).alias("subtracted"))


def score_new(pairs: DataFrame, weights: DataFrame, norms: DataFrame, seqs: DataFrame) -> DataFrame:
    """label, seq_id, score of new sequences: all weights, not only the chosen ones, by the norm of the fit (label, norm)."""
    return sequence_scores(pairs, weights, seqs.select("seq_id")).join(norms.select("label", "norm").distinct(), "label").select("label", "seq_id", (F.col("total") / F.col("norm")).alias("score"))


def family_weights(weights: DataFrame, background: DataFrame) -> DataFrame:
    """label, kmer, sample, background: both sides' scores, 0 where one lacks the k-mer."""
    a, b = weights.select("label", "kmer", F.col("score").alias("sample")), background.select("label", "kmer", F.col("score").alias("background"))
    return a.join(b, ["label", "kmer"], "full").na.fill(0.0, ["sample", "background"])


def stratified_folds(df: DataFrame, label_col: str, k: int, seed: int = 0) -> DataFrame:
    """df with fold 1 to k: within each label, shuffled rows are dealt in turn."""
    return stratified_order(df, [label_col], seed, name="__place").select(*df.columns, (F.col("__place") % k + 1).cast("int").alias("fold"))


def hashed_folds(df: DataFrame, k: int, seed: int = 0) -> DataFrame:
    """df with fold 1 to k by hash of seq_id; no shuffle, sizes only about equal."""
    return df.withColumn("fold", F.pmod(F.xxhash64(F.lit(seed), "seq_id"), F.lit(k)).cast("int") + 1)


def fold_flags(folded: DataFrame, k: int) -> DataFrame:
    """folded with train_cv-01 .. train_cv-k: whether a row trains fold i."""
    return folded.withColumns({f"train_cv-{i:02}": F.col("fold") != i for i in range(1, k + 1)})


def stratified_split(df: DataFrame, label_col: str, test_share: float = 0.25, seed: int = 0) -> DataFrame:
    """df with train: false for the share (rounded) of each label's shuffled rows."""
    return stratified_order(df, [label_col], seed, name="__place").select(*df.columns, (F.col("__place") >= F.round(F.col("__place_total") * test_share)).alias("train"))


def cv_scores(pairs: DataFrame, labels: DataFrame, k: int, n: int | float = 0.25, seed: int = 0) -> DataFrame:
    """fold, label, seq_id, train, in_family, score: per fold, weights and norms from the training rows, applied to all rows.

    Training rows are scored with the chosen k-mers, the others with all. K-mers
    are counted once per label and fold; what trains a fold is the total less the
    fold's own. Scores of all folds of a k-mer and label are one row, so each
    (seq_id, kmer) meets each label once.
    """
    folded = written(stratified_folds(labels.select("seq_id", "label"), "label", k, seed).withColumnRenamed("fold", "own"))
    every = F.sequence(F.lit(1), F.lit(k))
    cells = written(pairs.join(folded, "seq_id").groupBy("label", "kmer", "own").agg(F.count("*").alias("c")))
    sizes = folded.groupBy("label", "own").agg(F.count("*").alias("c"))

    def training(counts: DataFrame, by: list[str]) -> DataFrame:
        """(fold, by, count): of all folds but the one."""
        rows = counts.withColumn("fold", F.explode(F.filter(every, lambda f: f != F.col("own"))))
        return rows.groupBy("fold", *by).agg(F.sum("c").alias("count"))

    n_train = training(sizes, ["label"])
    probabilities = training(cells, ["label", "kmer"]).join(n_train.withColumnRenamed("count", "n"), ["fold", "label"])
    probabilities = probabilities.select("fold", "label", "kmer", "count", (F.col("count") / F.col("n")).alias("probability"))
    weights = written(class_scores(probabilities, n_train.select("fold", "label"), ("fold",)))
    top = top_kmers(weights, n, ("fold", "label"), "probability").select("fold", "label", "kmer", F.lit(True).alias("chosen"))
    marked = weights.join(top, ["fold", "label", "kmer"], "left").select("fold", "label", "kmer", "score", F.when(F.col("chosen"), F.col("score")).alias("top"))
    at = lambda c, f: F.max(F.when(F.col("fold") == f, F.col(c)))
    wide = written(marked.groupBy("label", "kmer").agg(*[at(c, f).alias(f"{c}{f}") for c in ("score", "top") for f in range(1, k + 1)]))
    met = pairs.join(folded.select("seq_id", "own"), "seq_id").join(wide, "kmer")
    totals = met.groupBy("seq_id", "own", "label").agg(*[F.sum(F.when(F.col("own") == f, F.col(f"score{f}")).otherwise(F.col(f"top{f}"))).alias(f"t{f}") for f in range(1, k + 1)])
    hits = totals.select("seq_id", "label", F.posexplode(F.array(*[f"t{f}" for f in range(1, k + 1)])).alias("f", "total")).withColumn("fold", F.col("f") + 1)
    # the result has a row for every sequence, label and fold
    models = written(n_train.select("fold", "label"))
    grid = folded.select("seq_id", F.col("label").alias("family"), "own").withColumn("fold", F.explode(every)).join(models, "fold")
    scored = written(grid.join(hits.select("fold", "label", "seq_id", "total"), ["fold", "label", "seq_id"], "left").withColumn("total", F.coalesce("total", F.lit(0.0))))
    norms = scored.where("own <> fold").groupBy("fold", "label").agg(F.greatest(F.max("total"), F.lit(1.0)).alias("norm"))
    return scored.join(norms, ["fold", "label"]).select("fold", "label", "seq_id", (F.col("own") != F.col("fold")).alias("train"), (F.col("family") == F.col("label")).cast("int").alias("in_family"), (F.col("total") / F.col("norm")).alias("score"))


def score_distribution(scores: DataFrame, by: tuple[str, ...] = ("label",)) -> DataFrame:
    """(by), n, min, q1, median, q3, max of score."""
    q = lambda p: F.percentile("score", F.lit(p))
    return scores.groupBy(*by).agg(F.count("*").alias("n"), F.min("score").alias("min"), q(0.25).alias("q1"), q(0.5).alias("median"), q(0.75).alias("q3"), F.max("score").alias("max"))
