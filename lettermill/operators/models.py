"""Classifiers of families and their evaluation."""

from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LinearSVC, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lettermill.operators.store import running, written

CLASSIFIERS = {
    "decisiontree": DecisionTreeClassifier,
    "randomforest": RandomForestClassifier,
    "boosting": GBTClassifier,
    "logistic": LogisticRegression,
    "svc": LinearSVC,
}


def make_classifier(name: str, **params):
    """MLlib classifier on `features` and `label`; ValueError for an unknown name."""
    if name not in CLASSIFIERS:
        raise ValueError(f"classifier must be one of {', '.join(CLASSIFIERS)}")
    return CLASSIFIERS[name](**params)


def balanced_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    """df with weight: rows / (labels * rows of the label)."""
    sizes = df.groupBy(label_col).agg(F.count("*").alias("n"))  # a row per label
    return df.join(sizes.select(label_col, (F.sum("n").over(Window.partitionBy()) / (F.count("*").over(Window.partitionBy()) * F.col("n"))).alias("weight")), label_col)


def fit_family_models(scores: DataFrame, c: float = 1.0, steps: int = 30, tol: float = 1e-10) -> DataFrame:
    """label, w, b: per label a logistic regression of in_family on score, with penalty w^2 / (2 c) and a free offset.

    Newton's method for all labels at once: a step is one grouped sum over the
    rows, and five numbers per label reach the driver. Labels of one class only
    have no finite offset; they keep what the last step gave.
    """
    spark = scores.sparkSession
    rows = written(scores.select("label", F.col("score").alias("x"), F.col("in_family").cast("double").alias("y")))
    at = {r.label: (0.0, 0.0) for r in rows.select("label").distinct().collect()}
    open_ = set(at)
    for _ in range(steps):
        if not open_:
            break
        now = spark.createDataFrame([(k, *at[k]) for k in sorted(open_)], "label string, w double, b double")
        p = 1 / (1 + F.exp(-(F.col("w") * F.col("x") + F.col("b"))))
        met = rows.join(now, "label").select("label", "x", (p - F.col("y")).alias("e"), (p * (1 - p)).alias("h"))
        sums = met.groupBy("label").agg(F.sum(F.col("e") * F.col("x")).alias("gw"), F.sum("e").alias("gb"), F.sum(F.col("h") * F.col("x") * F.col("x")).alias("ww"), F.sum(F.col("h") * F.col("x")).alias("wb"), F.sum("h").alias("bb"))
        for r in sums.collect():
            w, b = at[r.label]
            gw, gb, ww, wb, bb = w + c * r.gw, c * r.gb, 1 + c * r.ww, c * r.wb, c * r.bb
            det = ww * bb - wb * wb
            if det <= 1e-300:
                open_.discard(r.label)
                continue
            dw, db = (bb * gw - wb * gb) / det, (ww * gb - wb * gw) / det
            at[r.label] = w - dw, b - db
            if max(abs(dw), abs(db)) < tol:
                open_.discard(r.label)
    return spark.createDataFrame([(k, *v) for k, v in sorted(at.items())], "label string, w double, b double")


def predict_families(scores: DataFrame, params: DataFrame) -> DataFrame:
    """scores (label, seq_id, score and any others) with probability and in_family by (label, w, b)."""
    p = 1 / (1 + F.exp(-(F.col("w") * F.col("score") + F.col("b"))))
    return scores.join(params, "label").withColumn("probability", p).withColumn("in_family", F.col("probability") > 0.5).drop("w", "b")


def search_results(model: CrossValidatorModel, spark: SparkSession) -> DataFrame:
    """params, score, best: the mean score of each point of the grid, and which is the best (the first of equal ones)."""
    rows = [(", ".join(f"{k.name}={v}" for k, v in sorted(p.items(), key=lambda x: x[0].name)), float(s)) for p, s in zip(model.getEstimatorParamMaps(), model.avgMetrics, strict=True)]
    best = max(range(len(rows)), key=lambda i: rows[i][1])
    return spark.createDataFrame([(*r, i == best) for i, r in enumerate(rows)], "params string, score double, best boolean")


def held_out_accuracy(scores: DataFrame, names: tuple[str, ...] = tuple(CLASSIFIERS), **params) -> DataFrame:
    """classifier, fold, n, accuracy of each kind of classifier on the rows that it was not fitted on.

    scores: fold, train, in_family and features; a fold's classifier is fitted on its
    training rows in the order of seq_id, so the dealing of rows does not matter.
    """
    rows = written(scores.withColumn("label", F.col("in_family").cast("double")))
    folds = [r.fold for r in rows.select("fold").distinct().orderBy("fold").collect()]
    fitted = {f: written(rows.where((F.col("fold") == f) & F.col("train")).repartitionByRange("seq_id").sortWithinPartitions("seq_id")) for f in folds}

    def held_out(task: tuple) -> DataFrame:
        fold, name = task
        guessed = make_classifier(name, **params.get(name, {})).fit(fitted[fold]).transform(rows.where((F.col("fold") == fold) & ~F.col("train")))
        right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
        return guessed.agg(F.count("*").alias("n"), right.alias("accuracy")).select(F.lit(name).alias("classifier"), F.lit(fold).alias("fold"), "n", "accuracy")

    # fits are jobs that wait for each other's steps only; several share the cluster
    with ThreadPool(4) as pool:
        return reduce(DataFrame.unionByName, pool.map(held_out, [(f, n) for f in folds for n in names]))


def grid_search(df: DataFrame, classifier: str = "decisiontree", depths: tuple[int, ...] = (2, 4, 8), leaves: tuple[int, ...] = (1, 5), folds: int = 3, seed: int = 0, fold_col: str | None = None) -> CrossValidatorModel:
    """Cross-validated search over depth and rows per leaf by area under ROC; df: features, label and, where given, fold_col with the fold of each row from 0, so that the dealing of rows does not matter."""
    model = make_classifier(classifier)
    grid = ParamGridBuilder().addGrid(model.maxDepth, depths).addGrid(model.minInstancesPerNode, leaves).build()
    return CrossValidator(estimator=model, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(), numFolds=folds, seed=seed, parallelism=2, foldCol=fold_col or "").fit(df)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def accuracy(predicted: DataFrame, by: tuple[str, ...] = (), truth: str = "actual", guess: str = "prediction") -> DataFrame:
    """(by), accuracy: share of rows whose prediction is the truth; a null prediction is wrong."""
    return predicted.groupBy(*by).agg(F.avg(F.coalesce((F.col(truth) == F.col(guess)).cast("double"), F.lit(0.0))).alias("accuracy"))


def _thresholds(scores: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(by), score, with counts of positives and negatives at the score, cumulated from the highest score on, and of all. Equal scores are one row; the scores of one label are spread over tasks."""
    cells = written(scores.groupBy(*by, "score").agg(F.sum("in_family").alias("pos"), F.sum(1 - F.col("in_family")).alias("neg")))
    summed = running(cells, list(by), ["score"], {"tp": F.col("pos"), "fp": F.col("neg")}, descending=True, totals=True)
    return summed.withColumnsRenamed({"tp_total": "p", "fp_total": "n"})


def roc_auc(scores: DataFrame, by: tuple[str, ...] = ("label", "fold")) -> DataFrame:
    """(by), auc: exact area under ROC, ties counting half; null with one class only."""
    t = _thresholds(scores, by)
    doubled = F.sum(F.col("pos") * (2 * (F.col("n") - F.col("fp")) + F.col("neg")))
    return t.groupBy(*by).agg(doubled.alias("u"), F.max("p").alias("p"), F.max("n").alias("n")).select(*by, F.when(F.col("p") * F.col("n") > 0, F.col("u") / (2 * F.col("p") * F.col("n"))).alias("auc"))


def average_precision(scores: DataFrame, by: tuple[str, ...] = ("label", "fold")) -> DataFrame:
    """(by), average_precision: sum of recall steps times precision over distinct thresholds; null without positives."""
    t = _thresholds(scores, by)
    return t.groupBy(*by).agg(F.sum(F.col("pos") * F.col("tp") / (F.col("tp") + F.col("fp"))).alias("s"), F.max("p").alias("p")).select(*by, F.when(F.col("p") > 0, F.col("s") / F.col("p")).alias("average_precision"))


def pr_curve(scores: DataFrame, by: tuple[str, ...] = ("label",)) -> DataFrame:
    """(by), score, recall, precision at each distinct threshold, folds pooled."""
    return _thresholds(scores, by).where("p > 0").select(*by, "score", (F.col("tp") / F.col("p")).alias("recall"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"))


def roc_curve(scores: DataFrame, by: tuple[str, ...] = ("label", "fold"), points: int = 100) -> DataFrame:
    """(by), i, fpr, tpr on an even grid of false positive rates, linear between thresholds; tpr is 0 at 0."""
    t = _thresholds(scores, by).where("p > 0 AND n > 0")
    x, y = F.col("fp") / F.col("n"), F.col("tp") / F.col("p")
    # what the threshold before had is what this one has without its own rows
    segments = t.select(*by, x.alias("x1"), y.alias("y1"), ((F.col("fp") - F.col("neg")) / F.col("n")).alias("x0"), ((F.col("tp") - F.col("pos")) / F.col("p")).alias("y0"))
    # a grid point lies on the first segment that reaches beyond it; each segment makes its own points
    first, last = F.ceil(F.col("x0") * (points - 1) - 1e-9), F.ceil(F.col("x1") * (points - 1) - 1e-9) - 1
    last = F.when(F.col("x1") == 1, F.lit(points - 1)).otherwise(last)
    own = segments.where(F.col("x1") > F.col("x0")).withColumn("i", F.explode(F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))))
    g = F.col("i") / (points - 1)
    tpr = F.col("y0") + (F.col("y1") - F.col("y0")) * (g - F.col("x0")) / (F.col("x1") - F.col("x0"))
    return own.select(*by, "i", g.alias("fpr"), F.when(F.col("i") == 0, 0.0).otherwise(tpr).alias("tpr"))


def mean_roc(curves: DataFrame, by: tuple[str, ...] = ("label",)) -> DataFrame:
    """(by), i, fpr, tpr, low, high: mean over folds and one standard deviation around it, within 0 and 1."""
    rows = curves.groupBy(*by, "i", "fpr").agg(F.avg("tpr").alias("tpr"), F.stddev_pop("tpr").alias("sd"))
    return rows.select(*by, "i", "fpr", "tpr", F.greatest(F.col("tpr") - F.col("sd"), F.lit(0.0)).alias("low"), F.least(F.col("tpr") + F.col("sd"), F.lit(1.0)).alias("high"))


def cv_results(scores: DataFrame, alphabet: str, k: int) -> DataFrame:
    """label, alphabet_name, k, scoring, score, cv_split for auc_roc and pr_auc."""
    parts = [(roc_auc(scores), "auc", "auc_roc"), (average_precision(scores), "average_precision", "pr_auc")]
    rows = [df.select("label", F.lit(alphabet).alias("alphabet_name"), F.lit(k).alias("k"), F.lit(name).alias("scoring"), F.col(c).alias("score"), F.col("fold").alias("cv_split")) for df, c, name in parts]
    return rows[0].unionByName(rows[1])
