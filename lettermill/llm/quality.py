"""Ordinal cumulative-link regression of graded ratings on hashed text."""

import math
import operator
import typing
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Hash buckets of words and their beginnings and, behind them, of word shapes.
WORDS, SHAPES = 1 << 18, 1 << 10
#: Bytes of the beginning of a longer word; inflected and compound forms of a rare stem share it.
BEGINNING = 6
#: Bucket of the share of words that repeat the word before them.
REPEATS = WORDS + SHAPES
#: ASCII marks, which don't belong to a word.
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
#: Bound of the labelled rows that are fitted on.
MAX_TRAIN = 8000
#: Features that a step of the fit works on at once.
BLOCK = 100_000
#: A document stays when its tail probability of the best grade reaches this.
KEEP_FROM = 0.5


@dataclass
class OrdinalModel:
    """P(grade <= k) = sigmoid(thresholds[k] - score); score: the sum of weights times Features of a text."""

    weights: np.ndarray
    thresholds: np.ndarray


def word_bucket(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word.lower().strip(MARKS)) % WORDS


def beginnings(words: Iterable[bytes]) -> set[bytes]:
    """Distinct first BEGINNING bytes of the longer ones of lower-cased words without marks."""
    return {w[:BEGINNING] for w in words if len(w) > BEGINNING}


def beginning_bucket(beginning: bytes) -> int:
    return xxhash.xxh3_64_intdigest(b"^" + beginning) % WORDS


def shape_bucket(word: bytes) -> int:
    """Shape: what stands before and behind the letters and digits, and the word's case and length class."""
    core = word.strip(MARKS)
    at = word.find(core) if core else len(word)
    case = b"U" if core.isupper() and len(core) > 1 else b"D" if core.isdigit() else b"l"
    return WORDS + xxhash.xxh3_64_intdigest(b"|".join([word[:at][:4], case, b"%d" % min(len(core), 12), word[at + len(core) :][:4]])) % SHAPES


class Features(dict):
    """Sparse features of texts, the same for fit and score. As a dict: buckets of each word that was seen (its own and its shape's), up to `bound` words."""

    def __init__(self, bound: int = 400_000):
        super().__init__()
        self.bound, self.starts = bound, {}

    def __missing__(self, word: bytes) -> tuple[int, int]:
        found = self[word] = word_bucket(word), shape_bucket(word)
        return found

    def of(self, text: bytes) -> dict[int, float]:
        """Values by bucket: 1 for each bucket of a word or of a beginning, however many words fall into it, and for each shape ten times its share of the words, likewise for repeats."""
        words = text.split()
        if not words:
            return {}
        if len(self) > self.bound:
            self.clear()
            self.starts.clear()
        counts = Counter(words)
        found = dict.fromkeys([self[w][0] for w in counts], 1.0)
        for b in beginnings({w.lower().strip(MARKS) for w in counts}):
            bucket = self.starts.get(b)
            if bucket is None:
                bucket = self.starts[b] = beginning_bucket(b)
            found[bucket] = 1.0
        step, shapes = 10 / len(words), Counter()
        for w, n in counts.items():
            shapes[self[w][1]] += n
        for s, n in shapes.items():
            found[s] = step * n
        found[REPEATS] = step * sum(map(operator.eq, words, words[1:]))
        return found


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(lengths: np.ndarray, at: np.ndarray, value: np.ndarray, grade: np.ndarray, n_grades: int, steps: int = 250, l2: float = 1e-3, min_docs: int = 5, balance: float = 0.5) -> OrdinalModel:
    """Full-batch Adam on the log likelihood. Rows have `lengths` features each, of buckets `at` and values `value`. Buckets of fewer than min_docs rows get no weight.
    A row counts by the power -balance of the number of rows of its grade."""
    weights = np.zeros(WORDS + SHAPES + 1)
    thresholds = np.linspace(-1.0, 1.0, n_grades - 1) if n_grades > 2 else np.zeros(1)
    if not len(lengths):
        return OrdinalModel(weights, thresholds)
    ends = np.cumsum(lengths)
    # rows of about BLOCK features at a time, so that the steps need no array of the length of all features
    edges = np.unique(np.concatenate([[0], np.searchsorted(ends, np.arange(BLOCK, ends[-1], BLOCK)), [len(lengths)]]))
    blocks = [(i, j, slice(ends[i] - lengths[i], ends[j - 1])) for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    seen = sum(np.bincount(at[own], minlength=len(weights)) for _, _, own in blocks)
    used = np.flatnonzero(seen >= min_docs)
    x = np.concatenate([np.zeros(len(used)), [thresholds[0]], np.log(np.diff(thresholds))])
    first, second = np.zeros_like(x), np.zeros_like(x)
    n, k = len(lengths), n_grades - 1
    share = (1 / np.bincount(grade)[grade]) ** balance
    share /= share.sum()
    score, by_weight = np.empty(n), np.empty_like(weights)
    for step in range(1, steps + 1):
        w, cuts = x[: len(used)], x[len(used)] + np.concatenate([[0], np.cumsum(np.exp(x[len(used) + 1 :]))])
        weights[used] = w
        for i, j, own in blocks:
            score[i:j] = np.bincount(np.repeat(np.arange(j - i), lengths[i:j]), np.take(weights, at[own].astype(np.intp), mode="clip") * value[own], minlength=j - i)
        below = np.where(grade > 0, sigmoid(cuts[np.maximum(grade - 1, 0)] - score), 0.0)
        upto = np.where(grade < k, sigmoid(cuts[np.minimum(grade, k - 1)] - score), 1.0)
        by_score = share * (1 - below - upto)
        p = np.maximum(upto - below, 1e-12)
        by_cut = np.bincount(np.minimum(grade, k - 1), np.where(grade < k, -share * upto * (1 - upto) / p, 0), minlength=k) + np.bincount(np.maximum(grade - 1, 0), np.where(grade > 0, share * below * (1 - below) / p, 0), minlength=k)
        tail = np.cumsum(by_cut[::-1])[::-1]
        by_weight[:] = 0
        for i, j, own in blocks:
            np.add.at(by_weight, at[own], np.repeat(by_score[i:j], lengths[i:j]) * value[own])
        slope = np.concatenate([by_weight[used] + l2 * w, [tail[0]], tail[1:] * np.exp(x[len(used) + 1 :])])
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        x = x - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
    weights[used] = x[: len(used)]
    return OrdinalModel(weights, x[len(used)] + np.concatenate([[0], np.cumsum(np.exp(x[len(used) + 1 :]))]))


def fit_quality(docs: DataFrame, ratings: DataFrame, n_grades: int, max_train: int = MAX_TRAIN, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """Fits on at most `max_train` rated documents, those of the smallest hash of their id; of rows that repeat an id the smallest text counts. `ratings`: id, grade from 0 (worst);
    rows with a null or unknown grade are ignored. Only sparse features of these rows reach the driver."""
    ids = ratings.select(F.col(id_col).alias("__id"), F.col("grade").cast("int").alias("grade")).where(F.col("__id").isNotNull() & F.col("grade").between(0, n_grades - 1))
    drawn = ids.groupBy("__id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("__id"), "__id").limit(max_train)
    met = docs.join(F.broadcast(drawn), F.col(id_col) == F.col("__id")).select(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"), "grade", "__id")
    rated = met.groupBy("__id", "grade").agg(F.min("text").alias("text")).select("text", "grade", "__id")

    def extract(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = Features()
        for batch in batches:
            found = [sorted(own.of(t).items()) for t in batch.column(0).to_pylist()]
            # the buckets of words all have the value 1
            yield pa.RecordBatch.from_arrays([pa.array([[x for x, _ in f] for f in found], pa.list_(pa.int32())), pa.array([[y for x, y in f if x >= WORDS] for f in found], pa.list_(pa.float64())), batch.column(1).cast(pa.int32()), batch.column(2).cast(pa.int64())], names=["at", "value", "grade", "id"])

    rows = rated.mapInArrow(extract, "at array<int>, value array<double>, grade int, id long").toArrow()
    if not rows.num_rows:
        return fit_ordinal(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0), np.zeros(0, np.int64), n_grades)
    order = np.argsort(rows["id"].to_numpy(), kind="stable")
    grade, ats, values = rows["grade"].to_numpy()[order], pa_lists(rows["at"]), pa_lists(rows["value"])
    lengths = np.array([len(ats[i]) for i in order])
    at = np.concatenate([ats[i] for i in order])
    value = np.ones(len(at))
    value[at >= WORDS] = np.concatenate([values[i] for i in order])
    # the model needs none of the collected rows any more
    del rows, ats, values
    return fit_ordinal(lengths, at, value, grade, n_grades)


def pa_lists(column) -> list[np.ndarray]:
    """The items of each row of a list column, not copied."""
    out = []
    for c in column.chunks:
        items, edges = c.values.to_numpy(), c.offsets.to_numpy()
        out += [items[i:j] for i, j in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)]
    return out


def score_column(spark: SparkSession, text: Column, model: OrdinalModel) -> Column:
    """The model's score of a text as a column; the weights (2 MB, fixed) are broadcast."""
    shared = spark.sparkContext.broadcast(model.weights)

    @F.pandas_udf("double")
    def score(batches: typing.Iterator[pd.Series]) -> typing.Iterator[pd.Series]:
        weights, own = shared.value.tolist(), Features()
        for batch in batches:
            # fsum: the order of the features makes no difference
            yield pd.Series([math.fsum([weights[x] * y for x, y in own.of(text).items()]) for text in batch], dtype="float64")

    return score(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


NAMES = ("score", "expected_grade", "tail_probability", "keep")


def free_prefix(columns: list[str], prefix: str = "") -> str:
    """prefix, with as many underscores ahead as keep NAMES behind it apart from the columns (names differ in more than case)."""
    taken = {c.lower() for c in columns}
    while any(prefix.lower() + n in taken for n in NAMES):
        prefix = "_" + prefix
    return prefix


def score_quality(docs: DataFrame, model: OrdinalModel, text_col: str = "text", keep_from: float = KEEP_FROM, prefix: str = "") -> DataFrame:
    """docs with columns score, expected_grade, tail_probability (of the best grade) and keep, whose names get `prefix`.

    Null and empty texts have no words: their score is 0. Every row stays and
    all columns of docs; where a name is taken, the prefix is free_prefix().
    """
    p = free_prefix(docs.columns, prefix)
    scored = docs.withColumn(f"{p}score", score_column(docs.sparkSession, F.col(text_col), model))
    above = [1 / (1 + F.exp(F.lit(float(t)) - F.col(f"{p}score"))) for t in model.thresholds]
    return scored.withColumns({f"{p}expected_grade": sum(above[1:], above[0]), f"{p}tail_probability": above[-1]}).withColumn(f"{p}keep", F.col(f"{p}tail_probability") >= keep_from)


def quality_grades(labels: DataFrame) -> DataFrame:
    """Grades of labels(doc_id, quality, toxic): 0 toxic, 1 of low quality, 2 good; null flags count as 0."""
    return labels.select("doc_id", F.when(F.coalesce("toxic", F.lit(0)) == 1, 0).when(F.coalesce("quality", F.lit(0)) == 0, 1).otherwise(2).alias("grade"))
