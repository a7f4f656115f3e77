"""Rejected share of toxic rows per language, on rows that were not fitted on."""

import os
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettermill.llm import quality

FOLDER = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
def test_toxic_rows_of_other_languages_go(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    grades = quality.quality_grades(labels)
    model = quality.fit_quality(docs, grades.where("doc_id % 5 <> 0"), 3)
    held = quality.score_quality(docs.join(grades.where("doc_id % 5 = 0"), "doc_id"), model)
    kept = {(r.lang, r.grade): (r.k, r.n) for r in held.groupBy("lang", "grade").agg(F.sum(F.col("keep").cast("int")).alias("k"), F.count("*").alias("n")).collect()}
    share = {key: k / n for key, (k, n) in kept.items()}
    assert share["en", 0] == 0 and share["fr", 0] < 0.3 and share["de", 0] < 0.3 and share["es", 0] < 0.6
    assert all(s > 0.95 for (_, grade), s in share.items() if grade == 2)


def test_scores_are_the_weighted_features(spark):
    rng = np.random.default_rng(1)
    model = quality.OrdinalModel(rng.normal(size=quality.REPEATS + 1), np.zeros(2))
    texts = ["", "Wonderful wonderful, wonderfully made made", "réeuxment réeuxvi short"]
    got = [r.score for r in quality.score_quality(spark.createDataFrame([(t,) for t in texts], "text string"), model).collect()]
    for text, score in zip(texts, got, strict=True):
        found = quality.Features().of(text.encode())
        assert score == pytest.approx(sum(model.weights[a] * v for a, v in found.items()), abs=1e-9)


def test_a_fit_takes_little_memory_besides_its_features(monkeypatch):
    rng = np.random.default_rng(3)
    lengths, grade = rng.integers(0, 600, 6000), rng.integers(0, 3, 6000)
    at = np.minimum(rng.pareto(0.6, lengths.sum()) * 30, quality.REPEATS).astype(np.int32)
    value = np.where(at >= quality.WORDS, rng.random(len(at)), 1.0)
    tracemalloc.start()
    model = quality.fit_ordinal(lengths, at, value, grade, 3, steps=3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < value.nbytes
    # whatever the blocks, sums run in the same order
    monkeypatch.setattr(quality, "BLOCK", 700)
    other = quality.fit_ordinal(lengths, at, value, grade, 3, steps=3)
    assert (other.weights == model.weights).all() and (other.thresholds == model.thresholds).all() and model.weights.any()


def test_collected_lists_are_what_was_sent():
    import pyarrow as pa

    column = pa.chunked_array([pa.array([[1, 2], [], [3]], pa.list_(pa.int32())), pa.array([], pa.list_(pa.int32())), pa.array([[9], [4, 5, 6], [7]], pa.list_(pa.int32())).slice(1)])
    assert [x.tolist() for x in quality.pa_lists(column)] == [[1, 2], [], [3], [4, 5, 6], [7]]
