"""Recursive elimination ends by its own condition."""

import inspect

from pyspark.sql import functions as F

from lettermill.operators import motif
from lettermill.plans.queries import QUERIES


def test_elimination_goes_on_until_no_weight_is_below_stop(spark, monkeypatch):
    # each fit gives the last k-mer a low weight, as long as more than two are left
    def weights(pairs, labels, family):
        left = sorted(r.kmer for r in pairs.select("kmer").distinct().collect())
        return spark.createDataFrame([(k, -1.0 if k == left[-1] and len(left) > 2 else 1.0) for k in left], "kmer string, weight double")

    monkeypatch.setattr(motif, "svm_weights", weights)
    pairs = spark.createDataFrame([("s", f"k{i:02d}") for i in range(25)], "seq_id string, kmer string")
    got = motif.eliminate_features(pairs, pairs.select("seq_id"), "f")
    assert got.where(F.col("weight") < -0.2).isEmpty() and got.count() == 2


def test_the_query_has_no_bound_on_rounds():
    assert "rounds=" not in inspect.getsource(QUERIES["feature_elimination"])
