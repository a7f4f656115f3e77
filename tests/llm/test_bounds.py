"""Bounds that hold whatever repeats: training draws, groups, links of repeated ids, rated rows."""

import random

from pyspark.sql import functions as F

from lettermill.llm import neardup, packing, pii, quality
from lettermill.llm.common import WordHashes
from lettermill.llm.neardup import drop_near_copies, jaccard_components

PROSE = "the quiet harbour lay under a thin fog while boats drifted past the old lighthouse and nobody on the pier said a single word about the storm"


def test_a_hot_text_is_drawn_once(spark):
    rows = [(i, "one hot text of many copies" if i % 3 == 0 else f"document number {i} with words of its own") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # whatever the seed draws, copies count once; some forty distinct texts give some hundreds of rows
    sizes = [pii.training_rows(docs, 40, seed).count() for seed in range(4)]
    assert max(sizes) < 1500


def test_pieces_with_null_ids_are_many_groups(spark):
    pieces = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), (F.col("id") % 50 + 1).alias("length"))
    placed = packing.place_pieces(pieces, 64, group_pieces=300)
    groups = placed.select(F.shiftright("sequence_id", 40).alias("g")).groupBy("g").count().collect()
    assert len(groups) == 10 and max(r["count"] for r in groups) < 600 and sum(r["count"] for r in groups) == 3000


def test_a_repeated_id_links_with_each_of_its_texts(spark):
    other = " ".join(random.Random(1).sample(PROSE.split(), 26))
    rows = [(1, PROSE), (1, other), (2, other), (3, PROSE + " again"), (4, "unlike all of them in every way there is"), (4, PROSE), (None, PROSE), (5, None), (5, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in jaccard_components(docs, 5, (80, 100)).collect())
    own = len(PROSE.split()) - 4
    assert found == sorted([(1, own, 1), (1, len(other.split()) - 4, 1), (2, len(other.split()) - 4, 1), (3, own + 1, 1), (4, 5, 4), (4, own, 1), (0, own, 0), (5, 0, 5), (5, 0, 5)])
    kept = sorted((r.doc_id or 0, r.text or "") for r in drop_near_copies(docs.withColumn("row", F.lit(1))).collect())
    assert kept == sorted([(1, PROSE), (1, other), (4, rows[4][1]), (0, PROSE), (5, ""), (5, "")])


def test_a_rated_id_counts_once(spark):
    rows = [(7, f"text number {i}") for i in range(500)] + [(i, "good words here") for i in range(100, 120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ratings = spark.createDataFrame([(7, 0), *[(i, 1) for i in range(100, 120)]], "doc_id long, grade int")
    seen = []
    fit, quality.fit_ordinal = quality.fit_ordinal, lambda lengths, at, value, grade, k: seen.append(len(grade))
    try:
        quality.fit_quality(docs, ratings, 2, max_train=30)
    finally:
        quality.fit_ordinal = fit
    assert seen == [21]


def families(n, size, seed):
    """n texts of 120 words and size - 1 near copies of each, and each text once more."""
    rng, out = random.Random(seed), []
    for i in range(n):
        base = [f"w{i}x{rng.randrange(400)}" for _ in range(120)]
        for j in range(size):
            own = list(base)
            for _ in range(rng.randrange(6) if j else 0):
                own[rng.randrange(120)] = f"n{rng.randrange(1 << 30)}"
            out.append(" ".join(own))
        out.append(" ".join(base))
    return out


def test_sets_that_share_a_key_share_a_meeting_in_few_rows(spark):
    texts = families(6, 12, 7)
    docs = spark.createDataFrame([(i, t.encode()) for i, t in enumerate(texts)], "doc_id long, text binary").repartition(4)
    hashes, keys = WordHashes(), {}
    for t in texts:
        own = neardup.shingle_set(hashes.of(t.encode()), 5)
        keys[neardup.set_key(own)[0]] = set(neardup.routing_keys(own, 80, 100).tolist())
    counts = []
    for n_buckets in (2, 40):
        packs = neardup.profile(docs, 5, 80, 100, n_buckets).where("bucket IS NOT NULL").select("bucket", "keys", "ids")
        rows = [tuple(r) for r in neardup.meetings(packs, n_buckets).collect()]
        of = {hi: {p for p, x in rows if x == hi} for hi in keys}
        assert all(of[a] & of[b] for a in keys for b in keys if a < b and keys[a] & keys[b])
        counts.append(len(rows))
    # few meetings for each set, whatever the number of buckets; exact copies have none
    assert counts[0] == counts[1] <= 6 * len(keys)


def test_one_home_for_each_set_and_nothing_lost(spark):
    rng = random.Random(2)
    met = {(p, x) for p in range(40) for x in rng.sample(range(30), rng.randrange(1, 6))} | {(p, x) for p in (50, 51, 52) for x in range(100, 130)}
    home, mixed = neardup.homes(spark.createDataFrame(sorted(met), "p long, x long"))
    home, mixed = ({tuple(r) for r in t.collect()} for t in (home, mixed))
    assert len({x for _, x in home}) == len(home) and home | mixed <= met
    pairs = lambda rows: {(a, b) for p, a in rows for q, b in rows if p == q and a < b}
    assert pairs(home | mixed) == pairs(met)
    # three meetings of the same members are one
    assert sum(x >= 100 for _, x in home | mixed) == 30


def test_near_keeps_repeated_rows_of_the_smallest_id(spark):
    rows = [(3, PROSE), (1, PROSE), (1, PROSE), (2, PROSE + " again")]
    kept = drop_near_copies(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [(r.doc_id, r.text) for r in kept] == [(1, PROSE)] * 2


def test_katz_vocabulary_is_twelve_bytes_a_word_and_comes_in_slices(spark, monkeypatch):
    import pickle

    import numpy as np

    from lettermill.llm import katz

    v = katz.Vocabulary(np.arange(100_000, dtype=np.uint64), np.ones(100_000, np.int64), 5)
    again = pickle.loads(pickle.dumps(v))
    assert len(pickle.dumps(v)) < 12.1 * 100_000 and again.counts.tolist() == v.counts.tolist()
    assert again.context_counts(np.array([3, again.start, again.unknown])).tolist() == [1, 5, 0]
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 97}" for j in range(40))) for i in range(60)], "doc_id long, text string")
    whole = {r.doc_id: r.score for r in katz.katz_scores(docs).collect()}
    monkeypatch.setattr(katz, "SLICE", 13)
    seen = []
    monkeypatch.setattr(katz, "materialize", lambda df, tag, make=katz.materialize: seen.append(make(df, tag)) or seen[-1])
    assert {r.doc_id: r.score for r in katz.katz_scores(docs).collect()} == whole
    # nothing is written that no step reads
    assert "seen" not in seen[-1].columns
