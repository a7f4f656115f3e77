"""Hand-computed results and brute force on small inputs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettermill.functions import names
from lettermill.functions.alphabets import alphabet_keys, alphabet_table, check_valid, get_alphabet, reduce_sequence
from lettermill.operators import annotate, clustering, kmers, models, motif, scoring, sequences, similarity, store, svm
from lettermill.sources import fasta, tables


def one(spark, text, *columns):
    return spark.createDataFrame([(text,)], "s string").select(*columns).first()


def seqs(spark, *rows):
    return spark.createDataFrame([(f"s{i}", r) for i, r in enumerate(rows)], "seq_id string, sequence string")


@pytest.mark.parametrize(("alphabet", "text", "reduced", "k", "expected"), [("hydro", "MAKES*", "VVSSS", 2, ["VV", "VS", "SS", "SS"]), ("hydrocharge", "MAKEN", "HHCEC", 2, ["HH", "HC"]), (0, "VV", "VV", 3, []), ("hydrostruct", "BVA", "BHH", 2, ["BH", "HH"])])
def test_recode_and_kmers(spark, alphabet, text, reduced, k, expected):
    row = one(spark, text, reduce_sequence(F.col("s"), alphabet).alias("r"), kmers.kmer_array(F.col("s"), k, alphabet).alias("k"))
    assert (row.r, row.k) == (reduced, expected)
    assert [r.kmer for r in kmers.kmers(seqs(spark, text), k, alphabet).orderBy("pos").collect()] == expected


def test_alphabets(spark):
    assert check_valid(5) == "miqs" and check_valid(None) == "None"
    for wrong in (6, 7, -1, "nothing", True):
        with pytest.raises(ValueError):
            check_valid(wrong)
    assert get_alphabet({"AB": "X", "B": "Y"}) == {"A": "X", "B": "Y"} and alphabet_keys("solvacc") == "ACP"
    assert alphabet_table(spark).where("alphabet = 'hydro'").count() == 20
    assert kmers.kmer_space(spark, "solvacc", 3).distinct().count() == 27


@pytest.mark.parametrize(("path", "family"), [("in/my-nxrA.v1.faa", "nxrA"), ("TIGR03149.faa", "TIGR03149"), ("plain", "plain")])
def test_family(spark, path, family):
    assert one(spark, path, names.family_from_filename(F.col("s")).alias("x")).x == family


@pytest.mark.parametrize(("path", "expected"), [("x.fasta.gz", ("x", "fasta")), ("d/x.fasta", ("x", "fasta")), ("x", ("x", "")), (".hidden", (".hidden", "")), ("a.b.c", ("a.b", "c"))])
def test_split_ext(spark, path, expected):
    assert tuple(one(spark, path, *names.split_file_ext(F.col("s")))) == expected


def test_accession(spark):
    assert one(spark, "tr|A0A|B", names.accession(F.col("s"))).asDict() and one(spark, "tr|A0A|B", names.accession(F.col("s")).alias("x")).x == "A0A"
    assert one(spark, "none", names.accession(F.col("s")).alias("x")).x is None


def test_fragments(spark):
    s = seqs(spark, "ABCDEFGHIJ")
    assert [r.sequence for r in sequences.fragment(s, "percent", 50, "start", 5).collect()] == ["ABCDE"]
    assert sequences.fragment(s, "percent", 50, "start", 6).count() == 0
    assert sequences.fragment(s, "absolute", 8, "all", 1).count() == 3
    assert sequences.fragment(s, "absolute", 11, "end", 1).count() == 0
    assert [r.sequence for r in sequences.fragment(s, "absolute", 3, "end", 1).collect()] == ["HIJ"]


def long(spark, rows, names_):
    return spark.createDataFrame(rows, names_)


def test_cosine_and_enhanced(spark):
    counts = long(spark, [("s", "VV", 1), ("s", "VS", 1), ("s", "SS", 2)], "seq_id string, kmer string, cnt long")
    profile = long(spark, [("A", "SS", 2), ("A", "VV", 2), ("A", "SV", 1), ("Totals", "SS", 9)], "annotation string, kmer string, cnt long")
    rows = similarity.cosine_scores(counts, profile).collect()
    assert len(rows) == 1 and round(rows[0].score, 6) == 0.816497
    pairs = long(spark, [("s", "a"), ("s", "b")], "seq_id string, kmer string")
    assoc = long(spark, [("A", "a", 2.0), ("A", "c", 4.0), ("B", "b", 1.0)], "annotation string, kmer string, association double")
    assert {r.annotation: r.score for r in similarity.enhanced_scores(pairs, assoc).collect()}["A"] == -1


def test_set_distances(spark):
    pairs = long(spark, [("x", "a"), ("x", "b"), ("y", "b"), ("y", "c")], "seq_id string, kmer string")
    assert round(similarity.jaccard_pairs(pairs, 0.9).first().distance, 6) == 0.666667
    cand = long(spark, [("x", "y", 2, 2)], "a string, b string, n_a long, n_b long")
    assert similarity.hamming_similarity(pairs, cand, 4).first().similarity == 0.5


def test_jaccard_prefix_filter_is_exact(spark):
    rng = np.random.default_rng(1)
    sets = {f"s{i:02}": set(rng.choice(30, rng.integers(1, 12), replace=False).tolist()) for i in range(40)}
    pairs = long(spark, [(i, str(k)) for i, x in sets.items() for k in x], "seq_id string, kmer string")
    for limit in (0.3, 0.5, 0.8):
        want = {(a, b) for a in sets for b in sets if a < b and 1 - len(sets[a] & sets[b]) / len(sets[a] | sets[b]) <= limit}
        assert {(r.a, r.b) for r in similarity.jaccard_pairs(pairs, limit).collect()} == want


@pytest.mark.parametrize("most", [3, 4096])
def test_jaccard_pairs_of_all_sizes_and_hot_lists(spark, most, monkeypatch):
    monkeypatch.setattr(similarity, "LIST", most)
    rng = np.random.default_rng(most)
    # sizes of exact powers, near copies of each other, k-mers that all have, copies
    sets = {f"s{i:03}": {"hot", "warm", *(f"k{x}" for x in rng.choice(14, rng.choice([1, 2, 3, 4, 6, 7, 8, 10, 14]), replace=False))} - ({"hot"} if i % 5 == 0 else set()) for i in range(70)}
    for i in range(12):
        sets[f"t{i}"] = {f"m{x}" for x in range(2 ** (i % 6))} | ({"hot"} if i > 8 else set())
    pairs = long(spark, [(k, x) for k, v in sets.items() for x in v], "seq_id string, kmer string")
    for limit in (0.0, 0.25, 0.5, 2 / 3, 0.9):
        want = {(a, b): 1 - len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
        found = [(r.a, r.b, round(r.distance, 9)) for r in similarity.jaccard_pairs(pairs, limit).collect()]
        assert sorted(found) == sorted((a, b, round(d, 9)) for (a, b), d in want.items() if d <= limit)


def test_links_of_copies(spark):
    sets = {"a": "xyz", "b": "xyz", "c": "xyzw", "d": "xyz", "e": "pq"}
    pairs = long(spark, [(i, k) for i, ks in sets.items() for k in ks], "seq_id string, kmer string")
    assert {r.seq_id: r.rep for r in similarity.set_classes(pairs).collect()} == {"a": "a", "b": "a", "d": "a", "c": "c", "e": "e"}
    assert {(r.a, r.b, r.distance) for r in similarity.jaccard_links(pairs, 0.5).collect()} == {("a", "b", 0.0), ("a", "d", 0.0), ("a", "c", 0.25)}
    got = clustering.connected_components(long(spark, [(i,) for i in sets], "seq_id string"), similarity.jaccard_links(pairs, 0.5))
    assert {r.seq_id: r.component for r in got.collect()} == {"a": "a", "b": "a", "c": "a", "d": "a", "e": "e"}


def test_places_in_a_global_order(spark):
    rows = [(x, i) for i, x in enumerate([5, 3, 9, 3, 1, 7, 7, 7, 0])]
    got = [tuple(r) for r in store.numbered(long(spark, rows, "x int, y int"), ["x", "y"]).orderBy("idx").select("x", "y", "idx").collect()]
    assert got == [(*r, i) for i, r in enumerate(sorted(rows))]


@pytest.mark.parametrize("descending", [False, True])
def test_running_sums_per_key(spark, descending):
    rng = np.random.default_rng(9)
    # one key has nine tenths of the rows, some keys are null, and rows repeat
    rows = [(None if x > 0.98 else "hot" if x > 0.08 else f"k{int(x * 100)}", int(y), int(z)) for x, y, z in zip(rng.random(900), rng.integers(0, 50, 900), rng.integers(0, 9, 900), strict=True)]
    df = long(spark, rows, "k string, y int, z long")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = store.running(df, ["k"], ["y", "z"], {"n": F.lit(1), "s": F.col("z")}, descending, True, {"x": F.xxhash64("y", "z")})
        largest = store.written(got.withColumn("part", F.spark_partition_id())).groupBy("part").count().agg(F.max("count")).first()[0]
        got = got.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert len(got) == 900 and largest < 400
    hashes = {(r.y, r.z): r.h for r in df.select("y", "z", F.xxhash64("y", "z").alias("h")).collect()}
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: r[1:], reverse=descending)
        want, s, x = [], 0, 0
        for i, (_, y, z) in enumerate(own):
            s, x = s + z, x ^ hashes[y, z]
            want.append((y, z, i + 1, s, x, len(own), sum(r[2] for r in own)))
        assert sorted((r.y, r.z, r.n, r.s, r.x, r.n_total, r.s_total) for r in got if r.k == key) == sorted(want)
    assert store.running(df.limit(0), ["k"], ["y"], {"n": F.lit(1)}).count() == 0


def test_permutations_in_bits_equal_single_ones(spark):
    rng = np.random.default_rng(6)
    pairs = long(spark, [(f"s{i}", str(k)) for i in range(30) for k in rng.choice(6, 3, replace=False)], "seq_id string, kmer string")
    labels = long(spark, [(f"s{i}", "f" if i % 3 else "g") for i in range(30)], "seq_id string, label string")
    permuted = motif.permute_labels(labels, 130)
    assert permuted.groupBy("perm").agg(F.count(F.when(F.col("label") == "f", 1)).alias("n")).select("n").distinct().collect() == [(20,)]
    want = {(r.perm, r.kmer): r.score for r in motif.score_statistic(pairs, permuted, "f", ("perm",)).collect()}
    got = {(r.perm, r.kmer): r.score for r in motif.permuted_statistic(pairs, permuted, "f").collect()}
    assert got == want and len(got) == 130 * 6


def test_family_models_have_no_gradient(spark):
    rng = np.random.default_rng(8)
    rows = [(label, float(x), int(rng.random() < 1 / (1 + np.exp(-slope * x)))) for label, slope in (("a", 2.0), ("b", -1.0)) for x in rng.normal(size=200)]
    fits = {r.label: (r.w, r.b) for r in models.fit_family_models(long(spark, rows, "label string, score double, in_family int")).collect()}
    for label, (w, b) in fits.items():
        x, y = (np.array([r[i] for r in rows if r[0] == label]) for i in (1, 2))
        e = 1 / (1 + np.exp(-(w * x + b))) - y
        assert abs(w + (e * x).sum()) < 1e-8 and abs(e.sum()) < 1e-8
    one = models.fit_family_models(long(spark, [("a", 1.0, 1)], "label string, score double, in_family int"), steps=5).first()
    assert np.isfinite(one.w) and np.isfinite(one.b)


def test_class_scores(spark):
    pairs = long(spark, [("a", "k"), ("c", "k"), ("b", "z")], "seq_id string, kmer string")
    labels = long(spark, [("a", "A"), ("b", "B"), ("c", "C")], "seq_id string, label string")
    scores = scoring.class_scores(scoring.class_probabilities(pairs, labels), labels)
    assert {r.label: r.score for r in scores.where("kmer = 'k'").collect()} == {"A": 0.5, "B": -1.0, "C": 0.5}
    grid = scores.sparkSession.range(8).select(F.lit("A").alias("label"), F.col("id").cast("string").alias("kmer"), F.col("id").cast("double").alias("score"))
    assert [r.kmer for r in scoring.top_kmers(grid, 0.25).orderBy("index").collect()] == ["7", "6"]
    with pytest.raises(ValueError):
        scoring.top_kmers(grid, 1.5)


def test_grids_of_models_need_no_cartesian_product(spark):
    pairs = long(spark, [("a", "k"), ("c", "k"), ("b", "z"), ("d", "m")], "seq_id string, kmer string")
    labels = long(spark, [("a", "A"), ("b", "B"), ("c", "C"), ("d", "A")], "seq_id string, label string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        weights, scored = scoring.fit_family_scores(pairs, labels, 0.7)
        new = scoring.score_new(pairs, weights, scored, labels)
        back = scoring.background_scores(pairs, labels, labels, 0.7)
        for df in (weights, scored, new, back):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Cartesian" not in plan and "NestedLoop" not in plan
        assert weights.count() == 9 and scored.count() == 12 and back.where("label = background_label").count() == scoring.background_scores(pairs, labels, labels, 0.7, matched=True).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_folds_are_even(spark):
    df = spark.range(53).select(F.concat(F.lit("s"), "id").alias("seq_id"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("label"))
    sizes = [r["count"] for r in scoring.stratified_folds(df, "label", 5).groupBy("label", "fold").count().where("label = 'a'").collect()]
    assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_auc_and_average_precision(spark):
    rng = np.random.default_rng(2)
    y, s = rng.integers(0, 2, 60), rng.integers(0, 8, 60) / 8
    df = long(spark, [("l", 1, int(a), float(b)) for a, b in zip(y, s, strict=True)], "label string, fold int, in_family int, score double")
    wins = np.mean([(p > n) + 0.5 * (p == n) for p in s[y == 1] for n in s[y == 0]])
    assert models.roc_auc(df).first().auc == pytest.approx(wins)
    at = sorted(set(s), reverse=True)
    recall = [0.0, *[(y[s >= t].sum()) / y.sum() for t in at]]
    assert models.average_precision(df).first().average_precision == pytest.approx(sum((recall[i + 1] - recall[i]) * y[s >= t].mean() for i, t in enumerate(at)))
    curve = models.roc_curve(df).orderBy("i").collect()
    fpr = [0.0, *[((y == 0) & (s >= t)).sum() / (y == 0).sum() for t in at]]
    assert [r.tpr for r in curve] == pytest.approx([0.0, *np.interp(np.linspace(0, 1, 100), fpr, recall)[1:]])
    assert models.mean_roc(models.roc_curve(df)).count() == 100


@pytest.mark.parametrize(("ends", "expected"), [(False, [None, 0.5, 0.75, 1.0, 1.0]), (True, [0.5, 0.5, 0.75, 1.0, 1.0])])
def test_interpolation(spark, ends, expected):
    df = long(spark, [(0, None), (1, 0.5), (2, None), (3, 1.0), (4, None)], "bin int, ratio double")
    assert [r.x for r in df.select("bin", annotate.interpolated("ratio", [], ends).alias("x")).orderBy("bin").collect()] == expected


def test_confidence_merge(spark):
    columns = "bin int, confidence double, weight long, sum long"
    prior, current = long(spark, [(0, 0.8, 100, 70), (1, 0.5, 100, 30)], columns), long(spark, [(0, 0.6, 50, 10), (1, 1.0, 50, 40)], columns)
    # k = 1 + 20 * 50 / 150, one weight for all bins
    w = 50 * (1 + 20 * 50 / 150)
    rows = annotate.merge_confidence(current, prior, 20).orderBy("bin").collect()
    assert [tuple(r) for r in rows] == [(0, pytest.approx((80 + 0.6 * w) / (100 + w)), 150, 80), (1, pytest.approx((50 + w) / (100 + w)), 150, 70)]
    assert sorted(map(tuple, annotate.merge_confidence(current).collect())) == [(0, 0.6, 50, 10), (1, 1.0, 50, 40)]
    none = long(spark, [(0, None, 0, 0)], columns)
    assert tuple(annotate.merge_confidence(none, none, 20).first()) == (0, None, 0, 0)
    table = long(spark, [("A", 0, 3, 1), ("B", 0, 0, 2), ("A", 5, 4, 0)], "prediction string, bin int, n_true long, n_false long")
    assert sorted(map(tuple, annotate.global_confidence(table).collect())) == [(0, 0.5, 10, 6), (5, 1.0, 10, 4)]


def test_background_scores(spark):
    pairs = long(spark, [("a", "k"), ("a", "m"), ("b", "z"), ("x", "k"), ("x", "z"), ("y", "m")], "seq_id string, kmer string")
    sample, back = (long(spark, rows, "seq_id string, label string") for rows in ([("a", "A"), ("b", "B")], [("x", "A"), ("y", "B")]))
    # of label A's k-mers k and m (1 each) and z (0), two thirds are chosen: k and m; the background gives k 1 and m -1 for A
    got = {(r.label, r.background_label, r.seq_id): (r.total, r.norm) for r in scoring.background_scores(pairs, sample, back, 0.7).collect()}
    assert got["A", "A", "x"] == (1.0, 1.0) and got["A", "A", "a"] == (0.0, 1.0) and got["A", "A", "y"] == (-1.0, 1.0)
    own = scoring.fit_family_scores(pairs, sample, 0.7, others=back)[1]
    both = {(r.label, r.seq_id): (r.score, r.weighted, r.subtracted) for r in scoring.combine_background(own, scoring.background_scores(pairs, sample, back, 0.7)).collect()}
    # a has 2 of label A's scores, the largest total; x has 1
    assert both["A", "x"] == (0.5, 0.0, -0.5) and both["A", "a"] == (1.0, 1.0, 1.0) and len(both) == 8


def test_p_value(spark):
    real, perm = long(spark, [("k", 0.5)], "kmer string, score double"), long(spark, [(i, "k", s) for i, s in enumerate([0.6, 0.5, 0.4, 0.1])], "perm int, kmer string, score double")
    row = motif.permutation_p_values(real, perm).first()
    assert (row.false_positives, row.n, row.p) == (2, 4, 0.5)


def linkage(distance: np.ndarray, threshold: float, how: str) -> np.ndarray:
    """Cluster number of each row: merges the closest two clusters while they are nearer than threshold; how: single, complete or average."""
    d, n = distance.astype(float).copy(), len(distance)
    np.fill_diagonal(d, np.inf)
    size, label = np.ones(n), np.arange(n)
    while n > 1:
        i, j = divmod(int(d.argmin()), len(d))
        if not d[i, j] < threshold:
            break
        i, j = min(i, j), max(i, j)
        joined = {"single": np.minimum(d[i], d[j]), "complete": np.maximum(d[i], d[j]), "average": (size[i] * d[i] + size[j] * d[j]) / (size[i] + size[j])}[how]
        joined[[i, j]] = np.inf
        d[i], d[:, i] = joined, joined
        d[j], d[:, j] = np.inf, np.inf
        size[i] += size[j]
        label[label == j] = i
        n -= 1
    return label


@pytest.mark.parametrize("how", ["average", "complete"])
def test_linkage_of_any_size_equals_one_by_one(spark, how, monkeypatch):
    # blocks and stretches far below a component's size
    monkeypatch.setattr(clustering, "BLOCK", 5)
    monkeypatch.setattr(clustering, "COLUMNS", 7)
    rng = np.random.default_rng(11)
    centres = [set(rng.choice(60, 14, replace=False).tolist()) for _ in range(6)]
    sets = {}
    for i in range(70):
        own = {x for x in centres[i % 6] if rng.random() > 0.2} | set(rng.choice(60, 2).tolist())
        sets[f"s{i:02}"] = own
    # many copies of a few sets weigh in an average
    for i in range(70, 110):
        sets[f"s{i:03}x"] = sets["s03"] if i % 2 else sets["s09"]
    ids = sorted(sets)
    d = np.array([[1 - len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for b in ids] for a in ids])
    pairs = long(spark, [(i, str(k)) for i, x in sets.items() for k in x], "seq_id string, kmer string")
    vertices = long(spark, [(i,) for i in [*ids, "none"]], "seq_id string")
    for threshold in (0.45, 0.7):
        got = {r.seq_id: r.component for r in clustering.cluster_agglomerative_jaccard(pairs, vertices, threshold, how).collect()}
        label = linkage(d, threshold, how)
        assert got.pop("none") == "none" and got == {i: ids[label[k]] for k, i in enumerate(ids)}
        assert 1 < len(set(got.values())) < 110


def test_linkage_against_components(spark):
    rng = np.random.default_rng(3)
    sets = {f"s{i:02}": set(rng.choice(12, 5, replace=False).tolist()) for i in range(24)}
    pairs = long(spark, [(i, str(k)) for i, x in sets.items() for k in x], "seq_id string, kmer string")
    vertices = long(spark, [(i,) for i in [*sets, "none"]], "seq_id string")
    single = {r.seq_id: r.component for r in clustering.cluster_agglomerative_jaccard(pairs, vertices, 0.5, "single").collect()}
    average = {r.seq_id: r.component for r in clustering.cluster_agglomerative_jaccard(pairs, vertices, 0.5, "average").collect()}
    ids = sorted(sets)
    d = np.array([[1 - len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for b in ids] for a in ids])
    for how, got in (("single", single), ("average", average)):
        label = linkage(d, 0.5, how)
        assert {i: got[i] for i in ids} == {i: ids[label[k]] for k, i in enumerate(ids)}
    assert single["none"] == "none"
    # copies count one by one, but stand for one point
    copies = pairs.unionByName(pairs.where("seq_id = 's00'").crossJoin(spark.range(2000)).select(F.concat("seq_id", F.lit("c"), "id").alias("seq_id"), "kmer"))
    many = copies.select("seq_id").distinct()
    near = similarity.jaccard_pairs(pairs, 0.3)
    links = {i: {i} for i in ids}
    for r in near.collect():
        links[r.a].add(r.b)
        links[r.b].add(r.a)
    dense = {i for i in ids if len(links[i]) + (2000 if "s00" in links[i] else 0) >= 4}
    got = {r.seq_id: r.component for r in clustering.cluster_density(copies, many, 0.3, 4).collect()}
    assert {i for i in ids if got[i]} == {i for i in ids if links[i] & dense} and {got[f"s00c{i}"] for i in range(2000)} == {got["s00"]}
    noise = {r.seq_id: r.component for r in clustering.cluster_density(pairs, vertices, 0.5, 30).collect()}
    assert set(noise.values()) == {None}


def test_fasta_round_trip(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.faa").write_text(">id1 first > one\r\nMAK\r\nES*\r\n>id2\nVV\n")
    (tmp_path / "in" / "b.txt").write_text(">no\nAA\n")
    rows = fasta.read_fasta(spark, str(tmp_path / "in"))
    assert sorted((r.filename, r.seq_id, r.description, r.sequence) for r in rows.collect()) == [("a.faa", "id1", "id1 first > one", "MAKES*"), ("a.faa", "id2", "id2", "VV")]
    for compression in ("none", "gzip"):
        fasta.write_fasta(rows, str(tmp_path / compression), compression=compression)
        again = fasta.read_fasta(spark, str(tmp_path / compression), ("txt",))
        assert sorted((r.seq_id, r.description, r.sequence) for r in again.collect()) == [("id1", "id1 first > one", "MAKES*"), ("id2", "id2", "VV")]


def test_annotations_last_wins(spark, tmp_path):
    (tmp_path / "a.ann").write_text("id\tTIGRFAMs\nx\tone\ny\tNA\n")
    (tmp_path / "b.ann").write_text("id\tTIGRFAMs\nx\ttwo\nx\tthree\n")
    got = tables.read_annotations(spark, [str(tmp_path / "a.ann"), str(tmp_path / "b.ann")])
    assert {r.id: r.annotation for r in got.collect()} == {"x": "three", "y": "NA"}


def test_tables_round_trip(spark, tmp_path):
    counts = long(spark, [("A", "aa", 2), ("Totals", "aa", 3), ("Totals", "ab", 1)], "annotation string, kmer string, cnt long")
    sizes = long(spark, [("A", 1, 2), ("Totals", 2, 4)], "annotation string, n_seqs long, n_kmers long")
    tables.write_count_matrix(counts, sizes, str(tmp_path / "m"), ["aa", "ab"])
    back, n = tables.read_count_matrix(spark, str(tmp_path / "m"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, counts.collect())) and n.count() == 2
    conf = long(spark, [(i, i / 100, 5, 6) for i in range(101)], "bin int, confidence double, weight long, sum long")
    tables.write_confidence(conf, str(tmp_path / "c"))
    assert sorted(map(tuple, tables.read_confidence(spark, str(tmp_path / "c")).collect())) == sorted(map(tuple, conf.collect()))
    tables.write_basis(long(spark, [("b",), ("a",), ("a",)], "kmer string"), str(tmp_path / "b"))
    assert [r.kmer for r in tables.read_basis(spark, str(tmp_path / "b")).orderBy("kmer").collect()] == ["a", "b"]
    tables.write_nested(conf, str(tmp_path / "n"), "hydro", 4)
    assert (tmp_path / "n" / "alphabet=hydro" / "k=04").is_dir()
    tables.write_csv_results(conf, str(tmp_path / "r"), compress=True)
    assert list((tmp_path / "r").glob("*.csv.gz"))


def test_vectors(spark, tmp_path):
    counts = long(spark, [("s", "aa", 2), ("t", "ac", 1)], "seq_id string, kmer string, cnt long")
    basis = kmers.indexed(long(spark, [("aa",), ("ab",), ("ac",)], "kmer string"))
    assert {r.seq_id: r["values"] for r in kmers.harmonize_dense(counts, basis).collect()} == {"s": [2.0, 0.0, 0.0], "t": [0.0, 0.0, 1.0]}
    plan = kmers.to_vectors(counts, basis)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
    tables.write_vectors_json(kmers.harmonize_dense(counts, basis).withColumnRenamed("values", "vector"), str(tmp_path / "j"), 1)
    assert {(r.seq_id, tuple(r.vector), r.vec_len) for r in tables.read_vectors_json(spark, str(tmp_path / "j")).collect()} == {("s", (2.0, 0.0, 0.0), 3), ("t", (0.0, 0.0, 1.0), 3)}
    (tmp_path / "v.json").write_text('{"seq_id": ["x", "y"], "vector": [[1, 0], [0, 1]]}')
    assert [(r.seq_id, r.vector, r.vec_len) for r in tables.read_vectors_json(spark, str(tmp_path / "v.json")).orderBy("seq_id").collect()] == [("x", [1.0, 0.0], 2), ("y", [0.0, 1.0], 2)]


def test_compatibility(spark):
    a, b, c = (long(spark, [(k,) for k in x], "kmer string") for x in (["ab", "ba"], ["aa", "bb"], ["abc"]))
    assert kmers.check_compatible(a, b) and not kmers.check_compatible(a, c)
    new = long(spark, [("A", "ab", 1)], "annotation string, kmer string, cnt long")
    assert annotate.merge_with_base(new, new).first().cnt == 2


def test_svm_fits_are_optimal(spark, monkeypatch):
    # groups of few fits, small pieces and blocks, and some features outside the preconditioner
    monkeypatch.setattr(svm, "NUMBERS", 900)
    monkeypatch.setattr(svm, "PIECE", 7)
    monkeypatch.setattr(svm, "CELLS", 100)
    monkeypatch.setattr(svm, "HEAVY", 20)
    rng = np.random.default_rng(5)
    ids = [f"s{i:02}" for i in range(50)]
    x = (rng.random((50, 24)) < 0.3).astype(float)
    x[7] = 0
    pairs = long(spark, [(ids[i], f"k{j:02}") for i, j in zip(*np.nonzero(x), strict=True)], "seq_id string, kmer string")
    labels = long(spark, [(i, "f" if k % 3 == 0 else "g") for k, i in enumerate(ids)], "seq_id string, label string")
    permuted = store.written(motif.permute_labels(labels, 37).unionByName(labels.select(F.lit(38).alias("perm"), "seq_id", F.lit("g").alias("label"))))
    fits = svm.fit_labellings(pairs, svm.labelling_bits(permuted, "f"), 38, tol=1e-3).collect()
    inside = {(r.perm, r.seq_id): r.label == "f" for r in permuted.collect()}
    weights = {(r.fit, r.kmer): r.weight for r in fits}
    assert len(weights) == 38 * 25
    for fit in range(1, 39):
        y = np.array([1.0 if inside[fit, i] else -1.0 for i in ids])
        w = np.array([weights[fit, f"k{j:02}"] for j in range(24)] + [weights[fit, None]])
        z = np.column_stack([x, np.ones(50)])
        if (y < 0).all():
            assert not w.any()
            continue
        c = np.where(y > 0, 50 / (2 * (y > 0).sum()), 50 / (2 * (y < 0).sum()))
        at0 = np.abs(2 * z.T @ (c * y)).max()
        assert np.abs(w - 2 * z.T @ (c * np.maximum(0, 1 - y * (z @ w)) * y)).max() < 1.01e-3 * at0
    one = spark.createDataFrame([r for r in fits if r.fit == 1]).select("kmer", "weight")
    left = svm.residuals(pairs, permuted.where("perm = 1").select("seq_id", "label"), "f", one).collect()
    assert len(left) == 24 and max(abs(r.residual) for r in left) < 1.01e-3


def test_svm_permutations(spark):
    rng = np.random.default_rng(4)
    rows = [(f"s{i:02}", k) for i in range(20) for k in (["hit"] if i < 10 else []) + [str(x) for x in rng.choice(5, 2, replace=False)]]
    pairs, labels = long(spark, rows, "seq_id string, kmer string"), long(spark, [(f"s{i:02}", "f" if i < 10 else "g") for i in range(20)], "seq_id string, label string")
    assert motif.svm_weights(pairs, labels, "f").orderBy(F.desc("weight")).first().kmer == "hit"
    assert motif.permutation_scores(pairs, labels, "f", 3, "svm").count() == 18
    best = motif.rank_motifs(motif.permutation_p_values(motif.score_statistic(pairs, labels, "f"), motif.permutation_scores(pairs, labels, "f", 20))).first()
    assert best.kmer == "hit"
