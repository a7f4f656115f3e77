"""Operators against brute force, exact round trips and held-out accuracy on the smallest given tables."""

import collections
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lettermill.llm import katz, neardup, pii, quality
from lettermill.llm.common import WordHashes, ascii_lower, shingles
from lettermill.llm.components import connected_components
from lettermill.llm.decontamination import benchmark_hits

SMALL = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the given tables")


def read(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def grouped(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def similar(sets, num, den):
    having = collections.defaultdict(list)
    for i, s in sets.items():
        for x in s:
            having[x].append(i)
    common = collections.Counter((a, b) for ids in having.values() for k, b in enumerate(ids) for a in ids[:k])
    return [p for p, c in common.items() if den * c >= num * (len(sets[p[0]]) + len(sets[p[1]]) - c)]


def word_sets(texts, k):
    out = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        out[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    return out


def test_components_of_a_path_a_star_and_a_ring(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 20)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = dict(map(tuple, connected_components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {n: c for n, c in grouped({x for p in links for x in p}, links).items()}


@given
@pytest.mark.parametrize(("k", "similarity"), [(3, (90, 100)), (5, (80, 100))])
def test_jaccard_components(spark, k, similarity):
    docs = read(spark, "documents").select("doc_id", "text")
    # a family of near copies around one text, large enough for several blocks
    base = docs.where("doc_id = 0").first().text.split()
    rng = random.Random(k)
    near = [(10_000 + i, " ".join(w if rng.random() > 0.003 else f"x{i}" for w in base)) for i in range(60)]
    docs = docs.unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    sets = word_sets({r.doc_id: r.text for r in docs.collect()}, k)
    want = grouped(sets, similar(sets, *similarity))
    block, neardup.BLOCK = neardup.BLOCK, 8
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.jaccard_components(docs, k, similarity).collect()}
    finally:
        neardup.BLOCK = block
    assert got == {i: (len(sets[i]), c) for i, c in want.items()}


@pytest.mark.parametrize(("num", "den"), [(90, 100), (80, 100)])
def test_similar_sets_share_a_routing_key(num, den):
    rng = np.random.default_rng(num)
    for n in [*range(1, 60), 100, 333, 1000]:
        own = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2)
        for _ in range(6):
            drop = int(rng.integers(0, n * (den - num) // den + 1))
            add = int(rng.integers(0, (n - drop) * den // num - n + 1)) if (n - drop) * den // num >= n else 0
            other = np.unique(np.concatenate([rng.permutation(own)[drop:], rng.integers(0, 1 << 63, add, dtype=np.uint64)]))
            a = np.unique(own)
            both = len(np.intersect1d(a, other))
            if len(other) and den * both >= num * (len(a) + len(other) - both):
                assert set(neardup.routing_keys(a, num, den)) & set(neardup.routing_keys(other, num, den)), (n, drop, add)


def test_count_tree_links_like_brute_force():
    rng = np.random.default_rng(5)
    sets = {}
    for c in range(30):
        base = rng.integers(0, 1 << 60, rng.integers(1, 300), dtype=np.uint64)
        for _ in range(int(rng.integers(1, 12))):
            sets[len(sets)] = np.unique(np.where(rng.random(len(base)) < 0.04, rng.integers(0, 1 << 60, len(base), dtype=np.uint64), base))
    want = grouped(sets, similar({i: set(s.tolist()) for i, s in sets.items()}, 80, 100))
    assert grouped(sets, neardup.CountTree(neardup.count_points(list(sets.values())), 80, 100, list(sets.values())).links()) == want


@given
def test_benchmark_hits(spark):
    docs, items = read(spark, "documents"), read(spark, "benchmark")
    text = items.where("item_id = 0").first().text
    edited = [(9001, f"one two {text} three"), (9002, text.upper()), (9003, " ".join(text.split()[:-1])), (9004, "nothing of the kind")]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(edited, "doc_id long, text string"))
    hashes = WordHashes()
    own = {r.item_id: shingles(hashes.of(r.text.encode()), 5) for r in items.collect()}
    want = set()
    for r in docs.collect():
        s = shingles(hashes.of((r.text or "").encode()), 5)
        for item, t in own.items():
            if len(s) and len(np.intersect1d(s, t)):
                goal = collections.Counter(t.tolist())
                for at in range(max(1, len(s) - len(t) + 1)):
                    window = s[at : at + len(t)]
                    both = sum((collections.Counter(window.tolist()) & goal).values())
                    if 100 * both >= 80 * (len(window) + len(t) - both):
                        want.add((r.doc_id, item))
                        break
    got = {(r.doc_id, r.item_id) for r in benchmark_hits(docs, items).collect()}
    assert got == want and {(9001, 0), (9002, 0)} <= got


@given
def test_katz_is_normalised_and_equals_the_joins(spark):
    docs = read(spark, "documents").select("doc_id", "text")
    size, katz.GROUP_BYTES, katz.BUCKET_TOKENS = (katz.GROUP_BYTES, katz.BUCKET_TOKENS), 100_000, 20_000
    try:
        one = {r.doc_id: r for r in katz.katz_scores(docs).collect()}
        two = {r.doc_id: r for r in katz.katz_scores(docs, max_vocabulary=10).collect()}
    finally:
        katz.GROUP_BYTES, katz.BUCKET_TOKENS = size
    for i, r in one.items():
        assert r[:5] == two[i][:5] and r.score == pytest.approx(two[i].score) and r.base_score == pytest.approx(two[i].base_score)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 10 == 0)
    held = [r for r in one.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    # p(. | v) sums to 1: every known word once behind the context, and the unknown ones as one
    train = spark.createDataFrame([(i, t) for i, t in enumerate(["a b a c a b", "b a b c", "a a b d e f g", "c b", "a b c d", "a b"] * 3)], "doc_id long, text string")
    never = F.lit(False)
    known = ["a", "b", "c", "d", "e", "f", "g", "zzz"]
    probe = spark.createDataFrame([(1000 + i, f"a {w}") for i, w in enumerate(known)] + [(2000, "a")], "doc_id long, text string")
    rows = {r.doc_id: r for r in katz.katz_scores(train.unionByName(probe), held_out=F.col("doc_id") >= 1000).collect()}
    start = katz.katz_scores(train, held_out=never)
    assert start.count() == 18
    counts = collections.Counter(w for r in train.collect() for w in [*r.text.split(), " "])
    n = sum(counts.values())
    assert rows[2000].base_score == pytest.approx(sum(np.log10((counts[w] + 0.1) / (n + 0.1 * (len(counts) + 1))) for w in ("a", " ")))
    v = katz.Vocabulary(np.arange(len(counts), dtype=np.uint64), np.array(sorted(counts.values())), 18)
    assert v.probability(np.arange(v.size)).sum() + v.left == pytest.approx(1)
    keys = np.array([(0 << 32) | 1, (0 << 32) | 2, (1 << 32) | 0], np.uint64)
    seen = np.array([3, 1, 7])
    which, stats = katz.context_stats(keys, seen, v)
    total = np.array([4, 7])
    alpha, factor = katz.backoff(stats, total, v.d)
    for k, c in enumerate(which):
        inside = (keys >> np.uint64(32)) == c
        words = (keys[inside] & np.uint64(0xFFFFFFFF)).astype(int)
        rest = np.setdiff1d(np.append(np.arange(v.size), v.unknown), words)
        assert (factor[k] * katz.discounted(seen[inside], v.d) / total[k]).sum() + alpha[k] * v.probability(rest).sum() == pytest.approx(1)


def test_base_spans_equal_the_patterns():
    patterns = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def valid(kind, text):
        digits = re.sub("[^0-9]", "", text)
        return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in text.split(".")), "card": lambda: 13 <= len(digits) <= 19 and pii.luhn(digits), "phone": lambda: 9 <= len(digits) <= 15}[kind]()

    rng = random.Random(7)
    texts = ["".join(rng.choice("1239.+ @a-b.(é٣") for _ in range(rng.randint(0, 60))) for _ in range(5000)] + ["4111 1111 1111 1111", "a@b.c@d.e f@g h@i.j", "1.2.3.4.5.6.7.8 999.1.1.1.2 0001.02.3.4", "4" * 5000 + "a" * 5000]
    for text in texts:
        assert pii.base_spans(text) == [(k, *m.span()) for k, p in patterns.items() for m in re.finditer(p, text) if valid(k, m.group())]


@given
def test_quality_on_held_out_rows(spark):
    folder = SMALL.replace("0.001", "0.1")
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    grades = quality.quality_grades(labels)
    model = quality.fit_quality(docs, grades.where("doc_id % 5 <> 0"), 3)
    assert list(model.thresholds) == sorted(model.thresholds)
    held = quality.score_quality(docs.join(grades.where("doc_id % 5 = 0"), "doc_id"), model)
    kept = {r.grade: r.k for r in held.groupBy("grade").agg(F.avg(F.col("keep").cast("int")).alias("k")).collect()}
    abusive = held.where("text RLIKE '(?i)idiot|stupid|trash|pathetic|disgusting|worthless'").where("keep").count()
    assert kept[2] > 0.97 and kept[1] < 0.2 and kept[0] < 0.4 and abusive == 0


def test_ascii_lower(spark):
    row = spark.createDataFrame([("ÄbC",), ("ABC",), (None,)], "t string").select(ascii_lower(F.col("t")).alias("x")).collect()
    assert [r.x for r in row] == ["Äbc", "abc", ""]


@given
def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = read(spark, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = {}
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, SMALL)
        assert frame.columns == docs.columns
        kept[name] = {r.doc_id for r in frame.select("doc_id").collect()}
        frame = docs.where(F.col("doc_id").isin(list(kept[name])))
    first: dict = {}
    for i in sorted(kept["quality"]):
        first.setdefault("".join(c.lower() if c.isascii() else c for c in texts[i] or ""), i)
    assert kept["exact"] == set(first.values())
    sets = word_sets({i: texts[i] for i in kept["exact"]}, 5)
    assert kept["near"] == {i for i, c in grouped(sets, similar(sets, 80, 100)).items() if i == c}
    assert kept["benchmark"] <= kept["near"]
    pieces = corpus_pipeline.packing(spark, frame, SMALL)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == kept["benchmark"]
