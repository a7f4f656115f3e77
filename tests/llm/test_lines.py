"""Line deduplication against plain Python shingles."""

import os
import random

import numpy as np
import pytest

from lettermill.llm import lines

FOLDER = "/root/testdata/sf0.001"


def shingles(line):
    return {line[i : i + 9] for i in range(max(1, len(line) - 8))}


def similar(a, b):
    x, y = shingles(a), shingles(b)
    return 100 * len(x & y) >= 80 * len(x | y)


def components(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: r.component_id for r in lines.similar_lines(docs).collect()}


def test_lines_that_differ_behind_the_ninth_character_of_a_word_stay_apart(spark):
    got = components(spark, ["andththwhes.", "andththwhwh.", "transaction 100000000123", "transaction 100000000456", "see https://example.org/a/first", "see https://example.org/b/other"])
    assert len(set(got.values())) == 6


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")
def test_linked_pairs_equal_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = lines.split_lines(docs).where("norm IS NOT NULL").select("doc_id", "line_no", "norm").collect()
    texts = sorted({r.norm for r in rows})
    having = {}
    for i, t in enumerate(texts):
        for s in shingles(t):
            having.setdefault(s, []).append(i)
    pairs = {(a, b) for ids in having.values() for k, b in enumerate(ids) for a in ids[:k]}
    want = {(texts[a], texts[b]) for a, b in pairs if similar(texts[a], texts[b])}
    of = {(r.doc_id, r.line_no): r.component_id for r in lines.similar_lines(docs).collect()}
    component = {r.norm: of[r.doc_id, r.line_no] for r in rows}
    assert sum(component[a] == component[b] for a, b in want) >= 0.99 * len(want)
    # no component without a path of similar lines
    linked = {t for p in want for t in p}
    several = {}
    for t, c in component.items():
        several.setdefault(c, []).append(t)
    assert all(t in linked for ts in several.values() if len(ts) > 1 for t in ts)


def test_chains_in_a_key_lose_no_link(spark):
    rng = random.Random(3)
    base = [rng.choice("abcdefghij ") for _ in range(120)]
    chain = ["".join(base)]
    for i in range(40):
        base[rng.randrange(120)] = "klmnopqrst"[i % 10]
        chain.append("".join(base))
    met = spark.createDataFrame([(0, i) for i in range(len(chain))], "key long, id long")
    texts = spark.createDataFrame(list(enumerate(chain)), "id long, norm string")

    def joined(pairs):
        root = list(range(len(chain)))
        for a, b in pairs:
            x, y = root[a], root[b]
            root = [min(x, y) if r in (x, y) else r for r in root]
        return root

    want = joined((a, b) for b in range(len(chain)) for a in range(b) if similar(chain[a], chain[b]))
    links, found = lines.line_links(met, texts, 80, 100)
    links = [(r.a, r.b) for r in links.collect()]
    assert all(similar(chain[a], chain[b]) for a, b in links) and joined(links) == want
    assert {r.node: r.component for r in found.collect()} == {i: c for i, c in enumerate(want) if want.count(c) > 1}
    assert similar(chain[0], chain[1]) and not similar(chain[0], chain[-1])


def test_shingles_are_all_runs_of_nine_characters():
    texts = ["a", "abc äöü", "nine char", "x" * 50, "the quick 𝒳 brown fox", "nine char", "a"]
    row, h = lines.line_shingles(texts)
    of = {}
    for i, t in enumerate(texts):
        own = h[row == i].tolist()
        cut = [t[j : j + 9] for j in range(max(1, len(t) - 8))]
        assert len(own) == len(cut)
        for shingle, value in zip(cut, own, strict=True):
            # equal shingles have equal hashes in any line, others don't
            assert of.setdefault(shingle, value) == value
    assert len(set(of.values())) == len(of)


def test_bands_are_minima_of_sectors():
    texts = ["the quick brown fox jumps over the lazy dog", "abc", "the quick brown fox jumps over the lazy dog"]
    keys, real = lines.band_keys(texts)
    assert (keys[0] == keys[2]).all() and (real[0] == real[2]).all() and real[1].sum() == 1
    row, h = lines.line_shingles(texts[:1])
    sectors = {((int(x) >> 40) * lines.SECTORS) >> 24 for x in h}
    assert real[0].sum() == len({s // lines.ROWS for s in sectors})


def test_links_of_a_meeting_span_what_all_pairs_link():
    rng = random.Random(5)
    sets = [set(rng.sample(range(60), 30)) for _ in range(40)]
    for i in range(25):
        near = set(rng.choice(sets))
        near.discard(next(iter(near)))
        sets.append(near | {100 + i})
    links = lines.meeting_links([np.array(sorted(s), np.uint64) for s in sets], 80, 100)
    want = [(a, b) for b in range(len(sets)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    assert all((min(p), max(p)) in want for p in links)

    def joined(pairs):
        root = list(range(len(sets)))
        for a, b in pairs:
            x, y = root[a], root[b]
            root = [min(x, y) if r in (x, y) else r for r in root]
        return root

    assert want and joined(links) == joined(want)


def test_white_space_is_folded(spark):
    text = "A\tb  c\x0b\x0c d\r\n \n x "
    got = [r.norm for r in lines.split_lines(spark.createDataFrame([(1, text)], "doc_id long, text string")).orderBy("line_no").collect()]
    assert got == ["a b c d", None, "x"]
