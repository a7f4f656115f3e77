"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns, for every operator."""

import pytest
from pyspark.sql import functions as F

from lettermill.llm import katz, lines, neardup, packing, pii, quality, secrets, sharding
from lettermill.llm.decontamination import benchmark_hits, decontaminate
from lettermill.llm.exact_dedup import drop_exact_copies, exact_dedup

KINDS = "doc_id long, text string, lang string, source string, n_chars long, score string"


@pytest.fixture(scope="module")
def docs(spark, small_dir):
    rows = spark.read.parquet(f"{small_dir}/documents.parquet")
    return rows.unionByName(rows.where("doc_id = 7")).unionByName(rows.where("doc_id = 8").withColumn("doc_id", F.lit(None).cast("long")))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KINDS)


def test_exact_dedup(docs, empty):
    got = {r.doc_id: r for r in exact_dedup(docs, keep="max").collect()}
    assert (got[0].keep_id, got[0].group_size, got[1].kept) == (1, 2, True)  # null and empty are one text; blanks are not empty
    assert got[2].group_size == 1 and got[3].keep_id == 4 and got[7].keep_id == 9 and got[9].group_size == 3
    assert got[None].keep_id == 8  # a null id loses
    assert exact_dedup(docs).count() == docs.count() and exact_dedup(empty).count() == 0
    assert set(drop_exact_copies(docs).columns) == set(docs.columns)


def test_sharding(docs, empty):
    rows = sharding.stratified_shards(docs, 4, bucket_rows=3).collect()
    sizes = sorted(sum(r.shard == s for r in rows) for s in range(4))
    assert len(rows) == docs.count() and sizes[-1] - sizes[0] <= 1
    for s in range(4):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert next(r for r in rows if r.doc_id == 0).size == 8
    assert sharding.stratified_shards(empty, 4).count() == 0


def test_shards_match_the_mixture(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 7)).alias("source"))
    rows = sharding.stratified_shards(docs, 24, bucket_rows=100).groupBy("shard").agg(F.count(F.when(F.col("source") == "hot", 1)).alias("hot")).collect()
    assert max(r.hot for r in rows) - min(r.hot for r in rows) <= 2


def test_jaccard(docs, empty):
    got = {r.doc_id: r for r in neardup.jaccard_components(docs, 3, (90, 100)).collect()}
    assert got[0].n_shingles == got[1].n_shingles == got[2].n_shingles == 0 and got[1].component_id == 1
    assert got[5].n_shingles == got[6].n_shingles == 1 and got[3].component_id == got[4].component_id == 3
    assert got[9].component_id == 7 and got[8].component_id == 8 and got[11].n_shingles == 1
    assert got[None].component_id is None
    assert neardup.jaccard_components(empty).count() == 0


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(i, 1, int(i % 2)) for i in range(12)] + [(3, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(docs, quality.quality_grades(labels), 3)
    rows = quality.score_quality(docs, model, prefix="__")
    assert rows.count() == docs.count() and set(docs.columns) < set(rows.columns)
    assert quality.score_quality(empty, quality.fit_quality(empty, quality.quality_grades(labels), 3)).count() == 0


def test_pii(docs, empty):
    spans = pii.find_pii(docs)
    got = {r.doc_id: [s.kind for s in r.base] for r in spans.collect()}
    assert got[14] == ["email", "ip", "phone"] and got[0] == [] and got[12] == []
    text = pii.redact(docs, spans).where("doc_id = 14").first().text
    assert "[EMAIL]" in text and "[IP]" in text and "[PHONE]" in text and "a.b@c.de" not in text
    assert pii.find_pii(empty).count() == 0


def test_katz(docs, empty):
    rows = katz.katz_scores(docs).collect()
    assert len(rows) == docs.count()
    assert all(r.score <= 0 and r.n_known <= r.n_tokens for r in rows)
    assert next(r for r in rows if r.doc_id == 0).n_tokens == 1
    assert katz.katz_scores(empty).count() == 0


def test_secrets(docs, empty):
    found = secrets.scan_secrets(docs).where("doc_id = 14 AND is_secret").collect()
    assert [(r.start, r.end, r.value) for r in found] == [(9, 49, "1a6c4f7bcf8c070fc75a8f6f8ed4b9a36b13d44c")]
    assert secrets.scan_secrets(empty).count() == 0


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog near the river bank"), (2, None), (3, "")], "item_id long, text string")
    hits = {(r.doc_id, r.item_id) for r in benchmark_hits(docs, items).where("similarity >= 0.999").collect()}
    assert hits == {(7, 1), (9, 1), (10, 1), (13, 1)}
    assert benchmark_hits(empty, items).count() == 0 and benchmark_hits(docs, items.where("false")).count() == 0
    assert decontaminate(docs, items).where("doc_id = 7").count() == 0


def test_lines(docs, empty):
    rows = {(r.doc_id, r.line_no): r for r in lines.similar_lines(docs).collect()}
    assert rows[None, 0].kept and not rows[8, 0].kept and rows[None, 0].component_id == rows[8, 0].component_id  # a null id sorts first
    assert rows[0, 0].kept and rows[0, 0].component_id is None
    assert rows[7, 0].kept and not rows[9, 0].kept and not rows[13, 1].kept and rows[13, 2].kept
    assert lines.similar_lines(empty).count() == 0
    text = lines.drop_similar_lines(docs.where("doc_id IN (7, 13)").distinct()).where("doc_id = 13").first().text
    assert text == "other line of a different kind altogether"


def test_packing(docs, empty):
    path = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")
    pieces = packing.token_pieces(docs, path, 64)
    rows = packing.place_pieces(pieces.drop("ids"), 64, 500).collect()
    assert len(rows) == pieces.count()
    by: dict = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for inside in by.values():
        end = 0
        for offset, length in sorted(inside):
            assert offset == end
            end += length
        assert end <= 64
    whole = packing.pack_documents(docs, path, 64)
    assert whole.agg(F.sum("length")).first()[0] == sum(r.length for r in rows) and whole.where("length * 4 <> octet_length(ids)").count() == 0
    assert packing.place_pieces(packing.token_pieces(empty, path).drop("ids")).count() == 0
