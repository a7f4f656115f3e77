"""The registered queries of the training-data operators and their SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.llm.common import ascii_lower, scratch_dir, table
from lettermill.llm.decontamination import benchmark_hits
from lettermill.llm.exact_dedup import exact_dedup
from lettermill.llm.katz import katz_scores
from lettermill.llm.lines import similar_lines
from lettermill.llm.merkle import leaf_digest, merkle_manifest
from lettermill.llm.neardup import jaccard_components
from lettermill.llm.packing import place_pieces, token_pieces
from lettermill.llm.pii import KINDS, find_pii
from lettermill.llm.quality import fit_quality, quality_grades, score_quality
from lettermill.llm.secrets import scan_secrets
from lettermill.llm.sharding import stratified_shards
from lettermill.llm.sql import ORACLE_SQL
from lettermill.llm.tokenfiles import read_token_files, with_crc32, write_token_files
from lettermill.llm.trie import prefix_trie, rebuilt, turn_rows

__all__ = ["ORACLE_SQL", "QUERIES"]


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="max")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_pieces(table(spark, sf_dir, "documents"), tokenizer_path())
    placed = place_pieces(pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")))
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), 3, (90, 100))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, quality_grades(table(spark, sf_dir, "labels")), 3)
    return score_quality(docs, model).drop("text")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    order = F.array(*map(F.lit, KINDS))
    place = lambda s: F.struct(F.array_position(order, s["kind"]).alias("k"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))
    joined = lambda spans: F.array_join(F.transform(F.array_sort(F.transform(spans, place)), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.expr(f"bigint(size(filter(base, s -> s.kind = '{k}')))").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"))


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stratified_shards(table(spark, sf_dir, "documents"), 24, seed=7)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "end", F.sha2("value", 256).alias("value_sha256"), F.round("probability", 9).alias("probability"), "is_secret")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_lines(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(turn_rows(table(spark, sf_dir, "conversations"))))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_dir(spark)
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return with_crc32(read_token_files(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


MANIFEST = ["doc_id", "source", "lang", "n_chars", "text"]


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = leaf_digest([F.when(F.col("text").isNotNull(), ascii_lower(F.col("text"))) if c == "text" else F.col(c) for c in MANIFEST])
    hit = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = merkle_manifest(docs, MANIFEST, presented=F.when(hit, tampered).otherwise(leaf_digest([F.col(c) for c in MANIFEST])))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_packing": op2_packing,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_quality": op4_quality,
    "op5_pii": op5_pii,
    "op6_katz": op6_katz,
    "op7_sharding": op7_sharding,
    "op8_secrets": op8_secrets,
    "op9_decontamination": op9_decontamination,
    "op10_line_dedup": op10_line_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_token_files": op12_token_files,
    "op13_merkle_manifest": op13_merkle_manifest,
}
