"""Corpus pipeline: documents through five of the training-data operators, each stage on all that the one before kept."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.llm.common import materialize, table
from lettermill.llm.decontamination import decontaminate
from lettermill.llm.exact_dedup import drop_exact_copies
from lettermill.llm.neardup import drop_near_copies
from lettermill.llm.packing import place_pieces, token_pieces
from lettermill.llm.quality import fit_quality, free_prefix, quality_grades, score_quality
from lettermill.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the best grade is high enough; fitted on rated ones.

    Null and empty texts have score 0 and go or stay by the thresholds; rows with
    a null id and repeated rows are scored like others. Without ratings the
    thresholds are not fitted. Columns of any name stay as they are.
    """
    model = fit_quality(docs, quality_grades(table(spark, sf_dir, "labels")), 3)
    keep = free_prefix(docs.columns, "quality_") + "keep"
    return score_quality(docs, model, prefix="quality_").where(F.col(keep)).select(*[F.col(f"`{c}`") for c in docs.columns])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each text; null counts as empty. Null ids come last, and of rows with equal id and text one stays."""
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at a similarity of 0.8. Texts without words, rows with a null id and rows of a group that repeat its smallest id stay."""
    return drop_near_copies(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item. Rows without words or with a null id stay, as do all without a benchmark; rows that repeat an id go together."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of 2048 tokens. Every row has a piece, also one with a null id or text and a repeated one; no row, no piece."""
    pieces = token_pieces(docs, tokenizer_path()).select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return place_pieces(pieces)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("benchmark", benchmark), ("packing", packing)]
#: Trained scores and tokenisation have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        # each stage reads a table, not the plans of the stages before it
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
