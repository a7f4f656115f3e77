"""Exact deduplication by 128-bit content hash with comparison of bytes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import ascii_lower, materialize

#: A group with more than this share of all rows is joined by broadcast; there can be at most 1 / HOT_SHARE such groups.
HOT_SHARE = 0.001


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", normalize=ascii_lower) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are grouped by the MD5 (128 bits) of the normalised text and, inside a
    hash, by the text's bytes, so a collision never merges two texts. Partial
    aggregation folds copies before the shuffle; of each distinct text one copy
    per task moves. `keep`: "min" or "max" id stays.

    Null and empty texts are the same text. A null id loses against any other;
    a group of null ids only has keep_id null and its rows count as kept. Rows
    that repeat an id with the same text are one document: all have the same
    `kept`. An empty table gives an empty result. Other columns are not read.
    """
    best = {"min": F.min, "max": F.max}[keep]
    text = docs.select(F.col(id_col).alias("doc_id"), normalize(F.col(text_col)).alias("norm")).withColumn("digest", F.unhex(F.md5("norm")))
    rows = materialize(text.select("doc_id", "digest", F.unhex(F.sha2("norm", 256)).alias("sha")), "rows")
    groups = text.groupBy("digest", "norm").agg(best("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    groups = materialize(groups.select("digest", F.unhex(F.sha2("norm", 256)).alias("sha"), "keep_id", "group_size"), "groups")
    least = max(2.0, rows.count() * HOT_SHARE)
    hot, cold = groups.where(F.col("group_size") > least), groups.where(F.col("group_size") <= least)
    marked = rows.join(F.broadcast(hot), ["digest", "sha"], "left")
    found = marked.where("group_size IS NOT NULL").unionByName(marked.where("group_size IS NULL").select("doc_id", "digest", "sha").join(cold, ["digest", "sha"]))
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", normalize=ascii_lower) -> DataFrame:
    """The rows of docs, all columns, that exact_dedup keeps, told by id and text; so an id that repeats with another text brings nothing back.

    Of rows with equal id and equal text one stays: the first in the order of all
    their columns as JSON. So a group of null ids keeps one row.
    """
    kept = exact_dedup(docs, id_col, text_col, keep, normalize).where("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n"))
    kept = materialize(kept, "kept")
    # rows stand as one column each, so that no name of theirs can clash
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row"), F.col(id_col).alias("id"), F.sha2(normalize(F.col(text_col)), 256).alias("sha"))
    same = lambda some: [F.col("id").eqNullSafe(some["doc_id"]), F.col("sha") == some["text_sha256"]]
    single, several = kept.where("n = 1"), kept.where("n > 1")
    once = rows.join(single, same(single), "left_semi").select("row.*")
    repeated = rows.join(several, same(several), "left_semi").groupBy("id", "sha").agg(F.min_by("row", F.to_json("row")).alias("row"))
    return once.unionByName(repeated.select("row.*"))
