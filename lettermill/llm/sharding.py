"""Sharding by proportional stratified interleaving, DataFrame functions only."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lettermill.llm.common import materialize

#: Rows that one window group holds on average; groups are hash buckets, so no source is ever ranked in one task.
BUCKET_ROWS = 16_384


def stratified_shards(docs: DataFrame, n_shards: int, seed: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per input row: doc_id, source, size, text_crc32, law, shard, slot, grown_shard.

    Within each source the rows are ranked in seeded random order. A row's
    fractional rank is (rank + phase of the source) / rows of the source; the
    phase spreads sources of few rows. All rows are then ordered by fractional
    rank, and shard s takes positions ceil(s n / k) to ceil((s + 1) n / k) - 1.
    So row counts differ by one at most (law `rows`), and each source's rows in
    a shard differ from its share by less than two.

    Ranks come from counts of hash buckets plus a rank inside the bucket: a
    source with a third of all rows is many buckets. Null sources are a source
    of their own; null text has size 8 and CRC 0; null or repeated ids are
    placed like others (rows that are alike may swap places). grown_shard is
    null: the law is not `key`. An empty table gives an empty result.
    """
    text, at = F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8"), ["key", "bucket"]
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.xxhash64(F.lit("source"), F.col(source_col).cast("string"), F.col(source_col).isNull()).alias("key"),
        F.xxhash64(F.lit(seed), F.col(id_col), text).alias("draw"),
        (F.octet_length(text) + F.lit(8)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    rows = materialize(rows, "rows")
    n = rows.count()
    n_buckets = max(1, -(-n // bucket_rows))
    rows = rows.withColumn("bucket", F.floor(F.shiftrightunsigned("draw", 11) / F.lit(float(1 << 53)) * n_buckets))
    counts = rows.groupBy(*at).agg(F.count("*").alias("n"))
    by_source = Window.partitionBy("key")
    starts = counts.select(*at, F.sum("n").over(by_source).alias("n_source"), (F.sum("n").over(by_source.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("start"))
    in_bucket = Window.partitionBy(*at).orderBy(F.shiftrightunsigned("draw", 11), "draw", "doc_id", "size", "text_crc32")
    phase = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "key"), 11) / F.lit(float(1 << 53))
    ranked = rows.withColumn("rank", F.row_number().over(in_bucket) - 1).join(starts, at)
    ranked = ranked.withColumn("fraction", (F.col("start") + F.col("rank") + phase) / F.col("n_source"))
    ranked = ranked.select("doc_id", "source", "key", "draw", "size", "text_crc32", "fraction", F.floor(F.col("fraction") * n_buckets).alias("bin"))
    ranked = materialize(ranked, "ranked")
    ahead = ranked.groupBy("bin").agg(F.count("*").alias("n"))
    ahead = ahead.select("bin", (F.sum("n").over(Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("start"))
    in_bin = Window.partitionBy("bin").orderBy("fraction", "key", "draw", "doc_id", "size", "text_crc32")
    placed = ranked.withColumn("place", F.row_number().over(in_bin) - 1).join(ahead, "bin").withColumn("place", F.col("start") + F.col("place"))
    placed = placed.withColumn("shard", F.expr(f"place * {n_shards} div {max(n, 1)}"))
    return placed.select(
        "doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("place") - F.expr(f"(shard * {n} + {n_shards - 1}) div {n_shards}")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
