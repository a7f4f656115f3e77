"""Annotations, bases, count matrices, confidence tables, vectors and results."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lettermill.operators.sequences import dedupe_last

#: Columns of a wide count matrix.
INDEX, SEQUENCES, KMERS = "__index_level_0__", "Sequence count", "Kmer Count"


def read_annotations(spark: SparkSession, paths: list[str], annotation_col: str = "TIGRFAMs") -> DataFrame:
    """id, annotation of tab-separated files with a header; of an id's rows the last one, by the order of paths and rows, wins. `NA` is a value."""
    parts = [spark.read.csv(p, sep="\t", header=True).select(F.lit(i).alias("part"), F.monotonically_increasing_id().alias("row"), "id", F.col(annotation_col).alias("annotation")) for i, p in enumerate(paths)]
    rows = reduce(DataFrame.unionByName, parts)
    return dedupe_last(rows, ["id"], F.struct("part", "row")).select("id", "annotation")


def read_basis(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.trim("value").alias("kmer")).where("kmer <> ''")


def write_basis(basis: DataFrame, path: str) -> None:
    basis.select("kmer").distinct().orderBy("kmer").write.mode("overwrite").text(path)


def write_count_matrix(counts: DataFrame, sizes: DataFrame, path: str, kmers: list[str], most: int = 10_000) -> None:
    """Wide CSV for exchange: a row per annotation, `Totals` first, zeros empty. The columns are given and limited; Parquet of the long form is the store.

    counts: annotation, kmer, cnt; sizes: annotation, n_seqs, n_kmers.
    """
    if len(kmers) > most:
        raise ValueError(f"{len(kmers)} columns are more than {most}")
    wide = counts.groupBy("annotation").pivot("kmer", kmers).agg(F.sum("cnt"))
    rows = sizes.join(wide, "annotation", "left").select(F.col("annotation").alias(INDEX), F.col("n_seqs").alias(SEQUENCES), F.col("n_kmers").alias(KMERS), *kmers)
    rows.orderBy(F.col(INDEX) != "Totals", INDEX).coalesce(1).write.mode("overwrite").csv(path, header=True)


def read_count_matrix(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """counts (annotation, kmer, cnt) and sizes (annotation, n_seqs, n_kmers) of a wide CSV; empty is 0 and has no row."""
    wide = spark.read.csv(path, header=True)
    kmers = [c for c in wide.columns if c not in (INDEX, SEQUENCES, KMERS)]
    sizes = wide.select(F.col(INDEX).alias("annotation"), F.col(SEQUENCES).cast("long").alias("n_seqs"), F.col(KMERS).cast("long").alias("n_kmers"))
    counts = wide.unpivot([INDEX], kmers, "kmer", "cnt") if kmers else wide.select(INDEX, F.lit("").alias("kmer"), F.lit(None).alias("cnt")).limit(0)
    return counts.select(F.col(INDEX).alias("annotation"), "kmer", F.col("cnt").cast("long").alias("cnt")).where("cnt <> 0"), sizes


def write_confidence(confidence: DataFrame, path: str) -> None:
    """CSV of 101 rows: Difference (0.00 to 1.00), confidence, weight, sum."""
    rows = confidence.select((F.col("bin") / 100).alias("Difference"), "confidence", "weight", *[c for c in ("sum",) if c in confidence.columns])
    rows.coalesce(1).orderBy("Difference").write.mode("overwrite").csv(path, header=True)


def read_confidence(spark: SparkSession, path: str) -> DataFrame:
    """bin, confidence and, where there, weight and sum."""
    rows = spark.read.csv(path, header=True)
    value = rows.columns[1]
    more = [F.col(c).cast("long").alias(c) for c in ("weight", "sum") if c in rows.columns]
    return rows.select(F.rint(F.col(rows.columns[0]).cast("double") * 100).cast("int").alias("bin"), F.col(value).cast("double").alias("confidence"), *more)


def read_vectors_json(spark: SparkSession, paths: str | list[str], label: str | None = None) -> DataFrame:
    """filename, seq_id, vector, vec_len (and label) of JSON files, plain or gzip, with the parallel arrays seq_id and vector."""
    kinds = "seq_id array<string>, vector array<array<double>>"
    rows = spark.read.schema(kinds).option("multiLine", True).json(paths).select(F.col("_metadata.file_name").alias("filename"), F.explode(F.arrays_zip("seq_id", "vector")).alias("r"))
    rows = rows.select("filename", "r.seq_id", "r.vector", F.size("r.vector").alias("vec_len"))
    return rows if label is None else rows.withColumn("label", F.lit(label))


def write_vectors_json(vectors: DataFrame, path: str, rows_per_file: int = 1000) -> None:
    """vectors (seq_id, vector) as gzip JSON files that read_vectors_json() reads: each has the parallel arrays of about rows_per_file rows, so that no task reads a large one."""
    n = max(1, -(-vectors.count() // rows_per_file))
    dealt = vectors.select("seq_id", "vector", F.pmod(F.xxhash64("seq_id"), F.lit(n)).alias("file"))
    rows = F.array_sort(F.collect_list(F.struct("seq_id", "vector")))
    files = dealt.groupBy("file").agg(rows.alias("rows")).select("file", F.to_json(F.struct(F.col("rows.seq_id").alias("seq_id"), F.col("rows.vector").alias("vector"))).alias("value"))
    files.write.partitionBy("file").text(path, compression="gzip")


def write_vectors(vectors: DataFrame, path: str) -> None:
    """vectors: filename, sequence_id, sequence, sequence_length, kmers."""
    vectors.write.mode("overwrite").parquet(path)


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_nested(df: DataFrame, path: str, alphabet: str, k: int, nested: bool = True) -> None:
    """Parquet below alphabet=.../k=..., or flat."""
    if not nested:
        df.write.mode("overwrite").parquet(path)
        return
    df.withColumns({"alphabet": F.lit(alphabet), "k": F.lit(f"{k:02}")}).write.mode("append").partitionBy("alphabet", "k").parquet(path)


def write_csv_results(df: DataFrame, path: str, compress: bool = False) -> None:
    df.write.mode("overwrite").csv(path, header=True, compression="gzip" if compress else "none")
