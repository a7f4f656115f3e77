"""K-mers of sequences as long tables: (seq_id, kmer), one row per window, pair or count.

Windows are cut by a look-ahead pattern, which is linear in the length of the
sequence; validity (all characters are classes of the alphabet) is part of it.
"""

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lettermill.functions.alphabets import alphabet_keys, key_pattern, reduce_sequence
from lettermill.operators.store import folder, numbered


def kmer_array(sequence: Column, k: int, alphabet="hydro") -> Column:
    """Valid windows of the recoded sequence in order, duplicates kept."""
    return F.regexp_extract_all(reduce_sequence(sequence, alphabet), F.lit(f"(?=({key_pattern(alphabet)}{{{k}}}))"), F.lit(1))


def kmer_windows(sequence: Column, k: int) -> Column:
    """All windows of a sequence, unfiltered."""
    return F.regexp_extract_all(sequence, F.lit(f"(?s)(?=(.{{{k}}}))"), F.lit(1))


def kmers(seqs: DataFrame, k: int, alphabet="hydro") -> DataFrame:
    """One row per valid window: the columns of seqs but sequence, pos (from 0) and kmer."""
    rows = seqs.select(*[c for c in seqs.columns if c != "sequence"], F.posexplode(kmer_windows(reduce_sequence(F.col("sequence"), alphabet), k)).alias("pos", "kmer"))
    return rows.where(F.col("kmer").rlike(f"^{key_pattern(alphabet)}{{{k}}}$"))


def kmer_rows(seqs: DataFrame, k: int, alphabet="hydro", keep: tuple[str, ...] = ("seq_id",)) -> DataFrame:
    """One row per valid window with the kept columns and kmer; cheaper than kmers() as no position is needed."""
    return seqs.select(*keep, F.explode(kmer_array(F.col("sequence"), k, alphabet)).alias("kmer"))


def kmer_counts(seqs: DataFrame, k: int, alphabet="hydro", basis: DataFrame | None = None) -> DataFrame:
    """seq_id, kmer, cnt: occurrences of the k-mers (of the basis) in each sequence.

    Sequences are dealt by seq_id, which moves each letter once; windows and
    counts, many times as large, stay where their sequence is.
    """
    counts = kmer_rows(seqs.select("seq_id", "sequence").repartition("seq_id"), k, alphabet).groupBy("seq_id", "kmer").agg(F.count("*").alias("cnt"))
    return harmonize(counts, basis) if basis is not None else counts


def presence(seqs: DataFrame, k: int, alphabet="hydro", basis: DataFrame | None = None) -> DataFrame:
    """Distinct seq_id, kmer. Distinct inside the row, so nothing is shuffled."""
    rows = seqs.select("seq_id", F.explode(F.array_distinct(kmer_array(F.col("sequence"), k, alphabet))).alias("kmer"))
    return harmonize(rows, basis) if basis is not None else rows


def kmer_totals(counts: DataFrame) -> DataFrame:
    """kmer, total over all sequences."""
    return counts.groupBy("kmer").agg(F.sum("cnt").alias("total"))


def kmer_basis(seqs: DataFrame, k: int, alphabet="hydro", min_filter: int = 0, by: str | None = "filename") -> DataFrame:
    """K-mers with more than min_filter occurrences (per value of `by`, or over all)."""
    keys = [by, "kmer"] if by else ["kmer"]
    return kmer_rows(seqs, k, alphabet, tuple(keys[:-1])).groupBy(*keys).agg(F.count("*").alias("cnt")).where(F.col("cnt") > min_filter).select(*keys, "cnt")


def feature_matrix(seqs: DataFrame, k: int, alphabet="hydro", min_filter: int = 1) -> DataFrame:
    """Presence of the k-mers with more than min_filter occurrences over all sequences."""
    return presence(seqs, k, alphabet, kmer_basis(seqs, k, alphabet, min_filter, by=None))


def kmer_space(spark: SparkSession, alphabet, k: int, most: int = 50_000_000) -> DataFrame:
    """All words of k classes; ValueError beyond `most`."""
    keys = alphabet_keys(alphabet)
    if len(keys) ** k > most:
        raise ValueError(f"{len(keys)}^{k} words are more than {most}")
    letters = [F.substring(F.lit(keys), F.expr(f"int(id div {len(keys) ** (k - 1 - i)} % {len(keys)}) + 1"), F.lit(1)) for i in range(k)]
    return spark.range(len(keys) ** k).select(F.concat(*letters).alias("kmer"))


def harmonize(rows: DataFrame, basis: DataFrame) -> DataFrame:
    """Rows of the k-mers of a basis; others go, and absent ones are simply not there."""
    return rows.join(basis.select("kmer").distinct(), "kmer", "left_semi").select(*rows.columns)


def to_vectors(counts: DataFrame, basis: DataFrame) -> DataFrame:
    """seq_id and features: sparse MLlib vectors in the order of basis (kmer, idx from 0); a sequence without any k-mer of the basis has an empty one.

    The parts of a vector are written as a table, in which they are read as one;
    so vectors are made by column functions, whatever the size of the basis.
    """
    spark, path = counts.sparkSession, folder(counts.sparkSession)
    cells = F.array_sort(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), F.col("cnt").cast("double").alias("value"))))
    present = counts.join(basis.select("kmer", "idx"), "kmer").groupBy("seq_id").agg(cells.alias("cells"))
    every = counts.select("seq_id").distinct().join(present, "seq_id", "left").withColumn("cells", F.coalesce("cells", F.array().cast("array<struct<idx: int, value: double>>")))
    parts = F.struct(F.lit(0).cast("tinyint").alias("type"), F.lit(basis.count()).cast("int").alias("size"), F.col("cells.idx").alias("indices"), F.col("cells.value").alias("values"))
    every.select("seq_id", parts.alias("features")).write.parquet(path)
    return spark.read.schema(StructType([counts.schema["seq_id"], StructField("features", VectorUDT())])).parquet(path)


def harmonize_dense(counts: DataFrame, basis: DataFrame) -> DataFrame:
    """seq_id and values, the counts in the order of basis (kmer, idx from 0) with 0 for absent ones; for export, as each row is as wide as the basis."""
    return to_vectors(counts, basis).select("seq_id", vector_to_array("features").alias("values"))


def common_basis(*bases: DataFrame) -> DataFrame:
    """Sorted distinct k-mers of all bases."""
    return reduce(DataFrame.unionByName, [b.select("kmer") for b in bases]).distinct().orderBy("kmer")


def indexed(basis: DataFrame) -> DataFrame:
    """The distinct k-mers of basis with idx, their place in order."""
    return numbered(basis.select("kmer").distinct(), ["kmer"])


def filter_by_rep(pairs: DataFrame, min_rep: int = 0, max_rep: int | None = None) -> DataFrame:
    """Rows of (seq_id, kmer) whose k-mer occurs in more than min_rep and fewer than max_rep sequences."""
    df = pairs.groupBy("kmer").agg(F.count("*").alias("df"))
    kept = (F.col("df") > min_rep) & (F.col("df") < max_rep if max_rep is not None else F.lit(True))
    return harmonize(pairs, df.where(kept))


def normalize_features(counts: DataFrame, lengths: DataFrame | None = None) -> DataFrame:
    """counts with value: cnt by the sequence's length (seq_id, length), or by 1."""
    if lengths is None:
        return counts.withColumn("value", F.col("cnt").cast("double"))
    return counts.join(lengths.select("seq_id", "length"), "seq_id").withColumn("value", F.col("cnt") / F.col("length")).select(*counts.columns, "value")


def compatibility(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: k_a, k_b, chars_a, chars_b (of two k-mer tables) and compatible. Each side is summed up before they meet."""

    def side(df: DataFrame, name: str) -> DataFrame:
        chars = df.select("kmer").distinct().select(F.char_length("kmer").alias("n"), F.explode(F.array_distinct(F.split("kmer", ""))).alias("c"))
        short = chars.groupBy("n", "c").count().where("c <> ''")
        return short.agg(F.min("n").alias(f"low_{name}"), F.max("n").alias(f"k_{name}"), F.array_join(F.array_sort(F.collect_set("c")), "").alias(f"chars_{name}"))

    same = (F.col("low_a") == F.col("k_a")) & (F.col("low_b") == F.col("k_b")) & (F.col("k_a") == F.col("k_b")) & (F.col("chars_a") == F.col("chars_b"))
    return side(a, "a").join(side(b, "b"), F.lit(True)).select("k_a", "k_b", "chars_a", "chars_b", same.alias("compatible"))


def check_compatible(a: DataFrame, b: DataFrame) -> bool:
    return bool(compatibility(a, b).first().compatible)
