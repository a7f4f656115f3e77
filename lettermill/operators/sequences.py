"""Operators on sequences: (filename, seq_id, sequence, ...)."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.operators.store import running


def flag_background(seqs: DataFrame, background_files: list[str] | DataFrame) -> DataFrame:
    """seqs with `background`: whether filename is one of the given names, or occurs in the column filename of the given table."""
    if isinstance(background_files, DataFrame):
        marks = background_files.select("filename").distinct().withColumn("background", F.lit(True))
        return seqs.join(marks, "filename", "left").withColumn("background", F.coalesce("background", F.lit(False)))
    return seqs.withColumn("background", F.coalesce(F.col("filename").isin(background_files), F.lit(False)) if background_files else F.lit(False))


def count_sequences(seqs: DataFrame) -> DataFrame:
    """filename, n_sequences."""
    return seqs.groupBy("filename").agg(F.count("*").alias("n_sequences"))


def filter_min_sequences(seqs: DataFrame, k: int) -> DataFrame:
    """Sequences of the files that have k or more."""
    return seqs.join(count_sequences(seqs).where(F.col("n_sequences") >= k), "filename", "left_semi")


def dedupe_last(df: DataFrame, keys: list[str], position: Column) -> DataFrame:
    """Of the rows of equal keys, the one of the largest position; rows of equal position too are told apart by all columns."""
    last = F.max_by(F.struct(*df.columns), F.struct(position, F.struct(*df.columns)))
    return df.groupBy(*[F.col(c).alias(f"__{c}") for c in keys]).agg(last.alias("row")).select("row.*")


def fragment(seqs: DataFrame, version: str, frag_length: int, location: str, min_length: int, seed: int = 0) -> DataFrame:
    """Sliding fragments of each sequence: seqs with `sequence` replaced and `fragment` numbered from 0.

    version: "absolute" length or "percent" of the sequence, rounded down.
    location: "start", "end" or "random" keep one fragment, anything else all.
    Fragments below min_length go. The random one depends on seed and seq_id.
    """
    n = F.char_length("sequence")
    size = {"absolute": F.lit(frag_length), "percent": F.floor(n * frag_length / 100).cast("int")}[version]
    rows = seqs.withColumns({"__size": size, "__count": n - size + 1}).where((F.col("__count") > 0) & (F.col("__size") >= min_length))
    at = {"start": F.lit(0), "end": F.col("__count") - 1, "random": F.pmod(F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "seq_id")), 1, 8), 16, 10).cast("long"), "__count")}
    if location in at:
        rows = rows.withColumns({"__at": at[location].cast("int"), "fragment": F.lit(0)})
    else:
        rows = rows.withColumn("__at", F.explode(F.sequence(F.lit(0), F.col("__count") - 1))).withColumn("fragment", F.col("__at"))
    return rows.withColumn("sequence", F.substring("sequence", F.col("__at") + 1, F.col("__size"))).select(*seqs.columns, "fragment")


def binary_label(df: DataFrame, family: str, label_col: str = "label") -> DataFrame:
    """df with in_family: 1 if the label is the family, else 0."""
    return df.withColumn("in_family", F.when(F.col(label_col) == family, 1).otherwise(0))


def stratified_order(df: DataFrame, by: list[str], seed: int, id_col: str = "seq_id", name: str = "place") -> DataFrame:
    """df with the shuffled position, from 0, among the rows of equal `by`, and their number as name_total; a group with most rows is spread over tasks."""
    drawn = df.withColumn("__draw", F.md5(F.concat_ws(":", F.lit(seed), id_col)))
    placed = running(drawn, by, ["__draw", id_col], {name: F.lit(1)}, totals=True)
    return placed.select(*df.columns, (F.col(name) - 1).alias(name), f"{name}_total")
