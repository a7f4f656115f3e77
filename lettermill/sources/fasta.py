"""FASTA files, plain or gzip."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EXTENSIONS = ("fasta", "fna", "faa", "fa")


def read_fasta(spark: SparkSession, paths: str | list[str], extensions: tuple[str, ...] = EXTENSIONS) -> DataFrame:
    """filename, seq_id, description, sequence of the records of all files with one of the extensions (and .gz).

    Records are split by the reader itself at `>` behind a line end, so a file
    is as many tasks as it has splits. Text before the first `>` is left out.
    """
    rows = spark.read.option("lineSep", "\n>").option("pathGlobFilter", "*.{" + ",".join(e for x in extensions for e in (x, f"{x}.gz")) + "}").text(paths)
    rows = rows.select(F.col("_metadata.file_name").alias("filename"), "value")
    # only the first record of a file still has its sign
    head = F.regexp_replace(F.regexp_extract("value", r"^([^\r\n]*)", 1), "^>", "")
    body = F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s+", "")
    return rows.where(F.trim("value") != "").select("filename", F.regexp_extract(head, r"^(\S*)", 1).alias("seq_id"), F.trim(head).alias("description"), body.alias("sequence"))


def write_fasta(df: DataFrame, path: str, title_col: str = "description", compression: str = "none") -> None:
    """One record per row in text files (.txt, with gzip .txt.gz), which read_fasta reads with extensions=("txt",)."""
    df.select(F.concat(F.lit(">"), F.col(title_col), F.lit("\n"), F.col("sequence"))).write.mode("overwrite").text(path, compression=compression)
