"""What several training-data operators share: scratch tables, text keys, hashed words."""

import tempfile
import uuid
from functools import reduce

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; without that setting one is made, in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/lettermill-{uuid.uuid4().hex}"


#: Setting under which Spark removes the shuffle files of an action when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, tag: str = "t") -> DataFrame:
    """Writes df as Parquet to the shared scratch folder and reads it back: lineage ends there and lost executors cost nothing that is done.

    Once the table is there, the shuffle files behind it are of no use and go. The
    tables stay until the folder that spark.checkpoint.dir names is cleared.
    """
    spark, path = df.sparkSession, f"{scratch_dir(df.sparkSession)}/{tag}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only; null counts as empty. Pure ASCII text takes the quicker built-in."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


class WordHashes(dict):
    """bytes -> 64-bit hash, remembered for up to `bound` words."""

    def __init__(self, bound: int = 400_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.bound:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: bytes) -> np.ndarray:
        """Hashes of the words `[^\\x20\\x09-\\x0D]+` of a text, A-Z lower-cased. bytes.split() and bytes.lower() know ASCII only, as wanted."""
        words = text.lower().split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of the k-word shingles in text order; fewer words give the whole sequence as one, no word none."""
    if not len(words):
        return words
    width = min(k, len(words))
    total = np.full(len(words) - width + 1, width, np.uint64)
    for i in range(width):
        total = mix(total + words[i : len(words) - width + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
    return mix(total)
