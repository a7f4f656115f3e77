"""Token ids as Parquet list columns: written in order of ids, read back by column, row range or document."""

import re
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lettermill.llm.packing import byte_letters

#: The Latin letters, the digits and the white space among the characters up to U+02AF, by Unicode class.
LETTERS, DIGITS, SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ʯ", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
#: Where a byte-level tokenizer with its usual pattern cuts a text of these characters; it never joins across a cut.
CUTS = re.compile(rf" ?[{LETTERS}]+|'(?:[sdmt]|ll|ve|re)| ?[^{SPACE}{LETTERS}{DIGITS}]+| ?[{DIGITS}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Texts with other characters are left whole to the tokenizer, as are those with what may be the name of a special token.
OTHER = re.compile("[^\\x00-ʯ‐-‧‰-⁞€]")
#: Settings of a tokenizer file under which CUTS holds; with any other file whole texts are encoded.
BYTE_LEVEL = {"normalizer": None, "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}, "post_processor": None}


class CutIds(dict):
    """Cut of a text -> its token ids as little-endian 32-bit bytes.

    Up to twice `bound` cuts are remembered: when there are `bound` of them they
    become the older half, from which those that occur again come back.
    """

    #: One memory per file and Python worker, so that tasks after the first one start warm.
    made: dict = {}

    def __init__(self, path: str, bound: int = 500_000):
        import json

        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.bound, self.letters, self.older = Tokenizer.from_file(path), bound, byte_letters(), {}
        settings = json.loads(self.tokenizer.to_str())
        self.model = self.tokenizer.model
        self.raw = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        # a model of another kind, or special tokens of other names, ask for whole texts
        self.apart = all(settings[k] == v for k, v in BYTE_LEVEL.items()) and settings["model"]["type"] == "BPE" and all(t["content"].startswith("<|") for t in settings["added_tokens"])

    @classmethod
    def at(cls, path: str) -> "CutIds":
        if path not in cls.made:
            cls.made[path] = cls(path)
        return cls.made[path]

    def __missing__(self, cut: str) -> bytes:
        if len(self) >= self.bound:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(cut)
        if ids is None:
            shown = cut.encode().decode("latin-1").translate(self.letters)
            ids = b"".join([self.raw[t.id] for t in self.model.tokenize(shown)])
        self[cut] = ids
        return ids

    def of(self, text: str) -> bytes:
        if not self.apart or "<|" in text or not text.isascii() and OTHER.search(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.__getitem__, CUTS.findall(text)))


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """part, doc_id, start, n_tokens, ids of each document, in the order in which a task reads them; start counts from the beginning of the part (task)."""

    def encode(batches: Iterator) -> Iterator:
        import pyarrow as pa

        memory, part, before, end = CutIds.at(tokenizer_path), TaskContext.get().partitionId(), 0, int(end_id).to_bytes(4, "little")
        for batch in batches:
            found = [memory.of(text or "") + end for text in batch.column(1).to_pylist()]
            sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
            places = np.concatenate([[0], np.cumsum(sizes)])
            ids = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(np.frombuffer(b"".join(found), "<i4")))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), part, np.int32)), batch.column(0), pa.array(before + places[:-1]), pa.array(sizes), ids], names=["part", "doc_id", "start", "n_tokens", "ids"])
            before += int(places[-1])

    return docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`")).mapInArrow(encode, "part int, doc_id long, start long, n_tokens long, ids array<int>")


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", row_group_bytes: int = 32 << 20, page_bytes: int = 256 << 10, page_rows: int = 1000) -> None:
    """Writes the token ids of all documents below path: `tokens`, Parquet files in ascending order of doc_id, and `parts`, one row per file.

    A document is its token ids and then end_id; null or empty text is the end id
    alone. Rows are dealt by range of doc_id, sorted, encoded and written by one
    task per range; null ids come first, and rows that repeat an id stand side by
    side, parted by their texts where they are many. No rows give no files.

    Token ids are a list column with a dictionary (16 bits an id for 50,000
    words), ids and counts are delta-coded; row groups and pages are bounded, and
    the page index lets a reader that asks for some documents skip pages of both.
    The files know only what stands before a document in its own part: `parts`
    (part, first and last doc_id, rows, tokens, before) has the tokens of all
    parts before, and is read from the counts alone.
    """
    spark = docs.sparkSession
    ordered = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    # the salts part the rows of one id, or of one id and text, if they are many
    dealt = ordered.withColumn("__salt", F.monotonically_increasing_id()).repartitionByRange("doc_id", F.xxhash64("text"), "__salt").sortWithinPartitions("doc_id", F.xxhash64("text"), "__salt")
    coding = {"parquet.writer.version": "v2", "parquet.enable.dictionary": "true", "parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes, "parquet.page.row.count.limit": page_rows, "compression": "zstd", "parquet.compression.codec.zstd.level": 1, "maxRecordsPerFile": 0}
    coding |= {f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "start", "n_tokens")}
    encoded(dealt, tokenizer_path, end_id).write.options(**coding).parquet(f"{path}/tokens")
    counts = spark.read.parquet(f"{path}/tokens").groupBy("part").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
    # a row per file
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts.withColumn("before", F.coalesce(before, F.lit(0))).coalesce(1).write.parquet(f"{path}/parts")


def read_token_files(spark: SparkSession, path: str, columns: tuple[str, ...] = ("doc_id", "start", "n_tokens", "ids")) -> DataFrame:
    """The chosen columns of written documents, start counted over all files. A filter on doc_id reaches row groups and pages; without `ids` no token is read."""
    rows = spark.read.schema("part int, doc_id long, start long, n_tokens long, ids array<int>").parquet(f"{path}/tokens")
    if "start" in columns:
        parts = spark.read.parquet(f"{path}/parts").select("part", "before")
        rows = rows.join(parts, "part").withColumn("start", F.col("start") + F.col("before"))
    return rows.select(*columns)


def with_crc32(tokens: DataFrame) -> DataFrame:
    """tokens with ids replaced by ids_crc32: unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers."""
    kept = [f for f in tokens.schema if f.name != "ids"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", ids_crc32 long"

    def check(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            lists = batch.column(len(kept))
            raw, places = np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4").view("u1"), lists.offsets.to_numpy().astype(np.int64) * 4
            sums = np.fromiter((zlib.crc32(raw[a:b]) for a, b in zip(places[:-1], places[1:], strict=True)), np.int64, len(lists))
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(kept))], pa.array(sums)], names=[*[f.name for f in kept], "ids_crc32"])

    return tokens.select(*[f.name for f in kept], "ids").mapInArrow(check, schema)
