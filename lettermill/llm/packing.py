"""Best-fit packing of tokenised documents into sequences by the sum-of-squares rule."""

import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import materialize

#: White space that the tokenizer drops; str.split() also splits at \x1c-\x1f, which the tokenizer reads as symbols.
SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
SEPARATORS = re.compile("[\x1c-\x1f]")
#: Letters and ASCII marks behind them, which the tokenizer encodes apart. Apostrophes can go with letters and are left to the tokenizer.
PLAIN = re.compile(r"""([^\W\d_]+)([!"#$%&()*+,\-./:;<=>?@\[\\\]^_`{|}~]+)?""")
#: Settings of a tokenizer file under which words and marks can be encoded apart; any other file encodes whole texts.
WORD_BPE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
#: Pieces that one packing task takes on average.
GROUP_PIECES = 20_000


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for letters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


class ChunkIds(dict):
    """Text between white space -> its token ids as little-endian 32-bit bytes; the tokenizer never joins across white space. Bounded.

    The vocabulary has far more chunks than words, so words are remembered apart
    from the marks behind them, and a word goes straight to the BPE model.
    """

    def __init__(self, path: str, bound: int = 300_000):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.bound, self.parts, self.letters = Tokenizer.from_file(path), bound, {}, byte_letters()
        self.model = self.tokenizer.model
        settings = json.loads(self.tokenizer.to_str())
        self.apart = all(settings[k] == v for k, v in WORD_BPE.items()) and settings["model"]["type"] == "BPE"

    def part(self, text: str) -> bytes:
        """Ids of lower-case letters, or of marks."""
        ids = self.parts.get(text)
        if ids is None:
            if len(self.parts) >= self.bound:
                self.parts.clear()
            shown = text if text.isascii() else text.encode().decode("latin-1").translate(self.letters)
            ids = self.parts[text] = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(shown)])
        return ids

    def encode(self, chunk: str) -> bytes:
        return np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()

    def __missing__(self, chunk: str) -> bytes:
        if len(self) >= self.bound:
            self.clear()
        plain = PLAIN.fullmatch(chunk)
        word = plain[1].lower() if plain else ""
        # a final sigma is lowered in another way, and letters that compose change under NFC
        if plain and (word.isascii() or "\u03a3" not in chunk and word.isalpha() and unicodedata.is_normalized("NFC", plain[1])):
            ids = self.part(word) + (self.part(plain[2]) if plain[2] else b"")
        else:
            ids = self.encode(chunk)
        self[chunk] = ids
        return ids

    def of(self, text: str) -> bytes:
        if not self.apart:
            return self.encode(text)
        chunks = SPACES.split(text) if SEPARATORS.search(text) else text.split()
        return b"".join(map(self.__getitem__, chunks))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length. Largest first, each goes to that open bin with room for which the sum over gaps of (open bins with this
    gap) squared becomes smallest; of equal choices the tightest gap wins. Full bins have no gap and don't count; a new bin is opened only when
    no open one has room."""
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    n_bins = 0
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        room = np.flatnonzero(count[size:capacity])
        if len(room):
            change = 1 - 2 * count[room + size] + np.where(room > 0, 2 * count[room] + 1, 0)
            gap = size + int(room[change.argmin()])
            at = open_bins[gap].pop()
            count[gap] -= 1
        else:
            gap, at, n_bins = capacity, n_bins, n_bins + 1
        bins[i], offsets[i] = at, capacity - gap
        if gap > size:
            count[gap - size] += 1
            open_bins[gap - size].append(at)
    return bins, offsets


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length, ids (little-endian 32-bit binary).

    A document is its token ids and then end_id. Only documents of more than
    `capacity` ids are cut, into pieces of that length; the last may be shorter.
    Null or empty text is the end id alone. Ids of rows may be null or repeat.
    """
    width = 4 * capacity

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        memo = ChunkIds(tokenizer_path)
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = memo.of(text or "") + end
                rows += [(doc_id, k, k * capacity, min(capacity, len(ids) // 4 - k * capacity), ids[k * width : (k + 1) * width]) for k in range(-(-len(ids) // width))]
            kinds = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows, strict=True)) or [[]] * 5, kinds.types, strict=True)], schema=kinds)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(cut, "doc_id long, piece int, start long, length long, ids binary")


def place_pieces(pieces: DataFrame, capacity: int = 2048, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """pieces (doc_id, piece, length and any other columns) with sequence_id and offset.

    Pieces are dealt by hash into groups of about `group_pieces`, and each group
    is packed by itself with sum_of_squares; a group leaves a sequence or two
    unfilled. Sequences are gapless from offset 0. No row is dropped: rows with a
    null doc_id and repeated rows are pieces like others. Equal lengths are taken
    in the order in which they reach the task. Columns sequence_id and offset of
    the input are replaced. No pieces give no rows; a null or too large length is
    an error.
    """
    pieces = materialize(pieces.drop("sequence_id", "offset", "__group"), "pieces")
    n_groups = max(1, -(-pieces.count() // group_pieces))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def pack(table):
        import pyarrow as pa

        bins, offsets = sum_of_squares(table.column("length").to_numpy(), capacity)
        group = table.column("__group")[0].as_py()
        return table.drop_columns(["__group"]).append_column("sequence_id", pa.array(bins + (group << 40))).append_column("offset", pa.array(offsets))

    # the place in the written table tells rows with null or repeated ids apart
    salted = pieces.withColumn("__group", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(n_groups)))
    return salted.groupBy("__group").applyInArrow(pack, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per sequence: sequence_id, length, ids (binary, little-endian 32-bit) and members (doc_id, piece, start, length, offset) in order of offset."""
    placed = place_pieces(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col), capacity)
    members = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "start", "length", "ids")))
    packed = placed.groupBy("sequence_id").agg(members.alias("m"))  # a sequence holds `capacity` ids at most
    return packed.select(
        "sequence_id", F.expr("aggregate(m.length, 0L, (a, x) -> a + x)").alias("length"), F.expr("unhex(array_join(transform(m.ids, x -> hex(x)), ''))").alias("ids"),
        F.expr("transform(m, x -> named_struct('doc_id', x.doc_id, 'piece', x.piece, 'start', x.start, 'length', x.length, 'offset', x.offset))").alias("members"),
    )
