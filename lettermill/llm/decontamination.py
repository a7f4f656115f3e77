"""Benchmark decontamination by SimHash of item-sized windows."""

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import WordHashes, materialize, mix, shingles, union_all

#: Hamming radius of the 64-bit fingerprints, and the bit blocks of the multi-index. Two fingerprints within the radius agree in some block up to RADIUS // BLOCKS bits.
RADIUS, BLOCKS = 20, 7
#: Items of one pass; a larger benchmark is searched in blocks of so many items, each with an index of bounded size.
BLOCK_ITEMS = 4000
#: Bits of the table of item shingles that is asked first.
FILTER_BITS = 20


def bits(values: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of the 64 bits."""
    return np.unpackbits(values.astype("<u8").view(np.uint8).reshape(len(values), 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


class SimHashIndex:
    """The fingerprints of items (id, word hashes) of `width` words or more behind a multi-index, with their shingle counts. Items of one number of shingles stand side by side."""

    def __init__(self, items: list[tuple[int, np.ndarray]], width: int):
        self.width = width
        self.ids, self.counts, prints, lengths = [], [], [], []
        starts: dict[int, set[int]] = defaultdict(set)
        for item_id, words in sorted(items, key=lambda x: len(x[1])):
            own = shingles(words, width)
            self.ids.append(item_id)
            values, counts = np.unique(own, return_counts=True)
            self.counts.append(dict(zip(values.tolist(), counts.tolist(), strict=True)))
            prints.append(fingerprints(bits(mix(own)).sum(axis=0)[None])[0])
            lengths.append(len(own))
            for value in values.tolist():
                starts[value].add(len(own))
        self.prints, self.lengths = np.array(prints, np.uint64), np.array(lengths, np.int64)
        self.known = np.array(sorted(starts), np.uint64)
        self.windows = [np.array(sorted(starts[v]), np.int64) for v in self.known.tolist()]
        self.first = np.zeros(1 << FILTER_BITS, bool)
        self.first[(self.known >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
        edges = np.linspace(0, 64, BLOCKS + 1).astype(int)
        self.blocks = [(np.uint64(a), np.uint64((1 << (b - a)) - 1)) for a, b in zip(edges, edges[1:], strict=False)]
        self.near = []
        for shift, mask in self.blocks:
            every = np.arange(int(mask) + 1, dtype=np.uint64)
            self.near.append(np.bitwise_count(every[:, None] ^ ((self.prints >> shift) & mask)[None, :]) <= RADIUS // BLOCKS)

    def hits(self, words: np.ndarray, num: int, den: int) -> list[tuple[int, int, int, int, float]]:
        """(item, first word, words, Hamming distance, similarity) of the best window for each item of similarity num / den or more."""
        own = shingles(words, self.width)
        if not len(own) or not len(self.known):
            return []
        asked = np.flatnonzero(self.first[(own >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.known, own[asked]), len(self.known) - 1)
        shared = self.known[place] == own[asked]
        at, place = asked[shared], place[shared]
        if not len(at):
            return []
        windows: dict[int, set[int]] = defaultdict(set)
        for p, k in zip(at.tolist(), place.tolist(), strict=True):
            for m in self.windows[k].tolist():
                windows[m].update(range(max(0, min(p - m + 1, len(own) - m)), max(0, min(p, len(own) - m)) + 1))
        best: dict[int, tuple] = {}
        for m, chosen in windows.items():
            starts = np.array(sorted(chosen), np.int64)
            ends = np.minimum(starts + m, len(own))
            left, right = np.searchsorted(self.lengths, [m, m + 1])
            for cut in np.split(np.arange(len(starts)), np.flatnonzero(np.diff(starts) > m) + 1):
                lo, hi = starts[cut[0]], ends[cut[-1]]
                sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits(mix(own[lo:hi])), axis=0)])
                prints = fingerprints(sums[ends[cut] - lo] - sums[starts[cut] - lo])
                close = np.zeros((len(prints), right - left), bool)
                for (shift, mask), near in zip(self.blocks, self.near, strict=True):
                    close |= near[((prints >> shift) & mask).astype(np.int64), left:right]
                w, i = np.nonzero(close)
                far = np.bitwise_count(prints[w] ^ self.prints[left + i])
                for w, i, far in zip(*(x[far <= RADIUS].tolist() for x in (w, i, far)), strict=True):
                    start, end, item = int(starts[cut[w]]), int(ends[cut[w]]), int(left + i)
                    values, counts = np.unique(own[start:end], return_counts=True)
                    both = sum(min(c, self.counts[item].get(v, 0)) for v, c in zip(values.tolist(), counts.tolist(), strict=True))
                    all_ = end - start + int(self.lengths[item]) - both
                    if both * den >= num * all_:
                        found = (both / all_, -start, far)
                        if item not in best or found > best[item][0]:
                            best[item] = found, end - start
        return [(self.ids[item], -f[1], min(n + self.width - 1, len(words)), f[2], f[0]) for item, (f, n) in sorted(best.items())]


def indexes(items: list[tuple[int, bytes]], width: int) -> list[SimHashIndex]:
    """An index for the items of `width` words or more, and one for each smaller number of words, whose shingle is the whole item. Items without a word are left out."""
    hashes = WordHashes()
    by_width = defaultdict(list)
    for item_id, text in items:
        words = hashes.of(text)
        if len(words):
            by_width[min(width, len(words))].append((item_id, words))
    return [SimHashIndex(own, w) for w, own in sorted(by_width.items())]


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, width: int = 5, similarity: tuple[int, int] = (80, 100), block_items: int = BLOCK_ITEMS, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item that it contains: doc_id, item_id, start_word, n_words, hamming, similarity (the best window; the first of equal ones).

    A window has as many `width`-word shingles as the item (a shorter document
    is one window); an item of fewer words is one shingle of its own width, which
    a document has or has not. A window's SimHash is compared through the
    multi-index, and the multiset Jaccard similarity of the shingles, weighted by
    how often each occurs, decides. Only windows with a shingle of some item are
    hashed, since others have similarity 0. Items are searched in blocks of
    bounded size, one after the other; the hits of each are written.

    Null or empty texts and items match nothing; a null doc_id is reported as
    null; repeated rows are reported each. No other column is read.
    """
    n_blocks = max(1, -(-benchmark.count() // block_items))
    texts = docs.select(F.col(id_col).cast("long"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8"))
    numbered = benchmark.select(F.col(item_id_col).cast("long").alias("item_id"), F.encode(F.coalesce(F.col(item_text_col), F.lit("")), "UTF-8").alias("text"))

    def block(k: int) -> DataFrame:
        rows = numbered.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == k).toArrow()
        shared = docs.sparkSession.sparkContext.broadcast(indexes(sorted(zip(rows["item_id"].to_pylist(), rows["text"].to_pylist(), strict=True), key=repr), width))

        def search(batches: Iterator) -> Iterator:
            import pyarrow as pa

            kinds = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("start_word", pa.int32()), ("n_words", pa.int32()), ("hamming", pa.int32()), ("similarity", pa.float64())])
            hashes, parts = WordHashes(), shared.value
            for batch in batches:
                found = []
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    words = hashes.of(text)
                    found += [(doc_id, *hit) for own in parts for hit in own.hits(words, *similarity)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*found, strict=True)) or [[]] * 6, kinds.types, strict=True)], schema=kinds)

        hits = materialize(texts.mapInArrow(search, "doc_id long, item_id long, start_word int, n_words int, hamming int, similarity double"), "hits")
        # the next block's index takes the place of this one
        shared.destroy()
        return hits

    return union_all([block(k) for k in range(n_blocks)])


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of docs, all columns, that contain no benchmark item; rows with a null id stay."""
    hit = benchmark_hits(docs, benchmark, id_col=id_col, **options).select(F.col("doc_id").alias("__hit_id")).distinct()
    return docs.join(hit, F.col(id_col) == F.col("__hit_id"), "left_anti")
