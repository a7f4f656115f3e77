"""Katz backoff language model: Good-Turing discounts, exactly normalised backoff weights.

Counting and scoring meet in one shuffle. Documents are dealt into groups of
bounded size; a group asks each bucket of bigrams for the counts of its distinct
bigrams and brings its own training counts along. Buckets hold whole contexts,
so they know what backoff weights need; contexts too frequent for one bucket are
spread over all and summed apart. Keys travel packed, not as rows.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import ascii_lower, materialize, mix

#: Counts up to this are discounted.
K = 5
#: Words that a broadcast vocabulary may have (12 bytes each); beyond, score_by_joins() does the work. Words that the driver takes in at once.
MAX_VOCABULARY, SLICE = 24_000_000, 2_000_000
#: Text bytes of a group, training tokens of a bucket; a context with more than 1 / HOT of the tokens is spread over the buckets.
GROUP_BYTES, BUCKET_TOKENS, HOT = 10_000_000, 1_000_000, 2000
#: Stands for the end of a text; no word has a space.
END = b" "


def discounts(n: list[int]) -> np.ndarray:
    """Factors for counts 0 to K, from n[r], the number of types seen r times (r up to K + 1). Where the counts allow no Good-Turing factors
    between 0 and 1, half an occurrence is taken off instead."""
    r = np.arange(1, K + 1)
    half = np.concatenate([[1.0], (r - 0.5) / r])
    if not all(n[1 : K + 2]):
        return half
    common = (K + 1) * n[K + 1] / n[1]
    d = np.array([((x + 1) * n[x + 1] / (x * n[x]) - common) / (1 - common) if common != 1 else 2 for x in r])
    return np.concatenate([[1.0], d]) if np.all((d > 0) & (d < 1)) else half


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return counts * np.where(counts <= K, d[np.minimum(counts, K)], 1.0)


def squeezed(keys: np.ndarray) -> bytes:
    """Sorted keys as compressed differences, their bytes of equal place side by side."""
    return zlib.compress(np.diff(keys, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def spread(packed: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(zlib.decompress(packed), np.uint8).reshape(8, -1).T).view("<u8").ravel(), dtype=np.uint64)


def squeezed_counts(counts: np.ndarray) -> bytes:
    return zlib.compress(counts.astype("<u4").tobytes(), 1)


def spread_counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(packed), "<u4")


@dataclass
class Vocabulary:
    """Words of the training texts (sorted 64-bit hashes) with counts; ids follow this order, then the start of a text, then unknown words."""

    hashes: np.ndarray
    counts: np.ndarray
    texts: int

    def __post_init__(self):
        self.size, self.tokens = len(self.hashes), int(self.counts.sum())
        # two more counts of 0, for the start of a text and unknown words, so no lookup copies the table
        small = self.tokens < 1 << 32
        self.padded = np.zeros(self.size + 2, np.uint32 if small else np.int64)
        self.padded[: self.size] = self.counts
        self.counts = self.padded[: self.size]
        self.start, self.unknown = self.size, self.size + 1
        of = [0, *(int((self.counts == r).sum()) for r in range(1, K + 2))]
        self.d = discounts(of)
        taken = sum(r * n * (1 - float(d)) for r, (n, d) in enumerate(zip(of[: K + 1], self.d, strict=True)))
        self.left = 1.0 - (self.tokens - taken) / max(1, self.tokens)
        self.scale = 1.0
        if self.left <= 0:
            self.left, self.scale = 1 / (self.tokens + 1), self.tokens / (self.tokens + 1)

    def __getstate__(self):
        return {k: x for k, x in self.__dict__.items() if k != "counts"}

    def __setstate__(self, state):
        self.__dict__.update(state, counts=state["padded"][: state["size"]])

    def probability(self, ids: np.ndarray) -> np.ndarray:
        """Unigram probability; all unknown words together have what discounts leave."""
        counts = self.padded[np.minimum(ids, self.unknown)].astype(np.int64)
        return np.where(ids < self.size, self.scale * discounted(counts, self.d) / max(1, self.tokens), self.left)

    def context_counts(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids == self.start, self.texts, self.padded[np.minimum(ids, self.unknown)].astype(np.int64))

    def hot(self) -> np.ndarray:
        """Ids of the contexts that are spread; fewer than HOT + 1."""
        found = np.flatnonzero(self.counts > self.tokens // HOT)
        return np.append(found, self.start) if self.texts * HOT > self.tokens else found


def word_ids(texts: list[bytes], v: Vocabulary) -> list[np.ndarray]:
    """Word ids of each text, its end included. The distinct words of all are looked up at once."""
    words = {END}
    for text in texts:
        words.update(text.lower().split())
    words = list(words)
    keys = np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)
    at = np.searchsorted(v.hashes, keys)
    known = v.hashes[np.minimum(at, max(0, v.size - 1))] == keys if v.size else np.zeros(len(keys), bool)
    ids = dict(zip(words, np.where(known & (at < v.size), at, v.unknown).tolist(), strict=True))
    out = []
    for text in texts:
        own = text.lower().split()
        own.append(END)
        out.append(np.fromiter(map(ids.__getitem__, own), np.int64, len(own)))
    return out


def bigrams(ids: list[np.ndarray], start: int) -> np.ndarray:
    """Keys (context << 32 | word) of each token of the texts."""
    every = np.concatenate(ids)
    before = np.roll(every, 1)
    before[np.cumsum([0, *(len(x) for x in ids[:-1])])] = start
    return ((before << 32) | every).astype(np.uint64)


def buckets_of(keys: np.ndarray, hot: np.ndarray, n_buckets: int) -> np.ndarray:
    context = keys >> np.uint64(32)
    return (mix(np.where(np.isin(context, hot.astype(np.uint64)), keys, context)) % np.uint64(n_buckets)).astype(np.int64)


def context_stats(keys: np.ndarray, counts: np.ndarray, v: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Contexts of sorted seen keys, and per context: types seen 1 to K times, tokens of types seen more often, unigram probability of its words."""
    context = (keys >> np.uint64(32)).astype(np.int64)
    which, at = np.unique(context, return_inverse=True)
    p = v.probability((keys & np.uint64(0xFFFFFFFF)).astype(np.int64))
    columns = [np.bincount(at, counts == r, len(which)) for r in range(1, K + 1)] + [np.bincount(at, np.where(counts > K, counts, 0), len(which)), np.bincount(at, p, len(which))]
    return which, np.stack(columns, axis=1) if len(which) else np.zeros((0, K + 2))


def backoff(stats: np.ndarray, total: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Backoff weight of contexts, and a factor on their seen words: 1, or total / (total + 1) where discounts leave nothing."""
    seen = (stats[:, :K] @ (d[1:] * np.arange(1, K + 1)) + stats[:, K]) / total
    factor = np.where(seen < 1 - 1e-12, 1.0, total / (total + 1))
    return (1 - seen * factor) / (1 - stats[:, K + 1]), factor


def count_words(texts: DataFrame) -> DataFrame:
    """(word, c): 64-bit hashes of the words of the rows with held_out false, with counts; the end of a text is a word."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        counts: dict[bytes, int] = {}

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(np.array([xxhash.xxh3_64_intdigest(w) for w in counts], np.uint64).view(np.int64)), pa.array(list(counts.values()), pa.int64())], names=["word", "c"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for word in text.lower().split():
                    counts[word] = counts.get(word, 0) + 1
                counts[END] = counts.get(END, 0) + 1
                if len(counts) > 500_000:
                    yield rows()
                    counts.clear()
        if counts:
            yield rows()

    return texts.where("NOT held_out").select("text").mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def katz_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out=None, max_vocabulary: int = MAX_VOCABULARY) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    A bigram Katz model is trained on the rows whose `held_out` (a column,
    default crc32(id as text) mod 10 = 0) is false, and all rows are scored with
    log10 probabilities. Tokens are the words `[^\\x20\\x09-\\x0D]+`, A-Z
    lower-cased, and one end. p(w | v) is the discounted share if the bigram is
    known, else backoff(v) * p(w); unknown words share what the unigram discounts
    leave. A context that was never seen backs off with weight 1, and one whose
    counts are all above K sets 1 / (count + 1) aside.

    base_score: unigrams with 0.1 added to each of the known words' counts and
    one more. Null and empty texts are the end token alone; null ids count as the
    text ''. Repeated rows count each. Without training rows every word is
    unknown. Other columns are not read.
    """
    if held_out is None:
        held_out = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 10 == 0
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), text.alias("text"))
    packed = rows.withColumn("text", F.encode("text", "UTF-8"))
    words = materialize(count_words(packed), "unigrams")
    n_words = words.count()
    if n_words > max_vocabulary:
        return score_by_joins(rows)
    sizes = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("bytes"), F.count(F.when(~F.col("held_out"), 1)).alias("texts")).first()
    # slices of the range of hashes in order, so the driver never holds more than one besides the vocabulary
    top = max(0, -(-n_words // SLICE) - 1).bit_length()
    hashes, counts = [], []
    for i in range(1 << top):
        table = (words.where(F.shiftrightunsigned("word", 64 - top) == i) if top else words).toArrow()
        own = table["word"].to_numpy().view(np.uint64)
        order = np.argsort(own)
        hashes.append(own[order])
        counts.append(table["c"].to_numpy()[order].astype(np.uint32 if table.num_rows and int(table["c"].to_numpy().max()) < 1 << 32 else np.int64))
    v = Vocabulary(np.concatenate(hashes), np.concatenate(counts), sizes.texts)
    del hashes, counts
    shared = docs.sparkSession.sparkContext.broadcast(v)
    n_groups, n_buckets = max(1, -(-(sizes.bytes or 0) // GROUP_BYTES)), max(1, -(-v.tokens // BUCKET_TOKENS))
    grouped = packed.withColumn("grp", F.pmod(F.xxhash64("doc_id", "text"), F.lit(n_groups)))

    def ask(table):
        import pyarrow as pa

        own = shared.value
        held = table.column("held_out").to_pylist()
        ids = word_ids(table.column("text").to_pylist(), own)
        keys, at = np.unique(bigrams(ids, own.start), return_inverse=True)
        train = np.bincount(at, np.repeat(~np.array(held), [len(x) for x in ids]), len(keys)).astype("<u4")
        bucket = buckets_of(keys, own.hot(), n_buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        parts = [(b, order[cuts[b] : cuts[b + 1]]) for b in range(n_buckets) if cuts[b] < cuts[b + 1]]
        group = table.column("grp")[0].as_py()
        return pa.table({"grp": pa.array([group] * len(parts), pa.int64()), "bucket": pa.array([b for b, _ in parts], pa.int64()), "keys": pa.array([squeezed(keys[p]) for _, p in parts], pa.binary()), "counts": pa.array([squeezed_counts(train[p]) for _, p in parts], pa.binary())})

    asked = grouped.groupBy("grp").applyInArrow(ask, "grp long, bucket long, keys binary, counts binary")

    def answer(table):
        import pyarrow as pa

        own = shared.value
        hot = own.hot()
        parts = [(spread(k), spread_counts(c)) for k, c in zip(table.column("keys").to_pylist(), table.column("counts").to_pylist(), strict=True)]
        keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([c for _, c in parts]), len(keys)).astype(np.int64)
        seen = counts > 0
        contexts, stats = context_stats(keys[seen], counts[seen], own)
        wide = np.isin(contexts, hot)
        groups = table.column("grp").to_pylist()
        cut = np.cumsum([0, *(len(k) for k, _ in parts)])
        out = {"grp": [], "bucket": [], "counts": [], "contexts": [], "stats": []}
        for i, group in enumerate(groups):
            mine = counts[at[cut[i] : cut[i + 1]]]
            # statistics of those contexts of this group that it needs: they back off, or discounts leave them nothing; but for spread ones
            context = (parts[i][0] >> np.uint64(32)).astype(np.int64)
            used = (np.isin(contexts, context[mine == 0]) | np.isin(contexts, context) & ~stats[:, :K].any(axis=1)) & ~wide
            for name, value in (("grp", group), ("counts", squeezed_counts(mine)), ("contexts", contexts[used].tobytes()), ("stats", stats[used].tobytes())):
                out[name].append(value)
        for name, value in (("grp", None), ("counts", squeezed_counts(counts[seen])), ("contexts", contexts[wide].tobytes()), ("stats", stats[wide].tobytes())):
            out[name].append(value)
        out["bucket"] = [table.column("bucket")[0].as_py()] * len(out["grp"])
        kinds = pa.schema([("grp", pa.int64()), ("bucket", pa.int64()), ("counts", pa.binary()), ("contexts", pa.binary()), ("stats", pa.binary())])
        return pa.table([pa.array(out[f.name], f.type) for f in kinds], schema=kinds)

    # rows with grp answer a group; those without hold the counts of a bucket's bigrams and the statistics of its spread contexts
    answered = materialize(asked.groupBy("bucket").applyInArrow(answer, "grp long, bucket long, counts binary, contexts binary, stats binary"), "bigrams")
    model = answered.where("grp IS NULL")

    def summed(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for counts, contexts, stats in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                of = np.bincount(np.minimum(spread_counts(counts), K + 2), minlength=K + 3)[: K + 2]
                which, rows = np.frombuffer(contexts, np.int64), np.frombuffer(stats).reshape(-1, K + 2)
                yield pa.RecordBatch.from_arrays([pa.array([-1, *which.tolist()], pa.int64()), pa.array([of.astype(float).tolist(), *rows.tolist()], pa.list_(pa.float64()))], names=["context", "stats"])

    sums = model.select("counts", "contexts", "stats").mapInArrow(summed, "context long, stats array<double>")
    sums = sums.groupBy("context").agg(*[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(K + 2)]).collect()  # fewer than HOT + 3 rows
    d = discounts([int(x) for x in next((r[1:] for r in sums if r[0] == -1), [0] * (K + 2))])
    of_hot = {r[0]: np.array(r[1:]) for r in sums if r[0] >= 0}
    kinds = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    def score(left, right):
        import pyarrow as pa

        own = shared.value
        if not left.num_rows:
            return pa.table({n: pa.array([], t) for n, t in (("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()))})
        ids = word_ids(left.column("text").to_pylist(), own)
        keys, at = np.unique(bigrams(ids, own.start), return_inverse=True)
        bucket = buckets_of(keys, own.hot(), n_buckets)
        counts = np.zeros(len(keys), np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        which, stats = [np.array(list(of_hot), np.int64)], [np.array(list(of_hot.values())).reshape(-1, K + 2)]
        for b, c, w, s in zip(*(right.column(n).to_pylist() for n in ("bucket", "counts", "contexts", "stats")), strict=True):
            counts[order[cuts[b] : cuts[b + 1]]] = spread_counts(c)
            which.append(np.frombuffer(w, np.int64))
            stats.append(np.frombuffer(s).reshape(-1, K + 2))
        which, stats = np.concatenate(which), np.concatenate(stats)
        by = np.argsort(which)
        which, stats = which[by], stats[by]
        alpha, factor = backoff(stats, own.context_counts(which), d)
        context, word = (keys >> np.uint64(32)).astype(np.int64), (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
        place = np.minimum(np.searchsorted(which, context), max(0, len(which) - 1))
        known = (which[place] == context) if len(which) else np.zeros(len(keys), bool)
        weight, scale = (np.where(known, alpha[place], 1.0), np.where(known, factor[place], 1.0)) if len(which) else (np.ones(len(keys)), np.ones(len(keys)))
        total = np.maximum(own.context_counts(context), 1)
        by_key = np.log10(np.where(counts > 0, scale * discounted(counts, d) / total, weight * own.probability(word)))
        every = np.concatenate(ids)
        c = own.padded[every].astype(np.int64)
        base = np.log10((c + 0.1) / (own.tokens + 0.1 * (own.size + 1)))
        first = np.cumsum([0, *(len(x) for x in ids[:-1])])
        n = np.array([len(x) for x in ids], np.int64)
        return pa.table({
            "doc_id": left.column("doc_id").combine_chunks(), "held_out": left.column("held_out").combine_chunks(), "n_tokens": pa.array(n), "n_known": pa.array(np.add.reduceat((c > 0).astype(np.int64), first)),
            "train_tokens": pa.array(np.full(len(n), own.tokens, np.int64)), "base_score": pa.array(np.add.reduceat(base, first)), "score": pa.array(np.add.reduceat(by_key[at], first)),
        })

    return grouped.groupBy("grp").cogroup(answered.where("grp IS NOT NULL").select("grp", "bucket", "counts", "contexts", "stats").groupBy("grp")).applyInArrow(score, kinds)


def score_by_joins(rows: DataFrame) -> DataFrame:
    """The same scores from joins of token rows: no vocabulary is broadcast, and far more is shuffled. rows: doc_id, held_out, text."""
    tokens = F.concat(F.filter(F.split(ascii_lower(F.col("text")), r"[\x20\x09-\x0D]+"), lambda w: w != ""), F.array(F.lit(" ")))
    rows = materialize(rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "held_out", tokens.alias("w")), "tokens")
    before = F.concat(F.array(F.lit("")), F.slice("w", 1, F.size("w") - 1))
    pairs = materialize(rows.select("rid", "held_out", F.explode(F.arrays_zip(before.alias("v"), "w")).alias("t")).select("rid", "held_out", "t.v", "t.w"), "pairs")
    train = pairs.where("NOT held_out")
    words, pair_counts = materialize(train.groupBy("w").agg(F.count("*").alias("c")), "unigrams"), materialize(train.groupBy("v", "w").agg(F.count("*").alias("c2")), "bigrams")

    def sizes(counts: DataFrame, c: str) -> tuple[list[int], int, int]:
        r = counts.agg(*[F.count(F.when(F.col(c) == i, 1)) for i in range(1, K + 2)], F.coalesce(F.sum(c), F.lit(0)), F.count("*")).first()
        return [0, *r[: K + 1]], r[K + 1], r[K + 2]

    def shared(c: Column, d: np.ndarray) -> Column:
        return c * F.coalesce(*[F.when(c == r, float(d[r])) for r in range(1, K + 1)], F.lit(1.0))

    of_words, n, size = sizes(words, "c")
    d1, d2 = discounts(of_words), discounts(sizes(pair_counts, "c2")[0])
    left = 1 - (words.agg(F.sum(shared(F.col("c"), d1))).first()[0] or 0.0) / max(1, n)
    left, scale = (left, 1.0) if left > 0 else (1 / (n + 1), n / (n + 1))
    words = words.withColumn("p", shared(F.col("c"), d1) * scale / max(1, n))
    contexts = pair_counts.join(words, "w").groupBy("v").agg(F.sum(shared(F.col("c2"), d2)).alias("kept"), F.sum("p").alias("p_seen"), F.sum("c2").alias("total"))
    factor = F.when(F.col("kept") / F.col("total") < 1 - 1e-12, 1.0).otherwise(F.col("total") / (F.col("total") + 1))
    contexts = contexts.withColumn("factor", factor).withColumn("alpha", (1 - F.col("kept") / F.col("total") * F.col("factor")) / (1 - F.col("p_seen"))).select("v", "total", "factor", "alpha")
    every = pairs.join(pair_counts, ["v", "w"], "left").join(words, "w", "left").join(contexts, "v", "left")
    log_p = F.log10(F.when(F.col("c2").isNotNull(), F.col("factor") * shared(F.col("c2"), d2) / F.col("total")).otherwise(F.coalesce("alpha", F.lit(1.0)) * F.coalesce("p", F.lit(float(left)))))
    base = F.log10((F.coalesce("c", F.lit(0)) + 0.1) / (n + 0.1 * (size + 1)))
    scored = every.groupBy("rid").agg(F.count("*").alias("n_tokens"), F.count("c").alias("n_known"), F.sum(base).alias("base_score"), F.sum(log_p).alias("score"))
    return rows.join(scored, "rid").select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score")
