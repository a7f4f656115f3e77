"""N-gram Jaccard join: documents whose shingle sets are similar, by an index of count vectors.

1. Every document becomes its set of distinct k-word shingles (64-bit hashes).
   Equal sets form a class; only one document of a class goes on.
2. Routing. The hash range is cut into so many groups that a similar pair,
   which differs in a bounded number of shingles, must agree on all shingles of
   several groups. The LABELS smallest keys of a set are its labels: sets with a
   common label meet under it once, and a key says nothing more about them.
3. Those that meet are dealt into tasks of bounded size, each set first in one
   meeting, then where a meeting holds several components. In a task the counts of
   shingles per hash group are points of an R-tree, searched against itself: the
   summed coordinate minima of two boxes, then of two points, bound the overlap.
4. Pairs that survive are verified on the exact sets. A task reports links that
   join its similar classes, not all pairs; components follow from the links.
"""

import math
import zlib
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import WordHashes, materialize, mix, shingles, union_all
from lettermill.llm.components import connected_components

#: Ratio of the size classes; a pair belongs to the class of its larger set.
CLASS_RATIO = 1.6
#: Coordinates of a count vector, points of a leaf, children of a node.
DIMS, LEAF, FANOUT = 256, 32, 8
#: Members of one block of a large meeting; a task compares two blocks.
BLOCK = 1024
#: Labels of a set.
LABELS = 2
#: Rows that a comparing task takes on average, and routing keys that a routing bucket takes on average.
TASK_ROWS, BUCKET_KEYS = 2048, 500_000


def class_bounds(c: int) -> tuple[int, int]:
    """Sizes of class c: from, and up to but without."""
    return math.ceil(CLASS_RATIO**c), math.ceil(CLASS_RATIO ** (c + 1))


def group_plan(c: int, num: int, den: int) -> tuple[int, int]:
    """Hash groups of class c and how many of them may be too small to use.

    Sets of at most u shingles with similarity num / den differ in at most
    2 u (den - num) / (den + num) shingles, so at least spare + 1 of the groups
    have none of these.
    """
    differ = 2 * (class_bounds(c)[1] - 1) * (den - num) // (den + num)
    spare = 1 + (differ + 1) * 15 // 100
    return differ + 1 + spare, spare


def routing_keys(own: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of one sorted set; two sets of the wanted similarity share one. Groups without a shingle are left out unless there are too many of these."""
    n = len(own)
    c = int(math.log(n, CLASS_RATIO) + 1e-9)
    while class_bounds(c)[1] <= n:
        c += 1
    while class_bounds(c)[0] > n:
        c -= 1
    out = []
    for cls in (c, c + 1):
        if cls > c and n * den < class_bounds(cls)[0] * num:
            break
        m, spare = group_plan(cls, num, den)
        group = ((own >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        keys = mix(np.add.reduceat(mix(own + np.uint64(cls)), first) + group[first] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(cls))
        out.append(keys)
        if m - len(first) > spare:
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), group[first])
            out.append(mix(empty * np.uint64(0x9E3779B97F4A7C15) + np.uint64(cls)))
    return np.concatenate(out)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    return np.unique(shingles(words, k))


def set_key(own: np.ndarray) -> tuple[int, int]:
    digest = xxhash.xxh3_128_digest(own.tobytes())
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def count_points(sets: list[np.ndarray]) -> np.ndarray:
    """Shingles of each set per hash group."""
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    return np.bincount(row * DIMS + (np.concatenate(sets) % np.uint64(DIMS)).astype(np.int64), minlength=len(sets) * DIMS).reshape(-1, DIMS).astype(np.int32)


def profile(texts: DataFrame, k: int, num: int, den: int, n_buckets: int, flush: int = 2_000_000) -> DataFrame:
    """Rows (doc_id, n, hi, lo, point) for documents, and rows (bucket, keys, ids) with the packed routing keys of many sets, told apart by hi."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kinds = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("point", pa.binary()), ("bucket", pa.int32()), ("keys", pa.binary()), ("ids", pa.binary())])
        hashes, seen = WordHashes(), set()
        keys: list[np.ndarray] = []
        ids: list[int] = []
        labels: list[np.ndarray] = []
        held = 0

        def flushed():
            every, at = np.concatenate(keys), np.repeat(np.arange(len(ids), dtype=np.uint32), [len(x) for x in keys])
            members, tags = np.array(ids, "<i8"), np.stack(labels)
            bucket = bucket_of(every, n_buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            rows = []
            for b in range(n_buckets):
                part = order[cuts[b] : cuts[b + 1]]
                if len(part):
                    used, count = np.unique(at[part], return_counts=True)
                    # 40 bits tell keys of one bucket apart
                    packed = np.ascontiguousarray(every[part]).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
                    rows.append((b, packed, np.int64(len(used)).tobytes() + count.astype("<u4").tobytes() + members[used].tobytes() + tags[used].tobytes()))
            return rows

        def batch_of(docs, packs):
            n, m = len(docs), len(packs)
            columns = [[x[i] for x in docs] + [None] * m for i in range(5)] + [[None] * n + [x[i] for x in packs] for i in range(3)]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.types, strict=True)], schema=kinds)

        for batch in batches:
            docs = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = shingle_set(hashes.of(text), k)
                key = set_key(own)
                docs.append((doc_id, len(own), *key, zlib.compress(count_points([own]).astype("<u4").tobytes(), 1) if len(own) else None))
                if len(own) and doc_id is not None and key not in seen:
                    if len(seen) >= 500_000:
                        seen.clear()
                    seen.add(key)
                    keys.append(np.unique(routing_keys(own, num, den)))
                    ids.append(key[0])
                    labels.append(keys[-1][np.minimum(np.arange(LABELS), len(keys[-1]) - 1)])
                    held += len(keys[-1])
                    if held >= flush:
                        yield batch_of([], flushed())
                        keys, ids, labels, held = [], [], [], 0
            yield batch_of(docs, [])
        if ids:
            yield batch_of([], flushed())

    return texts.mapInArrow(run, "doc_id long, n long, hi long, lo long, point binary, bucket int, keys binary, ids binary")


def bucket_of(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    return ((keys >> np.uint64(40)) * np.uint64(n_buckets)) >> np.uint64(24)


def unpack(keys: bytes, ids: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """40 bits of each key, the set that has it, and the labels of that set."""
    n = len(keys) // 5
    wide = np.zeros((n, 8), np.uint8)
    wide[:, :5] = np.frombuffer(keys, np.uint8).reshape(n, 5)
    used = int(np.frombuffer(ids, "<i8", 1)[0])
    place = np.repeat(np.arange(used), np.frombuffer(ids, "<u4", used, 8))
    members, tags = np.frombuffer(ids, "<i8", used, 8 + 4 * used), np.frombuffer(ids, "<u8", used * LABELS, 8 + 12 * used)
    return wide.view(np.uint64).ravel(), members[place], tags.reshape(used, LABELS)[place]


def common_label(group: np.ndarray, tags: np.ndarray, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
    """For each group the label that most of its rows have, and whether two or more have it."""
    g, label = np.repeat(group, LABELS), tags.ravel()
    order = np.lexsort((label, g))
    g, label = g[order], label[order]
    first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (label[1:] != label[:-1])]))
    count = np.diff(np.append(first, len(g)))
    g, label = g[first], label[first]
    best = np.lexsort((label, -count, g))
    best = best[np.searchsorted(g[best], np.arange(n_groups))]
    return label[best], count[best] > 1


def meetings(packs: DataFrame, n_buckets: int) -> DataFrame:
    """Distinct (p, hi): sets that share a key are members of a common meeting p.

    A set is in the meetings of its labels where others have that key too. Those of a key
    that have its commonest label are together there already, so only its other sets join
    that meeting; where no two have a common label, all of the key meet under the smallest.
    """

    def meet(table):
        import pyarrow as pa

        parts = [unpack(k, i) for k, i in zip(table.column("keys").to_pylist(), table.column("ids").to_pylist(), strict=True)]
        key, member, tags = (np.concatenate([p[i] for p in parts]) for i in range(3))
        order = np.lexsort((member, key))
        key, member = key[order], member[order]
        # tasks that met the same set have sent its keys more than once
        own = np.concatenate([[True], (key[1:] != key[:-1]) | (member[1:] != member[:-1])])
        key, member, tags = key[own], member[own], tags[order[own]]
        starts = np.concatenate([[True], key[1:] != key[:-1]])
        shared = ~(starts & np.append(starts[1:], True))
        key, member, tags, starts = key[shared], member[shared], tags[shared], starts[shared]
        if not len(key):
            return pa.table({"p": pa.array([], pa.int64()), "hi": pa.array([], pa.int64())})
        group, first = np.cumsum(starts) - 1, np.flatnonzero(starts)
        label, several = common_label(group, tags, len(first))
        least = member[first]
        # a label is a key of its sets, so its bucket shows them all
        here = (bucket_of(tags, n_buckets) == np.uint64(table.column("bucket")[0].as_py())) & ((tags & np.uint64((1 << 40) - 1)) == key[:, None])
        other = several[group] & (tags != label[group][:, None]).all(axis=1)
        apart = ~several[group]
        p = np.concatenate([tags[here].view(np.int64), label[group[other]].view(np.int64), least[group[apart]]])
        hi = np.concatenate([member[np.nonzero(here)[0]], member[other], member[apart]])
        order = np.lexsort((hi, p))
        p, hi = p[order], hi[order]
        new = np.concatenate([[True], (p[1:] != p[:-1]) | (hi[1:] != hi[:-1])])
        return pa.table({"p": pa.array(p[new], pa.int64()), "hi": pa.array(hi[new], pa.int64())})

    return packs.groupBy("bucket").applyInArrow(meet, "p long, hi long").distinct()


class CountTree:
    """R-tree over count vectors of shingle sets, searched against itself."""

    def __init__(self, points: np.ndarray, num: int, den: int, sets: list[np.ndarray] | None = None):
        self.num, self.den = num, den
        size = points.sum(axis=1, dtype=np.int64)
        # packed by size, then by a coordinate that tells clusters apart
        slab = np.argsort(np.argsort(size, kind="stable"), kind="stable") // (LEAF * FANOUT)
        self.order = np.lexsort((points[:, :8] @ np.arange(1, 9), slab))
        self.sets, self.size, self.points = [sets[i] for i in self.order] if sets else [], size[self.order], points[self.order]
        self.levels = []
        edges = np.append(np.arange(0, len(points), LEAF), len(points))
        high, low, top = np.maximum.reduceat(self.points, edges[:-1]), np.minimum.reduceat(self.size, edges[:-1]), np.maximum.reduceat(self.size, edges[:-1])
        self.edges = edges
        while True:
            self.levels.append((high, low, top))
            if len(high) <= FANOUT:
                break
            at = np.arange(0, len(high), FANOUT)
            high, low, top = np.maximum.reduceat(high, at), np.minimum.reduceat(low, at), np.maximum.reduceat(top, at)

    def enough(self, overlap, size_a, size_b):
        """Whether an overlap can give the similarity: overlap >= num / (num + den) (a + b)."""
        return (self.num + self.den) * overlap >= self.num * (size_a + size_b)

    def leaf_pairs(self) -> np.ndarray:
        n = len(self.levels[-1][0])
        a, b = np.triu_indices(n)
        for level in range(len(self.levels) - 1, -1, -1):
            high, low, top = self.levels[level]
            near = (top[a] * self.den >= low[b] * self.num) & (top[b] * self.den >= low[a] * self.num)
            a, b = a[near], b[near]
            kept = [self.enough(np.minimum(high[x], high[y]).sum(axis=1), low[x], low[y]) for x, y in zip(np.array_split(a, len(a) // 4096 + 1), np.array_split(b, len(b) // 4096 + 1), strict=True)]
            a, b = a[np.concatenate(kept)], b[np.concatenate(kept)]
            if level:
                below = len(self.levels[level - 1][0])
                child = np.arange(FANOUT)
                a, b = (a[:, None, None] * FANOUT + child[:, None]).repeat(FANOUT, 2).ravel(), (b[:, None, None] * FANOUT + child[None, :]).repeat(FANOUT, 1).ravel()
                real = (a <= b) & (b < below)
                a, b = a[real], b[real]
        return np.stack([a, b])

    def neighbourhoods(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Points of a leaf, up to 512 points of leaves near it, and which of the pairs (each once) the bound lets through."""
        a, b = self.leaf_pairs()
        for leaf in np.unique(a).tolist():
            left = np.arange(self.edges[leaf], self.edges[leaf + 1])
            right = np.concatenate([np.arange(self.edges[j], self.edges[j + 1]) for j in b[a == leaf].tolist()])
            for start in range(0, len(right), 512):
                some = right[start : start + 512]
                bound = np.minimum(self.points[left][:, None, :], self.points[some][None, :, :]).sum(axis=2)
                yield left, some, self.enough(bound, self.size[left][:, None], self.size[some][None, :]) & (left[:, None] < some[None, :])

    def survivors(self) -> np.ndarray:
        """Positions of the points that have a partner within the bound."""
        alive = np.zeros(len(self.points), bool)
        for left, some, near in self.neighbourhoods():
            alive[left[near.any(axis=1)]] = True
            alive[some[near.any(axis=0)]] = True
        return np.sort(self.order[alive])

    def links(self) -> list[tuple[int, int]]:
        """Pairs (positions in the given list) that span every set of linked sets."""
        root = np.arange(len(self.sets))
        out = []
        for left, some, near in self.neighbourhoods():
            open_ = near & (root[left][:, None] != root[some][None, :])
            i, j = np.flatnonzero(open_.any(axis=1)), np.flatnonzero(open_.any(axis=0))
            if not len(i):
                continue
            vocabulary = np.unique(np.concatenate([self.sets[x] for x in left[i].tolist()]))
            step = max(1, 16_000_000 // len(vocabulary))
            mine = self.incidence(left[i], vocabulary)
            for part in np.array_split(j, -(-len(j) // step)):
                overlap = (mine @ self.incidence(some[part], vocabulary).T).astype(np.int64)
                linked = open_[np.ix_(i, part)] & self.enough(overlap, self.size[left[i]][:, None], self.size[some[part]][None, :])
                for x, y in zip(*np.nonzero(linked), strict=True):
                    p, q = int(left[i[x]]), int(some[part[y]])
                    if root[p] != root[q]:
                        root[root == root[q]] = root[p]
                        out.append((int(self.order[p]), int(self.order[q])))
        return out

    def incidence(self, rows: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
        values = np.concatenate([self.sets[x] for x in rows.tolist()])
        row = np.repeat(np.arange(len(rows)), self.size[rows])
        place = np.minimum(np.searchsorted(vocabulary, values), len(vocabulary) - 1)
        found = vocabulary[place] == values
        out = np.zeros((len(rows), len(vocabulary)), np.float32)
        out[row[found], place[found]] = 1
        return out


def in_blocks(met: DataFrame) -> DataFrame:
    """met (p, x) with blocks, the number of blocks of the meeting, and i, the block of the member."""
    blocks = met.groupBy("p").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"), F.count("*").alias("size")).where("size > 1")
    return met.join(blocks, "p").withColumn("i", F.pmod(F.xxhash64("x"), F.col("blocks")))


def first_tasks(met: DataFrame) -> DataFrame:
    """(x, task): each block of a meeting with its first block, so a member moves once and those of the first block once for each block."""
    rows = in_blocks(met)
    own = rows.select("x", F.xxhash64("p", "i").alias("task"))
    lead = rows.where("i = 0 AND blocks > 1").withColumn("j", F.explode(F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1)))
    return own.unionByName(lead.select("x", F.xxhash64("p", "j").alias("task")))


def homes(met: DataFrame, rounds: int = 3) -> tuple[DataFrame, DataFrame]:
    """met (p, x) parted: each member in the smallest of its meetings alone, and what that leaves to compare.

    A meeting whose members have all one home is compared there. The others are parted
    again; those that are left after the last round stay as they are.
    """
    parts = []
    for _ in range(rounds):
        several = met.groupBy("p").agg(F.count("*").alias("size")).where("size > 1").select("p")
        met = materialize(met.join(several, "p"), "met")
        home = materialize(met.groupBy("x").agg(F.min("p").alias("home")), "home")
        parts.append(home.select(F.col("home").alias("p"), "x"))
        mixed = met.join(home, "x").groupBy("p").agg(F.min("home").alias("least"), F.max("home").alias("most")).where("least <> most").select("p")
        met = met.join(mixed, "p")
    return parts[0], materialize(union_all([*parts[1:], met]).distinct(), "mixed")


def open_tasks(met: DataFrame, components: DataFrame, mixed: DataFrame | None = None) -> DataFrame:
    """(x, task) for the pairs of large meetings, and of all meetings in mixed, that first_tasks() did not compare and that no link joins.

    Members of a meeting's largest component need no comparison with each other;
    each of the others meets all, block against block. So near copies that are
    joined already cost nothing, and a member moves once for each block of others.
    """
    rows = in_blocks(met).where("blocks > 1").select("p", "x")
    if mixed is not None:
        rows = rows.unionByName(mixed.select("p", "x")).distinct()
    rows = rows.join(components, F.col("x") == F.col("node"), "left").select("p", "x", F.coalesce("component", "x").alias("c"))
    rows = materialize(rows, "members")
    largest = rows.groupBy("p", "c").agg(F.count("*").alias("n")).groupBy("p").agg(F.max_by("c", F.struct("n", "c")).alias("main"), F.sum("n").alias("size"), F.max("n").alias("most")).where("most < size")
    sides = rows.join(largest, "p").withColumns({"b_others": F.ceil((F.col("size") - F.col("most")) / F.lit(BLOCK)), "b_main": F.ceil(F.col("most") / F.lit(BLOCK))})
    # what fits into a block is one task
    small, sides = sides.where(F.col("size") <= BLOCK), sides.where(F.col("size") > BLOCK)
    others = sides.where("c <> main").withColumn("i", F.pmod(F.xxhash64("x"), F.col("b_others")))
    # blocks of others are numbered from 0, those of the largest component behind them
    met_by = others.withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("b_others") + F.col("b_main") - 1)))
    main = sides.where("c = main").withColumn("j", F.col("b_others") + F.pmod(F.xxhash64("x"), F.col("b_main"))).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("b_others") - 1)))
    task = F.xxhash64("p", F.least("i", "j"), F.greatest("i", "j"), F.lit("open")).alias("task")
    return union_all([small.select("x", F.xxhash64("p", F.lit("open")).alias("task")), met_by.select("x", task), main.select("x", task)])


def jaccard_components(docs: DataFrame, k: int = 5, similarity: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_shingles, class_id, component_id.

    Documents link when the Jaccard similarity of their sets of distinct k-word
    shingles is num / den or more (compared in integers); component_id is the
    smallest doc_id that links reach, class_id the smallest with the same set.
    Words are `[^\\x20\\x09-\\x0D]+` of the text with A-Z lower-cased; a text of
    fewer than k words has its whole sequence as one shingle.

    Null, empty and blank texts have no shingle and link with nothing, not with
    each other either. Rows with a null id are returned with null ids and link
    with nothing. Rows that repeat an id may have other texts: each row links by its own
    text, and its ids are the smallest doc_ids of what it reaches. Extra columns are
    not read. Shingles are told apart by 64-bit hashes, sets by 128-bit hashes.
    No candidate, bucket or group is capped: a meeting of more than BLOCK classes
    is compared block against block, but for pairs that links join already.
    """
    if repeats_ids(docs, id_col):
        own = materialize(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.when(F.col(id_col).isNotNull(), F.monotonically_increasing_id()).alias("row")), "numbered")
        found = materialize(row_components(own, k, similarity, "row", "text"), "rows").withColumnRenamed("doc_id", "row").join(own.select("row", "id").where("row IS NOT NULL"), "row", "left")
        for c in ("class_id", "component_id"):
            found = found.join(found.where("id IS NOT NULL").groupBy(c).agg(F.min("id").alias("least")), c, "left").drop(c).withColumnRenamed("least", c)
        return found.select(F.col("id").alias("doc_id"), "n_shingles", "class_id", "component_id")
    return row_components(docs, k, similarity, id_col, text_col)


def repeats_ids(docs: DataFrame, id_col: str) -> bool:
    """Whether an id stands in several rows; reads no other column."""
    return not docs.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def row_components(docs: DataFrame, k: int, similarity: tuple[int, int], id_col: str, text_col: str) -> DataFrame:
    """jaccard_components() of rows whose ids, where not null, are unique."""
    num, den = similarity
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8").alias("text"))
    n_bytes = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    keys_per_byte = 0.2 * 2 * (den - num) / (den + num) * 1.9
    n_buckets = max(1, round(n_bytes * keys_per_byte / BUCKET_KEYS))
    found = materialize(profile(texts, k, num, den, n_buckets), "profile")
    rows = found.where("n IS NOT NULL").select("doc_id", "n", "hi", "lo")
    classes = materialize(rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("hi", "lo").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("members")), "classes")
    met = materialize(meetings(found.where("bucket IS NOT NULL").select("bucket", "keys", "ids"), n_buckets), "met")
    home, mixed = homes(met.join(classes.select("hi", F.col("class_id").alias("x")), "hi").select("p", "x").distinct())

    def search(table):
        import pyarrow as pa

        hashes = WordHashes()
        texts = dict(zip(table.column("x").to_pylist(), table.column("text").to_pylist(), strict=True))
        x = sorted(texts)
        own = [shingle_set(hashes.of(texts[i]), k) for i in x]
        links = CountTree(count_points(own), num, den, own).links()
        return pa.table({"a": pa.array([x[i] for i, _ in links], pa.int64()), "b": pa.array([x[j] for _, j in links], pa.int64())})

    def prune(table):
        import pyarrow as pa

        points = dict(zip(table.column("x").to_pylist(), table.column("point").to_pylist(), strict=True))
        x = sorted(points)
        tree = CountTree(np.stack([np.frombuffer(zlib.decompress(points[i]), "<u4") for i in x]).astype(np.int32), num, den)
        alive = [x[i] for i in tree.survivors()]
        return pa.table({"x": pa.array(alive, pa.int64()), "task": pa.array([table.column("task")[0].as_py()] * len(alive), pa.int64())})

    points = found.where("n > 0 AND doc_id IS NOT NULL").select("doc_id", "point")

    def linked(dealt: DataFrame) -> DataFrame:
        """Links (a, b) inside the tasks of dealt (x, task)."""
        dealt = materialize(dealt, "dealt")
        n_tasks = max(1, -(-dealt.count() // TASK_ROWS))
        dealt = dealt.select("x", F.pmod("task", F.lit(n_tasks)).alias("task")).distinct()
        # first the points alone meet; then the texts of those whose points have a partner move to their tasks
        alive = points.join(dealt.hint("shuffle_hash"), F.col("doc_id") == F.col("x")).select("x", "task", "point").groupBy("task").applyInArrow(prune, "x long, task long")
        alive = materialize(alive, "alive")
        meeting = texts.join(alive.hint("shuffle_hash"), F.col("doc_id") == F.col("x")).select("x", "task", "text")
        return materialize(meeting.groupBy("task").applyInArrow(search, "a long, b long"), "found")

    components = materialize(connected_components(linked(first_tasks(home))), "components")
    rest = materialize(open_tasks(home, components, mixed), "open")
    if not rest.isEmpty():
        components = connected_components(components.toDF("a", "b").unionByName(linked(rest)))
    joined = rows.join(F.broadcast(classes.where(F.col("members") > max(2, rows.count() // 1000))).select("hi", "lo", F.col("class_id").alias("hot_id")), ["hi", "lo"], "left")
    hot = joined.where("hot_id IS NOT NULL").select("doc_id", "n", F.col("hot_id").alias("class_id"))
    cold = joined.where("hot_id IS NULL").join(classes, ["hi", "lo"], "left").select("doc_id", "n", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"))
    class_components = classes.select("class_id", "members").join(components, F.col("class_id") == F.col("node"))
    out = hot.unionByName(cold).join(class_components.select(F.col("class_id").alias("node"), "component"), F.col("class_id") == F.col("node"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), "class_id", F.coalesce("component", "class_id").alias("component_id"))


def drop_near_copies(docs: DataFrame, k: int = 5, similarity: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns, that are the smallest id of their component; rows with a null id stay. Rows of a component that repeat its smallest id stay."""
    if repeats_ids(docs, id_col):
        own = materialize(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("kept"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.when(F.col(id_col).isNotNull(), F.monotonically_increasing_id()).alias("row")), "numbered")
        found = row_components(own, k, similarity, "row", "text").where("doc_id IS NOT NULL").select(F.col("doc_id").alias("row"), "component_id")
        found = materialize(found.join(own.select("row", "id"), "row"), "rows")
        first = found.join(found.groupBy("component_id").agg(F.min("id").alias("least")), "component_id").where("id = least").select("row")
        return own.where("row IS NULL").select("kept.*").unionByName(own.join(first, "row", "left_semi").select("kept.*"))
    dropped = row_components(docs, k, similarity, id_col, text_col).where("doc_id <> component_id").select(F.col("doc_id").alias("__dropped_id"))
    return docs.join(dropped, F.col(id_col) == F.col("__dropped_id"), "left_anti")
