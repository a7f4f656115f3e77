"""Fuzzy line deduplication by MinHash.

1. A pass over the documents splits them into lines and tells lines apart by 128 bits
   of hash of the normalised line. Each line is cut into all its shingles of nine
   characters, one 64-bit hash each; a line that its task has met is not cut again.
2. The hashes fall into SECTORS sectors; the least of a sector is one MinHash. ROWS
   sectors are a band, so a band of two lines of similarity J agrees with a
   probability of about J^3, and at 0.8 some band of all with one of 0.997.
3. Lines that agree on a band meet under the smallest of them. Meetings are dealt
   into tasks, large ones block against block, and compared there on the exact
   shingle sets: one pivot with all others, then those outside the largest set of
   linked lines, until links join all or each of the others has been the pivot.
4. Components of the links follow from star rounds.

Splitting, hashing and comparing run in Arrow batches; README says what was measured
of forms of DataFrame functions.
"""

import re
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import materialize, mix
from lettermill.llm.components import connected_components
from lettermill.llm.neardup import first_tasks, open_tasks

#: Characters of a shingle; sectors of a band and bands.
SHINGLE, ROWS, BANDS = 9, 3, 8
SECTORS = ROWS * BANDS
#: Multiplier of the rolling hash, its powers, and the value of a sector without a shingle.
BASE, BASE_2, BASE_4 = (np.uint64(pow(0x9E3779B97F4A7C15, i, 1 << 64)) for i in (1, 2, 4))
EMPTY = np.uint64(2**64 - 1)
#: Characters hashed at once; lines that a task remembers.
CHUNK, MEMORY = 500_000, 300_000
#: Rows and characters that a comparing task takes on average.
TASK_ROWS, TASK_CHARS = 2048, 2_000_000
#: White space other than single blanks, and what is folded.
ODD, FOLDED = re.compile("  |[\t\x0b\x0c\r]"), re.compile("[ \t\x0b\x0c\r]+")


def normal_lines(text: str) -> list[str]:
    """Lines of a text in lower case, white space folded and none at the ends; a blank line is empty."""
    low = text.lower()
    if ODD.search(low):
        low = FOLDED.sub(" ", low)
    return [line.strip(" ") for line in low.split("\n")]


def line_shingles(norms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Line (position in norms) and hash of each shingle: every nine characters, or the whole of a shorter line. No line may be empty."""
    size = np.fromiter(map(len, norms), np.int64, len(norms))
    chars = np.frombuffer("".join(norms).encode("utf-32-le"), "<u4").astype(np.uint64)
    c = np.concatenate([chars, np.zeros(SHINGLE - 1, np.uint64)])
    two = c[:-1] * BASE + c[1:]
    four = two[:-2] * BASE_2 + two[2:]
    nine = (four[:-4] * BASE_4 + four[4:])[:-1] * BASE + c[8:]
    count = np.maximum(1, size - (SHINGLE - 1))
    start = np.cumsum(size) - size
    row = np.repeat(np.arange(len(norms)), count)
    at = np.arange(len(row)) + np.repeat(start - (np.cumsum(count) - count), count)
    for i in np.flatnonzero(size < SHINGLE).tolist():
        nine[start[i]] = xxhash.xxh3_64_intdigest(norms[i].encode())
    return row, mix(nine[at])


def band_keys(norms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A key for each line and band, and which of them count: a band without a shingle has no key."""
    row, h = line_shingles(norms)
    sector = (((h >> np.uint64(40)) * np.uint64(SECTORS)) >> np.uint64(24)).astype(np.int64)
    least = np.full(len(norms) * SECTORS, EMPTY)
    np.minimum.at(least, row * SECTORS + sector, h)
    least = least.reshape(len(norms), BANDS, ROWS)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(norms), BANDS))
    for i in range(ROWS):
        keys = mix(keys * BASE + least[:, :, i])
    return keys, (least != EMPTY).any(axis=2)


def line_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repeats: bool = False) -> DataFrame:
    """One row per line: doc_id, line_no (from 0), hi and lo (hash of the normalised line, null for a blank one), norm and bands.

    norm is null and bands are empty where the task has met the line before, unless repeats are wanted.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
        seen: set[bytes] = set()

        def table_of(ids: list, numbers: list[int], norms: list[str]):
            digests = [xxhash.xxh3_128_digest(x.encode()) for x in norms]
            new = []
            for i, digest in enumerate(digests):
                if norms[i] and (repeats or digest not in seen):
                    if len(seen) >= MEMORY:
                        seen.clear()
                    seen.add(digest)
                    new.append(i)
            blank = np.array([not x for x in norms])
            hi, lo = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2).T
            count, values = np.zeros(len(norms), np.int64), np.zeros(0, np.uint64)
            if new:
                keys, real = band_keys([norms[i] for i in new])
                count[new], values = real.sum(axis=1), keys[real]
            own = set(new)
            bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32()), pa.array(values.view(np.int64)))
            texts = pa.array([x if i in own else None for i, x in enumerate(norms)], pa.string())
            columns = [pa.array(ids, pa.int64()), pa.array(numbers, pa.int32()), pa.array(hi, mask=blank), pa.array(lo, mask=blank), texts, bands]
            return pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(zip(["doc_id", "line_no", "hi", "lo", "norm", "bands"], types, strict=True))))

        for batch in batches:
            ids, numbers, norms, held = [], [], [], 0
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = normal_lines(text)
                ids += [doc_id] * len(found)
                numbers += range(len(found))
                norms += found
                held += len(text) + 1
                if held >= CHUNK:
                    yield table_of(ids, numbers, norms)
                    ids, numbers, norms, held = [], [], [], 0
            if norms:
                yield table_of(ids, numbers, norms)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id long, line_no int, hi long, lo long, norm string, bands array<long>")


def split_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, line_no (from 0) and norm, the normalised line; blank lines have a null norm."""
    return line_rows(docs, id_col, text_col, repeats=True).select("doc_id", "line_no", "norm")


def meeting_links(sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Pairs of similar sets that span every set of linked ones. sets: distinct hashes of each."""
    size = np.array([len(x) for x in sets])
    _, shingle, having = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), size)
    # a shingle of one line alone is in no overlap
    shared = having[shingle] > 1
    row, shingle = row[shared], shingle[shared]
    edges = np.searchsorted(row, np.arange(len(sets) + 1))
    root, been = np.arange(len(sets)), np.zeros(len(sets), bool)
    out, pivot = [], 0
    while True:
        been[pivot] = True
        mark = np.zeros(len(having), bool)
        mark[shingle[edges[pivot] : edges[pivot + 1]]] = True
        overlap = np.bincount(row[mark[shingle]], minlength=len(sets))
        linked = np.flatnonzero((overlap * (num + den) >= num * (size + size[pivot])) & (root != root[pivot]))
        for other in linked.tolist():
            if root[other] != root[pivot]:
                root[root == root[other]] = root[pivot]
                out.append((pivot, other))
        open_ = np.flatnonzero(~been & (root != np.bincount(root).argmax()))
        if not len(open_):
            return out
        pivot = int(open_[0])


def line_links(met: DataFrame, texts: DataFrame, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) between similar lines that meet, and their components (node, component). met: distinct (key, id); texts: (id, norm).

    Members of one meeting are compared with each other but for pairs that links
    join already; a meeting of more than a block goes block against block.
    """
    leaders = met.groupBy("key").agg(F.min("id").alias("p"), F.count("*").alias("size")).where("size > 1").select("key", "p")
    members = materialize(met.join(leaders.hint("shuffle_hash"), "key").select("p", F.col("id").alias("x")).distinct(), "members")
    n_texts, n_chars = texts.agg(F.count("*"), F.sum(F.char_length("norm"))).first()
    mean = (n_chars or 0) / max(1, n_texts)

    def search(table):
        import pyarrow as pa

        task, x = table.column("task").to_numpy(), table.column("x").to_numpy()
        lines, position = np.unique(x, return_inverse=True)
        norms: list = [None] * len(lines)
        for at, norm in zip(position.tolist(), table.column("norm").to_pylist(), strict=True):
            norms[at] = norm
        sets: list[np.ndarray] = []
        for i in range(0, len(norms), 256):
            row, h = line_shingles(norms[i : i + 256])
            sets += [np.unique(own) for own in np.split(h, np.flatnonzero(np.diff(row)) + 1)]
        a, b = [], []
        order = np.argsort(task, kind="stable")
        for own in np.split(position[order], np.flatnonzero(np.diff(task[order])) + 1):
            for i, j in meeting_links([sets[k] for k in own.tolist()], num, den) if len(own) > 1 else []:
                a.append(int(lines[own[i]]))
                b.append(int(lines[own[j]]))
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    def linked(dealt: DataFrame) -> DataFrame:
        dealt = materialize(dealt.distinct(), "dealt")
        n = dealt.count()
        slots = max(1, -(-n // TASK_ROWS), round(n * mean / TASK_CHARS))
        rows = texts.join(dealt.hint("shuffle_hash"), F.col("id") == F.col("x")).select("task", "x", "norm", F.pmod("task", F.lit(slots)).alias("slot"))
        return materialize(rows.groupBy("slot").applyInArrow(search, "a long, b long"), "found")

    links = linked(first_tasks(members))
    components = materialize(connected_components(links), "components")
    rest = materialize(open_tasks(members, components), "open")
    if not rest.isEmpty():
        links = links.unionByName(linked(rest))
        components = materialize(connected_components(links), "components")
    return links, components


def similar_lines(docs: DataFrame, similarity: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per line of every row: doc_id, line_no, component_id, kept.

    Lines whose normalised texts are equal are one (by 128 bits of hash); two
    others link when they agree on a band and the exact Jaccard similarity of
    their sets of all nine-character shingles is num / den or more; a shorter
    line is its only shingle. component_id is the smallest line hash of the
    component, in hexadecimal. The first line of a component, by doc_id and
    line_no, is kept.

    Blank lines have no component and are kept; null text is one blank line. A
    null doc_id sorts first; rows that repeat an id share what is kept. No
    meeting is capped and no pair of a meeting is left out but those that links
    join already. Other columns are not read.
    """
    num, den = similarity
    lines = materialize(line_rows(docs, id_col, text_col), "lines")
    first = lines.where("norm IS NOT NULL")
    banded = first.select("hi", "lo", F.explode("bands").alias("key"))
    # a frequent line comes once from each task, so a key is shared when two hashes have it, not two rows
    shared = banded.groupBy("key").agg(F.min("hi").alias("least"), F.max("hi").alias("most")).where("least <> most")
    shared = materialize(shared.select("key"), "shared")
    found = materialize(banded.join(shared.hint("shuffle_hash"), "key").distinct(), "banded")
    wanted = found.select("hi", "lo").distinct()
    wanted = materialize(wanted.select(F.monotonically_increasing_id().alias("id"), "hi", "lo"), "wanted")
    met = materialize(found.join(wanted.hint("shuffle_hash"), ["hi", "lo"]).select("key", "id"), "met")
    texts = materialize(first.select("hi", "lo", "norm").join(wanted.hint("shuffle_hash"), ["hi", "lo"]).select("id", "norm").dropDuplicates(["id"]), "texts")
    components = line_links(met, texts, num, den)[1].where("node <> component")
    several = components.unionByName(components.select(F.col("component").alias("node"), "component")).distinct()
    several = several.join(wanted.select(F.col("id").alias("node"), "hi", "lo"), "node")
    label = several.groupBy("component").agg(F.min(F.struct("hi", "lo")).alias("label"))
    several = materialize(several.join(label, "component").select("hi", "lo", F.col("label.hi").alias("c_hi"), F.col("label.lo").alias("c_lo")), "labels")
    placed = lines.where("hi IS NOT NULL").join(several.hint("shuffle_hash"), ["hi", "lo"], "left").select("doc_id", "line_no", F.coalesce("c_hi", "hi").alias("hi"), F.coalesce("c_lo", "lo").alias("lo"))
    placed = materialize(placed, "placed")
    # doc_id and line_no as one number, a null doc_id below all
    place = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.expr("cast(-9223372036854775809 AS decimal(20,0))")) * F.lit(1 << 32).cast("decimal(11,0)") + F.col("line_no").cast("decimal(11,0)")
    firsts = placed.groupBy("hi", "lo").agg(F.min(place).alias("first"), F.count("*").alias("n"), F.min("doc_id").alias("doc_id"), F.min("line_no").alias("line_no"))
    name = F.concat(F.lpad(F.hex("hi"), 16, "0"), F.lpad(F.hex("lo"), 16, "0")).alias("component_id")
    # lines alone in their component need no join back
    alone = firsts.where("n = 1").select("doc_id", "line_no", name, F.lit(True).alias("kept"))
    copies = placed.join(firsts.where("n > 1").select("hi", "lo", "first"), ["hi", "lo"]).select("doc_id", "line_no", name, (place == F.col("first")).alias("kept"))
    blank = lines.where("hi IS NULL").select("doc_id", "line_no", F.lit(None).cast("string").alias("component_id"), F.lit(True).alias("kept"))
    return alone.unionByName(copies).unionByName(blank)


def drop_similar_lines(docs: DataFrame, similarity: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, all columns, with each text cut to its kept lines. Ids must be unique; a null id keeps its whole text."""
    gone = similar_lines(docs, similarity, id_col, text_col).where("NOT kept").groupBy("doc_id").agg(F.collect_set("line_no").alias("__gone")).withColumnRenamed("doc_id", "__id")
    kept = F.array_join(F.filter(F.split(F.col(text_col), "\n", -1), lambda line, i: ~F.array_contains("__gone", i)), "\n")
    return docs.join(gone, F.col(id_col) == F.col("__id"), "left").withColumn(text_col, F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(kept)).select(*docs.columns)
