"""Prefix trie of conversations by collapsing whole sequences."""

import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import materialize
from lettermill.operators.store import running

#: A key with more than this share of the rows is joined by broadcast; there can be at most 1 / HOT_SHARE such keys.
HOT_SHARE = 0.001
#: Ids of one end list that stand in a row; longer lists are hashed row after row.
CHUNK = 4096
NODE = ["depth", "a", "b"]


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), n_turns, x, y, n_bytes of the turns: two 64-bit hashes of the turn's SHA-256, and the bytes of its text.

    A conversation's turns are ordered by turn, null first, equal ones by content.
    Null role or text is empty. Rows with a null conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(digest).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    ranked = running(materialize(rows, "turns"), ["conv_id"], ["turn", "digest"], {"place": F.lit(1)}, totals=True)
    return materialize(ranked.select("conv_id", "place", F.col("place_total").alias("n_turns"), F.xxhash64(F.lit(1), "digest").alias("x"), F.xxhash64(F.lit(2), "digest").alias("y"), "n_bytes"), "ranked")


def met(rows: DataFrame, side: DataFrame, size: str, most: float) -> DataFrame:
    """rows joined with side on conv_id, which is unique in side. Both have the conversation's `size`; those above `most` are few and go by broadcast."""
    hot = rows.where(F.col(size) > most).join(F.broadcast(side.where(F.col(size) > most).drop(size)), "conv_id")
    return hot.unionByName(rows.where(F.col(size) <= most).join(side.where(F.col(size) <= most).drop(size), "conv_id"))


def limit(rows: DataFrame) -> float:
    return max(1000.0, rows.count() * HOT_SHARE)


def rebuilt(turns: DataFrame, group: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, place, n_turns, x, y, n_bytes) and conversations (conv_id, n_turns) after each got another beginning.

    Conversation c begins with the first h turns (all if there are fewer) of the
    first one of its `group` consecutive ids, none if that is absent, and goes on
    with its own turns after its first h; h is the CRC-32 of its decimal id modulo
    `heads`. No conversation goes, also if no turn is left.
    """
    sizes = turns.where("place = 1").select("conv_id", "n_turns")
    first = sizes.select(F.col("conv_id").alias("first"), F.col("n_turns").alias("n_first"))
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).alias("h")
    convs = sizes.select("conv_id", "n_turns", h, (F.col("conv_id") - F.pmod("conv_id", F.lit(group))).alias("first")).join(first, "first", "left")
    convs = materialize(convs.select("conv_id", "n_turns", "h", F.least("h", F.coalesce("n_first", F.lit(0))).alias("head")), "convs")
    length = F.col("head") + F.greatest(F.col("n_turns") - F.col("h"), F.lit(0))
    own = met(turns, convs, "n_turns", limit(turns)).where("place > h")
    own = own.select("conv_id", (F.col("head") + F.col("place") - F.col("h")).alias("place"), length.alias("n_turns"), "x", "y", "n_bytes")
    given = turns.where((F.pmod("conv_id", F.lit(group)) == 0) & (F.col("place") < heads)).drop("n_turns")
    given = given.withColumn("conv_id", F.explode(F.transform(F.sequence(F.lit(0), F.lit(group - 1)), lambda k: F.try_add("conv_id", k.cast("long"))))).join(convs, "conv_id").where("place <= h")
    rows = own.unionByName(given.select("conv_id", "place", length.alias("n_turns"), "x", "y", "n_bytes"))
    return materialize(rows, "rebuilt"), convs.select("conv_id", length.alias("n_turns"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) from the conversations (conv_id, depth, a, b) that end in a node: SHA-256 of their ids, ascending, joined by commas.

    A list of any length is cut into rows of CHUNK ids. A digest is a chain, so the
    rows of a longer list pass through one task one after another, and none but the
    present one is held.
    """
    ranked = running(ends, NODE, ["conv_id"], {"place": F.lit(1)}, totals=True).withColumn("chunk", F.expr(f"(place - 1) div {CHUNK}"))
    texts = ranked.groupBy(*NODE, "place_total", "chunk").agg(F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))
    texts = materialize(texts, "ends")

    def chain(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("ends_sha256", pa.string())])
        key, digest = None, None
        done: list = []
        for batch in batches:
            for *own, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if own != key:
                    done += [(*key, digest.hexdigest())] if key else []
                    key, digest = own, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in done], schema)
            done = []
        if key:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (*key, digest.hexdigest()), strict=True))], schema)

    long = texts.where(F.col("place_total") > CHUNK).repartition(*NODE).sortWithinPartitions(*NODE, "chunk").select(*NODE, "ids")
    return texts.where(F.col("place_total") <= CHUNK).select(*NODE, F.sha2("ids", 256).alias("ends_sha256")).unionByName(long.mapInArrow(chain, "depth long, a long, b long, ends_sha256 string"))


def whole_sequences(rows: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Identical conversations collapsed: sequences (conv_id, depth, a, b, weight), the rows of their prefixes, and what each conversation ends in (conv_id, depth, a, b).

    A prefix is told by its length and by 128 bits, the exclusive or of its turns'
    hashes at their places. conv_id of a sequence is the smallest of its conversations.
    """
    at = [F.xxhash64(F.lit(k), F.col(c), "place") for k, c in ((3, "x"), (4, "y"))]
    marked = materialize(rows.withColumns({"x": at[0], "y": at[1]}), "marked")
    prefixes = materialize(running(marked, ["conv_id"], ["place"], {}, xors={"a": F.col("x"), "b": F.col("y")}), "prefixes")
    none = F.lit(0).cast("long")
    ends = prefixes.where("place = n_turns").select("conv_id", F.col("place").alias("depth"), "a", "b").unionByName(convs.where("n_turns = 0").select("conv_id", none.alias("depth"), none.alias("a"), none.alias("b")))
    ends = materialize(ends, "ends")
    whole = materialize(ends.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("weight")), "whole")
    own = met(prefixes, whole.select("conv_id", F.col("depth").alias("n_turns"), "weight").where("n_turns > 0"), "n_turns", limit(prefixes))
    above = [(F.col(c).bitwiseXOR(F.col(x))).alias(f"above_{c}") for c, x in (("a", "x"), ("b", "y"))]
    own = own.select("conv_id", F.col("place").alias("depth"), "a", "b", *above, "n_bytes", "n_turns", "weight")
    roots = whole.select("conv_id", none.alias("depth"), none.alias("a"), none.alias("b"), none.alias("above_a"), none.alias("above_b"), none.alias("n_bytes"), F.col("depth").alias("n_turns"), "weight")
    return whole, materialize(own.unionByName(roots), "own"), ends


def leaf_sequences(whole: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The sequences that are no proper prefix of another one."""
    proper = prefixes.where("depth < n_turns").select(*NODE).distinct()
    return whole.join(proper, NODE, "left_anti")


def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    rows (conv_id, place, n_turns, x, y, n_bytes) are the turns of conversations
    (conv_id, n_turns), as turn_rows() and rebuilt() give them. A node is a
    distinct beginning of conversations, the root that of no turn; its members are
    the conversations that begin with it, conv_id is the smallest of them.
    n_leaves and saved_tokens sum up over the node's subtree, itself included:
    childless nodes, and (n_convs - 1) times the bytes of the node's last text.

    Identical conversations are one weighted sequence first; weights of a prefix
    meet after partial sums. What a node adds to the nodes above it is counted in
    the sequence of its smallest member alone, so it travels along one sequence and
    is never spread over pairs of nodes. No conversations give no node.
    """
    whole, prefixes, ends = whole_sequences(rows, convs)
    leaves = leaf_sequences(whole, prefixes).select(*NODE, F.lit(1).alias("leaf"))
    nodes = prefixes.groupBy(*NODE).agg(F.sum("weight").alias("n_convs"), F.min("conv_id").alias("conv_id"), *[F.min(c).alias(c) for c in ("above_a", "above_b", "n_bytes")])
    nodes = materialize(nodes.join(leaves, NODE, "left").withColumn("leaf", F.coalesce("leaf", F.lit(0))), "nodes")
    adds = nodes.select("conv_id", "depth", ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("add"), "leaf")
    # a node's smallest member and depth are its own alone
    valued = materialize(prefixes.select("conv_id", *NODE).join(adds, ["conv_id", "depth"], "left").na.fill(0, ["add", "leaf"]), "valued")
    below = running(valued, ["conv_id"], ["depth"], {"saved": F.col("add"), "leaves": F.col("leaf")}, descending=True)
    sums = below.groupBy(*NODE).agg(F.sum("saved").alias("saved_tokens"), F.sum("leaves").alias("n_leaves"))
    above = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("above_a").alias("a"), F.col("above_b").alias("b")).agg(F.count("*").alias("n_children"))
    named = materialize(nodes.join(above, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))), "named")
    parents = named.where("n_children > 0").select((F.col("depth") + 1).alias("depth"), F.col("a").alias("above_a"), F.col("b").alias("above_b"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("siblings"))
    up, most = ["depth", "above_a", "above_b"], limit(named)
    child = named.where("depth > 0").join(F.broadcast(parents.where(F.col("siblings") > most).drop("siblings")), up, "left")
    rest = child.where("parent_conv_id IS NULL").drop("parent_conv_id").join(parents.where(F.col("siblings") <= most).drop("siblings"), up)
    top = named.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    placed = child.where("parent_conv_id IS NOT NULL").unionByName(rest).unionByName(top)
    found = placed.join(sums, NODE).join(end_digests(ends), NODE, "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """prefix_trie of conversations (conv_id, turn, role, text) as they are; other columns are not read."""
    turns = turn_rows(conversations)
    return prefix_trie(turns, turns.where("place = 1").select("conv_id", "n_turns"))


def training_sequences(conversations: DataFrame) -> DataFrame:
    """What is left to train on when whole sequences collapse: conv_id, n_turns and weight of each distinct conversation that no longer one begins with."""
    turns = turn_rows(conversations)
    whole, prefixes, _ = whole_sequences(turns, turns.where("place = 1").select("conv_id", "n_turns"))
    return leaf_sequences(whole, prefixes).select("conv_id", F.col("depth").alias("n_turns"), "weight")
