"""Merkle manifest of a table: trees per group under one root, with a proof per row."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import materialize
from lettermill.operators.store import running

PATH = "array<struct<left: string, right: string>>"


def leaf_digest(columns: list[Column]) -> Column:
    """SHA-256 (lowercase hex) of the columns one after another, each as `-` if null, else as its count of UTF-8 bytes, `:` and itself."""
    parts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in parts]), 256)


def slots(fanout: int) -> list[str]:
    return [f"c{s}" for s in range(fanout)]


def parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """nodes (tree, idx, n, h) of trees with several nodes -> their parents (tree, idx, n, c0 ... , h): children spread into columns, which are hashed one after another."""
    spread = nodes.where("n > 1").withColumns({"run": F.expr(f"idx div {fanout}"), "slot": F.expr(f"int(idx % {fanout})")})
    cells = spread.groupBy("tree", "run", "n").agg(*[F.max(F.when(F.col("slot") == s, F.col("h"))).alias(c) for s, c in enumerate(slots(fanout))])
    return cells.select("tree", F.col("run").alias("idx"), F.expr(f"(n + {fanout - 1}) div {fanout}").alias("n"), *slots(fanout), F.sha2(F.concat_ws("", *slots(fanout)), 256).alias("h"))


def siblings(slot: Column, fanout: int) -> Column:
    """The slot columns left and right of the own one."""
    side = lambda test: F.concat_ws("", *[F.when(test(F.lit(s)), F.col(c)) for s, c in enumerate(slots(fanout))])
    return F.struct(side(lambda s: s < slot).alias("left"), side(lambda s: s > slot).alias("right"))


def climb(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The written tables of parents, lowest first, and the top node (tree, h) of each tree."""
    levels, tops = [], [nodes.where("n = 1").select("tree", F.lit(0).alias("level"), "h")]
    # one number tells how many levels there are
    left = nodes.agg(F.max("n")).first()[0] or 0
    while left > 1:
        nodes = materialize(parents(nodes, fanout), f"level{len(levels)}")
        levels.append(nodes)
        tops.append(nodes.where("n = 1").select("tree", F.lit(len(levels)).alias("level"), "h"))
        left = -(-left // fanout)
    found = tops[0]
    for more in tops[1:]:
        found = found.unionByName(more)
    return levels, materialize(found, "tops")


def descend(levels: list[DataFrame], tops: DataFrame, fanout: int, lowest: int) -> DataFrame:
    """(tree, idx, path and what else tops has) of the nodes that stand `lowest` levels above the leaves.

    path: siblings level by level up to the root; tops (tree, level, path, ...) hold what lies above each tree.
    """
    own = lambda level: tops.where(F.col("level") == level).withColumn("level", F.lit(0).cast("long")).withColumnRenamed("level", "idx")
    paths = own(len(levels))
    for level in range(len(levels) - 1, lowest - 1, -1):
        cells = levels[level].drop("n", "h").join(paths, ["tree", "idx"])
        # a child for each slot that is taken
        taken = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), F.lit(s)) for s, c in enumerate(slots(fanout))]))
        child = cells.withColumn("slot", F.explode(taken)).withColumns({"idx": F.col("idx") * fanout + F.col("slot"), "path": F.concat(F.array(siblings(F.col("slot"), fanout)), "path")})
        paths = materialize(child.select(paths.columns).unionByName(own(level)), f"paths{level}")
    return paths


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path of siblings give."""
    return F.aggregate(path, leaf, lambda h, p: F.sha2(F.concat(p["left"], h, p["right"]), 256))


def merkle_manifest(docs: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source", fanout: int = 16, presented: Column | None = None) -> DataFrame:
    """One row per row: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified; then presented_leaf and path.

    A row's leaf is the digest of `columns`. Leaves of a group ascend by id; while
    a group has several nodes, every `fanout` consecutive ones (the last run may be
    shorter) become the digest of their digests, down to the group's subroot; a lone
    leaf is its subroot. Subroots, ordered by group (null first, by UTF-8 bytes),
    become the root in the same way. `path` holds the siblings left and right of
    the node on each level up to the root, proof_sha256 is the digest of all of
    them, and folded_root is what `presented` (a leaf; by default the row's own)
    gives with that path; verified tells whether that is the root.

    Runs are keyed by group and place, so a group with a third of all rows is many
    keys; a level has 1 / fanout of the rows below. Texts are read to be hashed and
    never shuffled. Null ids come first in their group; rows of equal id stand in
    the order of their leaves, and a null group is a group. An empty table gives an
    empty result. Columns that are not named are not read.
    """
    leaf = leaf_digest([F.col(f"`{c}`") for c in columns])
    # a group's name as a key that is never null and keeps the order: '-' stands before '='
    tree = F.coalesce(F.concat(F.lit("="), F.col(f"`{group_col}`").cast("string")), F.lit("-"))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), tree.alias("tree"), leaf.alias("h"), (leaf if presented is None else presented).alias("presented_leaf"))
    rows = running(materialize(rows, "leaves"), ["tree"], ["doc_id", "h", "presented_leaf"], {"rank": F.lit(1)}, totals=True)
    rows = materialize(rows.select("doc_id", "tree", "h", "presented_leaf", (F.col("rank") - 1).alias("idx"), F.col("rank_total").alias("n")), "ranked")
    levels, tops = climb(rows, fanout)
    named = running(tops, [], ["tree"], {"rank": F.lit(1)}, totals=True)
    named = materialize(named.select(F.col("tree").alias("name"), "level", "h", F.lit("all").alias("tree"), (F.col("rank") - 1).alias("idx"), F.col("rank_total").alias("n")), "subroots")
    upper, root = climb(named, fanout)
    above = descend(upper, root.select("tree", "level", F.col("h").alias("root"), F.expr(f"cast(array() as {PATH})").alias("path")), fanout, 0)
    groups = named.select("name", "level", "h", "tree", "idx").join(above, ["tree", "idx"])
    groups = materialize(groups.select(F.col("name").alias("tree"), "level", F.col("h").alias("subroot"), "root", "path"), "groups")
    alone = rows.where("n = 1").join(groups.where("level = 0").drop("level"), "tree").select("doc_id", "h", "subroot", "root", "path", "presented_leaf")
    placed = alone
    if levels:
        runs = levels[0].drop("n", "h").join(descend(levels, groups, fanout, 1), ["tree", "idx"]).withColumnRenamed("idx", "run")
        met = rows.where("n > 1").withColumns({"run": F.expr(f"idx div {fanout}"), "slot": F.expr(f"int(idx % {fanout})")}).join(runs, ["tree", "run"])
        placed = alone.unionByName(met.withColumn("path", F.concat(F.array(siblings(F.col("slot"), fanout)), "path")).select(alone.columns))
    proof = F.sha2(F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), ""), 256)
    folded = placed.select("doc_id", F.col("h").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"), fold(F.col("presented_leaf"), F.col("path")).alias("folded_root"), "presented_leaf", "path")
    return folded.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"), "presented_leaf", "path")
