"""Tables that cut lineage, and places in a global order."""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Setting under which Spark removes the shuffle files of an action when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def folder(spark: SparkSession) -> str:
    """Path of a new folder below the one that spark.checkpoint.dir names; without the setting, one is made in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/table-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df as a table in a folder().

    Lineage ends there, and Spark knows the table's size, so it broadcasts it in a
    join if, and only if, it is below spark.sql.autoBroadcastJoinThreshold.
    """
    spark, path = df.sparkSession, folder(df.sparkSession)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def released(df: DataFrame) -> None:
    """Deletes the folder of a table that written() made and nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        if path.getName().startswith("table-"):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def numbered(df: DataFrame, order: list[str], name: str = "idx") -> DataFrame:
    """df with its place, from 0, in the order of the given columns (equal rows in any order).

    Rows are dealt by range, ranked inside their range, and moved up by the sizes
    of the ranges before: no task has all rows.
    """
    ranged = written(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("n"))  # a row per partition
    ahead = sizes.select("__part", (F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("__ahead"))
    inside = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return ranged.withColumn("__place", inside).join(ahead, "__part").select(*df.columns, (F.col("__ahead") + F.col("__place")).alias(name))


def running(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, Column], descending: bool = False, totals: bool = False, xors: dict[str, Column] | None = None) -> DataFrame:
    """df with, per name, the sum (of `xors`: the exclusive or) of an expression over the rows of equal keys up to this one in the given order.

    With totals, name_total holds what all rows of the keys give. Expressions must
    not be null. Null keys are equal keys, null comes first in an order (last in a
    descending one), and rows of equal keys and order stand in any order, which is
    the same for all names.

    Rows are dealt by range of keys and order, so a key with many rows is many
    tasks. Each task sums up its own rows; only keys on the border of two ranges,
    at most two per range, get what the ranges before have. The table of these is
    broadcast, as its size depends on the number of ranges and not on the rows.
    """
    both = {**{n: (F.sum, c) for n, c in sums.items()}, **{n: (F.bit_xor, c) for n, c in (xors or {}).items()}}
    at, own = ["__part", "__key"], {n: f"__own_{n}" for n in both}
    places = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    # the salt spreads repeated rows, which no range border could part
    marked = df.withColumns({own[n]: c for n, (_, c) in both.items()} | {"__key": F.struct(*keys) if keys else F.struct(F.lit(0).alias("k")), "__salt": F.monotonically_increasing_id()})
    dealt = written(marked.repartitionByRange("__key", *places, "__salt").withColumn("__part", F.spark_partition_id()))
    edges = dealt.groupBy("__part").agg(F.min("__key").alias("low"), F.max("__key").alias("high")).select("__part", F.explode(F.array_distinct(F.array("low", "high"))).alias("__key"))
    cells = dealt.join(F.broadcast(edges), at).groupBy(*at).agg(*[f(own[n]).alias(own[n]) for n, (f, _) in both.items()])
    ahead, every = Window.partitionBy("__key").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("__key")
    offsets = cells.select(*at, *[f(own[n]).over(ahead).alias(f"__ahead_{n}") for n, (f, _) in both.items()], *[f(own[n]).over(every).alias(f"__all_{n}") for n, (f, _) in both.items()])
    inside, whole = Window.partitionBy(*at).orderBy(*places, "__salt").rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*at)
    here = dealt.withColumns({f"__here_{n}": f(own[n]).over(inside) for n, (f, _) in both.items()} | ({f"__sum_{n}": f(own[n]).over(whole) for n, (f, _) in both.items()} if totals else {}))
    met = here.join(F.broadcast(offsets), at, "left")
    upto = {n: F.col(f"__here_{n}") + F.coalesce(f"__ahead_{n}", F.lit(0)) if n in sums else F.col(f"__here_{n}").bitwiseXOR(F.coalesce(f"__ahead_{n}", F.lit(0))) for n in both}
    alls = [F.coalesce(f"__all_{n}", f"__sum_{n}").alias(f"{n}_total") for n in both] if totals else []
    return met.select(*df.columns, *[c.alias(n) for n, c in upto.items()], *alls)
