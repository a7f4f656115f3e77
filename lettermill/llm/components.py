"""Connected components of links that live in tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lettermill.llm.common import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """links(a, b) of longs -> (node, component): every node of a link with the smallest node that it can reach.

    Alternates large-star and small-star rounds (Kiveris et al., 2014) until the
    set of links no longer changes; each round is written to the scratch folder.
    Loops, repeated links and both directions are allowed; links with a null end
    are ignored. Nothing but a count and a checksum reaches the driver.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = materialize(small.distinct(), "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
