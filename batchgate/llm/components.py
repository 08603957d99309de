"""Connected components of a link table that no machine has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from batchgate.llm.common import splittable, stage


def _minima(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def _print(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node that a link joins to a smaller one; root is the smallest it reaches.

    Union-find by alternating stars: each node's larger neighbours are linked to the smallest node that
    it sees, then its smaller ones are, until nothing changes; the number of rounds grows with the
    logarithm of the number of nodes.  Each round is a table in the shared folder.  Nodes without links,
    null ends and links to oneself give no row; repeated links count once.
    """
    links = links.where(F.col(a) != F.col(b))
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    e = stage(e, "links")
    seen = _print(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _minima(both).withColumn("m", F.least("u", "m"))
        large = splittable(both, least, "u", "inner").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        joined = splittable(large, _minima(large), "u", "inner")
        ends = F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v"))
        small = joined.select(F.explode(F.array("u", ends)).alias("u"), F.col("m").alias("v")).where("u != v")
        e = stage(small.distinct(), "links")
        now = _print(e)
        if now == seen:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
