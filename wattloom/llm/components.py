"""Connected components by alternating large-star and small-star steps.

No step gathers a node's neighbours: each takes a minimum over them, with partial
sums before the shuffle, and joins it back on a key of its own shuffle, so that
the many links of a star's centre can be split over tasks.  Every round is
written to the shared folder, so lineage does not grow, and the round before it
is then deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import new_folder, remove
from .common import apart


def _least(links: DataFrame, key: str, other: str, own: bool) -> DataFrame:
    """(key, m): the smallest neighbour of each node, itself included where own says so."""
    found = links.groupBy(key).agg(F.min(other).alias("m"))
    return found.select(apart(key).alias(key), (F.least(key, "m") if own else F.col("m")).alias("m"))


def _settled(edges: DataFrame) -> bool:
    """Whether all links are stars: no node has two smaller neighbours, or a smaller and a larger one."""
    ends = F.array(F.struct(F.col("hi").alias("node"), F.lit(1).alias("up")), F.struct(F.col("lo").alias("node"), F.lit(0).alias("up")))
    nodes = edges.select(F.explode(ends).alias("e")).select("e.*").groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least"))
    return nodes.where("ups > 1 or (ups = 1 and least = 0)").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every node of links (a, b); component is the smallest id reachable.

    Links of a node with itself and repeated links change nothing.
    """
    spark = links.sparkSession
    made: list[str] = []

    def written(df: DataFrame, name: str) -> DataFrame:
        made.append(new_folder(spark, name))
        df.write.option("compression", "zstd").parquet(made[-1])
        return spark.read.schema(df.schema).parquet(made[-1])

    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct(), "edges")
    while not _settled(edges):
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        large = both.where("v > u").join(_least(both, "u", "v", True), "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = written(large, "large")
        small = large.join(_least(large, "hi", "lo", False), "hi").select(F.explode(F.array(F.struct(F.col("hi"), F.col("m").alias("lo")), F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo")))).alias("e")).select("e.hi", "e.lo")
        edges = written(small.where("hi <> lo").distinct(), "edges")
        for path in made[:-1]:
            remove(spark, path)
        del made[:-1]
    centres = edges.select("lo").distinct()
    return edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(centres.select(F.col("lo").alias("id"), F.col("lo").alias("component")))
