"""Connected components by alternating large-star and small-star rounds on DataFrames."""

from pyspark.sql import DataFrame, functions as F

from rookery.plans.scratch import Scratch


def _is_stars(edges: DataFrame) -> bool:
    """Whether every node has one root, which has none itself."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("a").alias("node"), F.lit(1).alias("child"), F.lit(0).alias("parent")),
        F.struct(F.col("b").alias("node"), F.lit(0).alias("child"), F.lit(1).alias("parent")),
    )))
    roles = ends.groupBy("node").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
    return roles.where("child > 1 or (child > 0 and parent > 0)").isEmpty()


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of every node but the roots; a root is the least node of its component.

    ``edges`` has two columns (a, b) of one orderable type. Neighbours meet in minimum
    aggregates and joins only, never in a list. A round is one written table.
    """
    edges = edges.toDF("a", "b").where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = scratch.save(edges.distinct(), f"{name}_0")
    turn = 0
    while not _is_stars(edges):
        turn += 1
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = small.unionByName(least.select("a", F.col("m").alias("b")))
        edges = scratch.save(small.where("a != b").distinct(), f"{name}_{turn}")
        scratch.drop(f"{name}_{turn - 1}")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
