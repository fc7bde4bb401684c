"""Connected components of large graphs, by alternating star operations on tables of edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from studymart.session import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours of every node link to the smallest of its neighbourhood."""
    both = edges.union(edges.select("v", "u").toDF("u", "v"))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
    linked = both.join(low, F.col("u") == F.col("w")).filter(F.col("v") > F.col("u"))
    return linked.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours link to the smallest of these; edges point downwards."""
    low = edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w")
    linked = edges.join(low, F.col("u") == F.col("w"))
    ends = F.explode(F.array(F.col("u"), F.col("v"))).alias("u")
    return linked.select(ends, F.col("m").alias("v")).filter(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (a, b: long) but the roots; root: its component's smallest.

    Every round is written to the shared folder; rounds go on until the edges stay as they are.
    """
    down = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now, seen = materialise(down.distinct(), "edges"), None
    while True:
        now = materialise(_small_star(_large_star(now)), "edges")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = mark
