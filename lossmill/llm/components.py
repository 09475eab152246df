"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossmill.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for every node of ``edges``.

    ``edges`` has two columns of one orderable type; order, repeats and loops do not matter, nulls
    are left out. Each round links the neighbours of a node to the smallest of them, first the
    larger ones and then the smaller ones, and is written to the shared folder; paths shorten by a
    constant factor each round. A node with very many neighbours is one row per task in the
    minimum, and the join splits it where adaptive execution finds it skewed.
    """
    a, b = edges.columns
    links = edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("node"), F.least(a, b).alias("root")
    )
    links = stored(links.distinct(), "components")
    while not _is_forest_of_stars(links):
        links = stored(_small_star(_large_star(links)), "components")
    roots = links.select(F.col("root").alias("node"), "root").distinct()
    return links.unionByName(roots)


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select("root", "node")).toDF("node", "other")
    least = both.groupBy("node").agg(F.min("other").alias("least"))
    least = least.select("node", F.least("node", "least").alias("root"))
    larger = both.where(F.col("other") > F.col("node")).join(least, "node")
    return larger.select(F.col("other").alias("node"), "root").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy("node").agg(F.min("root").alias("least"))
    moved = links.join(least, "node").where("root > least").select("root", "least")
    return moved.toDF("node", "root").union(least.toDF("node", "root")).distinct()


def _is_forest_of_stars(links: DataFrame) -> bool:
    """No node has two roots, and no root is a node of another."""
    per_node = links.groupBy("node").count().where("count > 1").limit(1)
    chained = links.join(links.select(F.col("node").alias("root")), "root", "left_semi").limit(1)
    return per_node.isEmpty() and chained.isEmpty()
