"""Connected components by alternating large and small stars, all in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.tables import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Every neighbour of a node (for ``large`` the greater ones, else the smaller ones and itself) to its least one.

    A node's least neighbour is an aggregate that combines before the shuffle, and the join that follows is split where a
    hub has very many neighbours.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")).withColumnRenamed("u", "node")
    out = both.join(least, F.col("u") == F.col("node"))
    if large:
        out = out.filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = out.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("node").alias("a"), F.col("m").alias("b"))
        )
    return out.filter(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, name: str = "links") -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the least node that links reach. A stored table.

    Each round is a written table, so a lost executor costs a round at most. Rounds end when stars stay as they are.
    """
    turned = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, before = stored(turned.filter("a <> b").distinct(), name), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == before:
            break
        before = mark
        if mark[0] == 0:
            break
        now = stored(_stars(_stars(now, True), False), name)
    leaves = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return leaves.union(now.select("b", "b").distinct().toDF("node", "component"))
