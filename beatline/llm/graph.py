"""Connected components of a link table, as repeated joins (large star, small star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beatline.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of every component; ``links`` has long columns a and b.

    Each round points every node to the smallest of its neighbours (Kiveris et al.:
    larger neighbours, then smaller ones); rounds grow with the logarithm of the
    longest path.  Minima are partial aggregates joined back, so a node with very many
    links is split by the skew handling of the join.  Nodes without links are absent.
    """
    edges = materialize(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .distinct(), "cc")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("v")).select("u", F.least("u", "v").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                                              F.struct("u", F.col("m").alias("v")))).alias("e"))
        new = materialize(small.select("e.u", "e.v").where("u <> v").distinct(), "cc")
        if _mark(new) == _mark(edges):
            return new.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node").unionByName(
                new.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        edges = new


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
