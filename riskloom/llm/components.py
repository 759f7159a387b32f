"""Connected components of a link table by alternating large and small stars (Kiveris et al., 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from riskloom.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(r)


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that ``links`` (a, b) has; a component is named by its least node.

    Each round turns neighbourhoods into stars; a node's neighbours are never
    gathered, only their minimum is, so a huge component costs no more a link
    than a small one.
    """
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("of"), F.least("of", "m").alias("m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("of")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "of")
        joined = large.join(least, F.col("a") == F.col("of"))
        small = (joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(least.select(F.col("of").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct())
        edges = stored(small, "small-star")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
