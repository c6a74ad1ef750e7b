"""Connected components of a link table, by alternating star contractions."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanestride.session import stage


def components(links: DataFrame, source: str = "a", target: str = "b") -> DataFrame:
    """(node, component) for every node with a link; component is its smallest reachable node.

    Each round hangs every node's larger neighbours on its smallest neighbour,
    then the smaller ones; after logarithmically many rounds all components
    are stars.  A round is two partial minimum aggregations and two joins on
    the node, staged in the shared folder, so a lost executor costs one round
    and the engine may split the join at a node with very many links.
    """
    edges = (links.where(F.col(source) != F.col(target))
             .select(F.greatest(source, target).alias("hi"), F.least(source, target).alias("lo")).distinct())
    edges = stage(edges)
    shape = None
    while True:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        smallest = large.groupBy("hi").agg(F.min("lo").alias("m"))
        kept = large.join(smallest, "hi")
        small = (kept.where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                 .unionByName(kept.select("hi", F.col("m").alias("lo"))).distinct())
        edges = stage(small)
        now = edges.agg(F.count("*"), F.sum(F.hash("hi", "lo").cast("long"))).first()
        if tuple(now) == shape:
            break
        shape = tuple(now)
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        edges.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct())
