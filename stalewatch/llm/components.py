"""Connected components by alternating large-star and small-star rounds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stalewatch.staging import StageArea, stage


def _links(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct()


def _round(links: DataFrame) -> DataFrame:
    """Every node hands its larger neighbours, then its smaller ones, to the least node it knows of.

    The least neighbour is an aggregate and comes back by a join whose large side can be split, so the hub
    of a star is no task of its own.
    """
    both = links.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        links.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
    large = both.filter("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("least").alias("lo")).distinct()
    lowest = large.groupBy("hi").agg(F.min("lo").alias("lowest"))
    handed = large.join(lowest, "hi").select(F.col("lo").alias("hi"), F.col("lowest").alias("lo")).filter("hi <> lo")
    return handed.union(lowest.select("hi", F.col("lowest").alias("lo"))).distinct()


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``node`` and ``component``, the least node that can be reached over ``edges`` (a, b).

    Nodes must be distinct; those without an edge are a component of their own. Each round is written to
    the shared folder, which cuts the lineage; the rounds grow with the logarithm of the longest path.
    """
    spark = nodes.sparkSession
    mark = (F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)")))
    with StageArea(spark) as area:
        links = area(_links(edges), "links")
        before = None
        while (now := tuple(links.agg(*mark).first())) != before:
            before = now
            if now[0] == 0:
                break
            links = area(_round(links), "links")
            area.drop_older(2)
        roots = links.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
        found = nodes.join(roots, "node", "left")
        return stage(found.select("node", F.coalesce("component", "node").alias("component")), "components")
