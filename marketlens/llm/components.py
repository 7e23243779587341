"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, parked


def components(links: DataFrame) -> DataFrame:
    """``node, comp`` for every node of the links ``a, b``; ``comp`` is some node of the component, the same for all of it.

    Every round hangs each node under the smallest of itself and its neighbours and goes on with the links between the
    heads, of which there are fewer by a constant factor.  Rounds are tables in the shared folder, of which the last stays; the caller may discard it.  A node's neighbours are
    only ever reduced to a minimum, which is combined before the shuffle, so a hub of any size is no burden.
    """
    edges = parked(links.where("a <> b").select("a", "b").distinct(), "links")
    assigned = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    assigned = assigned.withColumn("comp", F.col("node"))
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        heads = both.groupBy(F.col("a").alias("comp")).agg(F.min("b").alias("least"))
        heads = parked(heads.select("comp", F.least("comp", "least").alias("head")), "heads")
        before, assigned = assigned, parked(
            assigned.join(heads, "comp", "left").select("node", F.coalesce("head", "comp").alias("comp")), "assigned"
        )
        a, b = heads.toDF("a", "head_a"), heads.toDF("b", "head_b")
        links = edges.join(a, "a").join(b, "b").where("head_a <> head_b")
        links = parked(links.select(F.least("head_a", "head_b").alias("a"), F.greatest("head_a", "head_b").alias("b")).distinct(), "links")
        discard(before, edges, heads)
        edges = links
    return assigned
