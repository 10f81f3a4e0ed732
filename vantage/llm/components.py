"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vantage.llm.base import written


def _star(edges: DataFrame, large: bool, name: str) -> DataFrame:
    """Link each node's larger (smaller) neighbours and itself to its smallest neighbour."""
    pairs = (edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large
             else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    # written, so that the join below has a plain shuffle on both sides that Spark can split
    least = written(pairs.groupBy("a").agg(F.min("b").alias("low"))
                    .select("a", F.least("a", "low").alias("low")), name)
    joined = pairs.join(least, "a")
    if large:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            least.select("a", F.col("low").alias("b")))
    return out.where("a <> b").distinct()


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component): the smallest node each node of ``edges`` (a, b) is connected with, itself included.

    Self-links are ignored; nodes without any other link are not returned. The steps keep every
    component together and end as stars around their smallest nodes; each step's links are written
    to the shared folder. Hubs are handled by a group with partial minima and a join that Spark can
    split, never by gathering a node's neighbours.
    """
    edges = written(edges.select("a", "b").where("a <> b").distinct(), name)
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] == 0 or tuple(now) == state:
            break
        state = tuple(now)
        edges = written(_star(written(_star(edges, True, name), name), False, name), name)
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
