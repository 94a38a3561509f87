"""Connected components of an edge table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id that has an edge.

    ``edges`` has long columns a and b. Every round each id takes the smallest
    label among its own and its neighbours', and then the label of the id that
    this label names, so labels travel ever further in a round. A round is one
    written table; the rounds end when no label moves. Rows with a null end or
    two equal ends are ignored; no edges, no rows.
    """
    links = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = saved(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component"))
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("near"))
        heard = labels.join(near.withColumnRenamed("a", "id"), "id").select("id", "component", F.least("component", "near").alias("low"))
        named = labels.select(F.col("id").alias("low"), F.col("component").alias("lower"))
        moved = saved(heard.join(named, "low").select("id", F.col("component").alias("before"), F.least("low", "lower").alias("component")), "labels")
        labels = moved.select("id", "component")
        if moved.where("before <> component").isEmpty():
            return labels
