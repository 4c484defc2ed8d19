"""Connected components of an undirected graph given as (a, b) rows of longs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node with an edge; the component is its least node.

    Each round gives every node its least smaller neighbour, ties its other
    smaller neighbours to that one and moves all edges a step towards the root,
    until only stars are left. The tables stay distributed; joins meet minima
    that were written first, so a hub's edges can be dealt to many tasks.
    """
    a, b = F.col("a"), F.col("b")
    e = written(edges.where(a != b).select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct())
    sign = None
    while True:
        parent = written(e.groupBy("hi").agg(F.min("lo").alias("m")))
        tied = (e.join(parent, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
                .unionByName(parent.select("hi", F.col("m").alias("lo"))))
        up = parent.select(F.col("hi").alias("_at"), F.col("m").alias("_up"))
        e = written(tied.join(up, tied["lo"] == up["_at"], "left")
                   .select("hi", F.coalesce("_up", "lo").alias("lo")).distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(now) == sign:
            break
        sign = tuple(now)
    members = e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = e.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    return members.unionByName(roots)
