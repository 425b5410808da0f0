"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ambitus.session import cut


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): every node of the edges with the smallest node of its component.

    Nodes are compared as their type orders them; rows with a null end are left out, loops name a node of its own.  Each round
    links larger neighbours to the smallest one (large star), then each node and its smaller neighbours to the smallest (small
    star); both are shuffles by node with map-side minima, and the edges of a hub are spread over its neighbours as it shrinks.
    Edges are written to the shared checkpoint folder after each round, so lineage stays short.  An empty table gives no rows.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull())
    alone = e.where(F.col("u") == F.col("v")).select("u")
    e = cut(e.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    nodes = e.select("u").unionByName(e.select(F.col("v").alias("u"))).unionByName(alone).distinct()
    last = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).where(F.col("u") != F.col("v"))
        large = large.distinct()
        # small star: u > v in every row now
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).where(F.col("u") != F.col("v")).distinct()
        e = cut(small)
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if (now["n"], now["h"]) == last:
            break
        last = (now["n"], now["h"])
    found = e.groupBy("u").agg(F.min("v").alias("component"))
    return nodes.join(found, "u", "left").select(F.col("u").alias("node"), F.coalesce("component", "u").alias("component"))
