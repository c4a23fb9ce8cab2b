"""Connected components of an edge list, by alternating star contractions.

Only the smallest neighbour of a node is ever aggregated, so that no neighbour list is collected and a
node with very many edges costs one partial sum like any other. Each round is written to the shared
folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the edges (u, v): root is the smallest node of its component.

    Repeated edges, loops and either direction are fine; null ends are ignored.
    """
    ends = edges.where("u is not null and v is not null").select("u", "v")
    nodes = ends.select(F.col("u").alias("node")).unionByName(ends.select(F.col("v").alias("node"))).distinct()
    now = written(ends.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    before = None
    while True:
        # large star: larger neighbours move to the smallest one
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            break
        before = state
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
