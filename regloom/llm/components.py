"""Connected components of a large sparse graph of documents."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .staging import materialize


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node with a link; component is the smallest
    node reachable.

    Alternates two steps on the edge table, each a minimum per node and a join,
    until the table stays as it is: hang the larger neighbours of each node,
    then the smaller ones, on its smallest neighbour. The rounds grow with the
    logarithm of the graph. Each round's table is written to the shared folder.
    """
    edges = materialize(links.filter(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v").filter("u <> v").distinct())
        edges = materialize(small, "edges")
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.expr("coalesce(bit_xor(xxhash64(u, v)), 0)").alias("h")).first()
        if mark == (now["n"], now["h"]):
            break
        mark = (now["n"], now["h"])
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
