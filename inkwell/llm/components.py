"""Connected components of a graph given as a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from inkwell.llm.common import keep_table

MAX_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): label is the smallest node that can be reached.

    Alternates large-star and small-star steps: each node learns the smallest node around it by a minimum that
    combines map-side, and hands it to its neighbours by a join that Spark can split where a node has very many
    links; no neighbour list is ever built. Rounds grow with the logarithm of the longest chain. Each round is
    written to the shared folder. Null ends, loops and repeated links change nothing; no links give no rows.
    """
    edges = keep_table(
        links.where("a is not null and b is not null and a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    before = None
    for _ in range(MAX_ROUNDS):
        state = edges.agg(F.count(F.lit(1)), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == before or not state[0]:
            break
        before = state
        # large star: larger neighbours of a node move to the smallest node around it
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: smaller neighbours of a node, and itself, move to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = keep_table(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
    else:
        raise RuntimeError("components did not settle")
    tops = edges.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(tops)
