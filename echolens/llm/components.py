"""Connected components of an edge table, by random contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolens.llm.common import durable

MAX_ROUNDS = 200


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b); component = smallest node.

    Each round maps every node to its neighbour (or itself) with the smallest
    hash, drawn anew per round, and contracts the edges along the map; the edge
    table shrinks by a constant factor whatever the shape of the graph, and a
    star ends in a round or two. Only tables are passed on: nothing is collected
    but the count that ends the loop. Null ends are ignored; loops and repeated
    edges are harmless; an empty table gives an empty table.
    """
    live = durable(
        edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint"))
        .filter("a is not null and b is not null and a != b").distinct()
    )
    nodes = live.select(F.col("a").alias("node")).union(live.select("b")).distinct()
    total = nodes.select("node", F.col("node").alias("root"))
    for i in range(MAX_ROUNDS):
        if live.isEmpty():
            break
        order = lambda c: F.struct(F.xxhash64(F.lit(i), F.col(c)).alias("h"), F.col(c).alias("n"))
        both = live.select("a", order("a").alias("own"), order("b").alias("other")).union(
            live.select("b", order("b"), order("a"))
        )
        step = durable(
            both.groupBy("a").agg(
                F.least(F.min("other"), F.min("own")).getField("n").alias("to")
            )
        )
        total = durable(
            total.join(step.withColumnRenamed("a", "root"), "root", "left")
            .select("node", F.coalesce("to", "root").alias("root"))
        )
        live = durable(
            live.join(step.select("a", F.col("to").alias("ta")), "a")
            .join(step.select(F.col("a").alias("b"), F.col("to").alias("tb")), "b")
            .filter("ta != tb").select(F.col("ta").alias("a"), F.col("tb").alias("b")).distinct()
        )
    else:
        raise RuntimeError("components did not settle")
    smallest = total.groupBy("root").agg(F.min("node").alias("component"))
    return total.join(smallest, "root").select("node", "component")
