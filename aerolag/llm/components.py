"""Connected components of a graph, by joins that pull every node to the smallest one near it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolag.storage import stage

#: Edges a task writes at least: a file for each of many tasks of a few edges costs more than they do.
EDGES_A_TASK = 200_000


def _mark(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges."""
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.hash("u", "v").cast("long"))).first())


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b) that is not the smallest of its component.

    ``component`` is the component's smallest node. Each round ties the larger neighbours of every
    node to its smallest neighbour, then the smaller ones, and writes the edges down; rounds end when
    they change nothing. A node with many neighbours is summed up before it is shuffled, and its join
    is one that adaptive execution splits. Links of a node to itself, nulls and repeats do no harm.
    """
    larger, smaller = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    edges = stage(links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(larger, smaller).distinct(), "edges")
    before = _mark(edges)
    while before[0]:
        tasks = -(-before[0] // EDGES_A_TASK)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("least")).select("u", F.least("u", "least").alias("least"))
        pulled = edges.select(F.col("v").alias("u"), F.col("u").alias("high")).join(nearest, "u")
        pulled = pulled.select(F.col("high").alias("u"), F.col("least").alias("v")).distinct()
        pulled = stage(pulled.coalesce(tasks), "edges")
        nearest = pulled.groupBy("u").agg(F.min("v").alias("least"))
        rest = pulled.join(nearest, "u").filter("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        edges = stage(nearest.select("u", F.col("least").alias("v")).unionByName(rest).distinct().coalesce(tasks), "edges")
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
