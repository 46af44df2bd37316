"""Connected components of a link table, by alternating star contractions.

Union-find as joins: each round hangs every node's larger neighbours on its smallest neighbour (large star) and
then its smaller neighbours on the smallest of them (small star). The number of rounds is logarithmic in practice, a node with
very many links costs one row per link and round, and nothing is gathered per component or on the driver. Each round is
a written table, so a lost executor repeats tasks, not rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise.session import materialize


def _print_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node that has a link to another one, from two-column links; component is the smallest node."""
    a, b = links.columns
    edges = links.select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).where("high > low").distinct()
    edges = materialize(edges, "links")
    now = _print_of(edges)
    while now[0]:
        both = edges.select(F.col("high").alias("u"), F.col("low").alias("v")).union(edges.select(F.col("low").alias("u"), F.col("high").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("high"), F.col("m").alias("low"))
        smallest = large.groupBy("high").agg(F.min("low").alias("m"))
        moved = large.join(smallest, "high").where("low > m").select(F.col("low").alias("high"), F.col("m").alias("low"))
        edges = materialize(moved.union(smallest.select("high", F.col("m").alias("low"))).distinct(), "links")
        before, now = now, _print_of(edges)
        if now == before:
            break
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).union(
        edges.select("low").distinct().select(F.col("low").alias("node"), F.col("low").alias("component"))
    )
