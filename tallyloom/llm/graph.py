"""Connected components by star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stage


def _star_edges(edges: DataFrame) -> DataFrame:
    """Edges as (v, u) with v > u, each once."""
    ordered = edges.select(F.greatest("v", "u").alias("v"), F.least("v", "u").alias("u"))
    return ordered.filter("v > u").distinct()


def _summary(edges: DataFrame) -> tuple[int, int, int]:
    """Number of edges, their sum of hashes, and how many lead from a node with another edge.

    Without any of the last, all edges are stars.
    """
    first = edges.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("h"))
    nodes = first.select(F.col("v").alias("node"), "n", "h", F.lit(0).alias("centre"))
    centres = edges.select(F.col("u").alias("node"), F.lit(0).alias("n"), F.lit(None).cast("decimal(38,0)").alias("h"), F.lit(1).alias("centre"))
    by_node = nodes.unionByName(centres.distinct()).groupBy("node").agg(F.sum("n").alias("n"), F.sum("h").alias("h"), F.max("centre").alias("centre"))
    open_ = F.when((F.col("n") > 1) | ((F.col("n") > 0) & (F.col("centre") > 0)), F.col("n"))
    row = by_node.agg(F.coalesce(F.sum("n"), F.lit(0)), F.sum("h"), F.coalesce(F.sum(open_), F.lit(0))).first()
    return tuple(row)


def components(edges: DataFrame, rounds: int = 60, each: int = 100_000) -> DataFrame:
    """(node, component) for the nodes of ``edges`` (v, u); the component is its smallest node.

    Each round hangs every node below the smallest neighbour of its neighbourhood, first for
    larger neighbours, then for smaller ones. The number of rounds grows with the logarithm of
    the longest path. Minima are staged before the join, so that a node with very many
    neighbours is split by the skew join. Every state is on disk, in a file per ``each`` edges (eight
    at least), and nothing is collected. Edges that are stars already need no round.
    Self loops and repeated edges change nothing; nodes without an edge have no row.
    """
    state = stage(_star_edges(edges), "edges")
    summary = _summary(state)
    for _ in range(rounds):
        if not summary[2]:
            break
        files = max(8, -(-summary[0] // each))
        both = state.unionByName(state.select(F.col("u").alias("v"), F.col("v").alias("u")))
        least = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        least = stage(least.coalesce(files), "least")
        large = both.join(least, "v").filter("u > v").select(F.col("u").alias("v"), "m").distinct()
        large = stage(large.coalesce(files), "large")
        least = stage(large.groupBy("v").agg(F.min("m").alias("low")).coalesce(files), "least")
        small = large.join(least, "v")
        moved = small.filter("m != low").select(F.col("m").alias("v"), F.col("low").alias("u"))
        kept = least.select("v", F.col("low").alias("u"))
        state = stage(_star_edges(moved.unionByName(kept)).coalesce(files), "edges")
        summary = _summary(state)
    else:
        raise RuntimeError(f"no components after {rounds} rounds")
    stars = state.select(F.col("v").alias("node"), F.col("u").alias("component"))
    centres = state.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return stars.unionByName(centres)
