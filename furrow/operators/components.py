"""Connected components of an edge table, by alternating star contraction.

Each round first points every larger neighbour of a node at the smallest one (large star), then every smaller neighbour
(small star); the table shrinks to stars around the smallest node of each component in about log(diameter) rounds. Only
least-value aggregates and equi-joins are used: the aggregates combine before the shuffle, and a hub's rows in a join can be
split. Rounds are written to the shared checkpoint folder, so lineage stays short and lost executors cost one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow import session

MOST_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges(u, v), u > v, distinct -> the next such table."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("m", "u").alias("_m"))
    if large:
        # every neighbour above the node moves to the smallest of the neighbourhood
        moved = both.where("v > u").join(least, F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("_m").alias("v"))
    else:
        # every neighbour below the node, and the node, move to the smallest
        moved = edges.join(least, F.col("u") == F.col("_u")).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("_m").alias("v")), F.struct("u", F.col("_m").alias("v")))).alias("e")).select("e.u", "e.v")
    return moved.where("u > v").distinct()


def _print(edges: DataFrame) -> tuple:
    """What tells one edge table from another: a count and two sums of hashes."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count("*"), F.sum(h.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(h, 32))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Links (a, b) -> (node, component): the smallest node reachable, for every node that has a link to another.

    Loops, repeated links and links with a null end are passed over; an empty table gives no rows.
    """
    table = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") > F.col("v"))).distinct()
    table = session.written(table, "edges")
    seen = _print(table)
    for _ in range(MOST_ROUNDS):
        if not seen[0]:
            break
        table = session.written(_star(_star(table, True), False), "edges")
        now = _print(table)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")
    leaves = table.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return leaves.unionByName(table.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
