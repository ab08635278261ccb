"""Connected components of an edge table, by alternating star rounds.

Each round is two joins: every node's larger neighbours are hung on its least
neighbour (large star), then every node and its smaller neighbours on the
least of them (small star).  Rounds are logarithmic in practice.  Least
neighbours come from partial aggregates, and the other side of the joins has
one row per node, so a hub with very many edges is split by the skew join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repotrend.llm.scratch import Scratch

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (hi, lo), hi > lo, after one star operation."""
    if large:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
            edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
        )
    else:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    hung = both.join(least, "u")
    if large:
        out = hung.where("v > u AND v > m").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    else:
        out = hung.where("v <> m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).union(
            least.select(F.col("u").alias("hi"), F.col("m").alias("lo"))
        )
    return out.distinct()


def components(edges: DataFrame, scratch: Scratch, tag: str = "cc") -> DataFrame:
    """(id, component): the least id reachable, for each id in ``edges`` (a, b).

    Self-loops, repeated edges and nulls are ignored; an empty table gives none.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).distinct()
    now = scratch.save(now, f"{tag}-0")
    last = None
    for turn in range(1, MAX_ROUNDS):
        now = scratch.save(_star(_star(now, True), False), f"{tag}-{turn}")
        scratch.drop(f"{tag}-{turn - 1}")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if mark == last:
            break
        last = mark
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return now.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(
        now.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    )
