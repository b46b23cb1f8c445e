"""Connected components of a link table by alternating stars, each round a few shuffles of the links left.

The large star moves every larger neighbour of a node to the node's smallest neighbour, the small star moves the smaller
ones and the node itself. Links never grow in number and end as stars around each component's smallest node. Minima are
partial aggregates, so a node with a third of all links is no hot group; each round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbook.session import stage

MAX_ROUNDS = 100


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def stars(links: DataFrame) -> DataFrame:
    """links (a, b) of any order -> (a, b): each node other than its component's smallest, and that smallest node."""
    links = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(links)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            return links
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        links = stage(moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct())
        was, state = state, _state(links)
        if was == state:
            return links
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
