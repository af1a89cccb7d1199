"""Connected components of a graph of links, by large and small stars.

Every round links each node's larger neighbours to the least node it knows,
then its smaller ones, until no link changes; what is left is a star around
the least node of every component. A node with a third of all links is a hot
key of the joins, which Spark splits (``lookup_join``). The links are written to
the shared folder after each round, so a lost executor costs one round at most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise
from tessera.plans.joins import lookup_join


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return lookup_join(both.where("b > a"), least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = lookup_join(down, least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (columns ``a``, ``b``
    of type long); ``component`` is the least node that links reach. Loops,
    repeated links and nulls are left out of account; no links, no rows."""
    links = materialise(
        links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).where("a != b").distinct(), "links"
    )
    state = _state(links)
    while state[0]:
        links = materialise(_small_star(_large_star(links)), "stars")
        if (now := _state(links)) == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        links.select(F.col("b").alias("node"), F.col("b").alias("component"))
    ).distinct()
