"""Totals of all subtrees of a forest by parallel tree contraction.

Each round rakes all leaves (their totals are known, and are added to their
parents') and then compresses chains of inner nodes with one child: by pointer
doubling every node of a chain learns in a few joins, log of the chain's length,
the node below the chain and what lies between; all of them are taken out, and
the node below hangs on to the one above with the chain's values kept on the
new edge. Then every inner node has two children or more, so a rake takes at
least half of what is left, and rounds are few however deep the forest is.
Going back through the rounds, every node that was compressed gets its own
value and the total of the node below its chain.

What a parent gets from its children is added up before it is shuffled, and
only parents with a single child look that child up, so a node with a third of
all nodes as children is no hot key. The forest left and the nodes taken out
are written to the shared folder in each round."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise

KEPT = 16  # tables of totals that are read side by side before they are written as one


def subtree_totals(nodes: DataFrame, values: list[str]) -> DataFrame:
    """``node`` and, in the columns ``values`` (long), their sums over its
    subtree, itself included. ``nodes`` has ``node`` (unique, not null),
    ``parent`` (null of a root, else one of the nodes), ``kids`` (long, its
    number of children) and the values. A circle of parents is an error."""
    own = F.struct(*[F.col(v).cast("long").alias(v) for v in values])
    none = F.struct(*[F.lit(0).cast("long").alias(v) for v in values])

    def plus(*structs: str) -> Column:
        return F.struct(*[sum((F.col(f"{x}.{v}") for x in structs[1:]), F.col(f"{structs[0]}.{v}")).alias(v) for v in values])

    # own: the node's value and what raked children gave; edge: values of compressed nodes up to the parent.
    alive = materialise(nodes.select("node", "parent", F.col("kids").cast("long").alias("kids"), own.alias("own"), none.alias("edge")), "forest")
    left = alive.count()
    rounds: list[tuple[DataFrame, DataFrame | None]] = []
    while left:
        leaves = alive.where("kids = 0").select("node", F.col("own").alias("total"))
        given = alive.where("kids = 0 AND parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            F.count("*").alias("gone"), F.struct(*[F.sum(F.col(f"own.{v}") + F.col(f"edge.{v}")).alias(v) for v in values]).alias("given")
        )
        rest = alive.where("kids > 0").join(given, "node", "left")
        rest = rest.select(
            "node", "parent", (F.col("kids") - F.coalesce("gone", F.lit(0))).alias("kids"),
            F.when(F.col("gone").isNull(), F.col("own")).otherwise(plus("own", "given")).alias("own"), "edge",
        )
        rest = materialise(rest, "raked")
        numbers = rest.agg(F.count("*").alias("all"), F.count_if(F.expr("kids = 1 AND parent IS NOT NULL")).alias("chains")).first()
        if numbers["all"] == left:
            raise ValueError("parents form a circle")
        alive, left, chains = rest, numbers["all"], None
        if numbers["chains"]:
            chains = _chains(rest, plus)
            alive = materialise(_without(rest, chains, plus), "forest")
            left -= numbers["chains"]
        rounds.append((leaves, chains))
    return _expanded(rounds, nodes.select("node", own.alias("total")).where("false"), plus).select("node", "total.*")


def _chains(rest: DataFrame, plus: Callable[..., Column]) -> DataFrame:
    """All nodes with a parent and one child: ``node``, ``parent``, ``edge``,
    the node below its chain (``via``) and the values down to it (``own``)."""
    single = rest.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n"), F.min(F.struct("node", "kids", "edge")).alias("child"))
    steps = rest.where("kids = 1 AND parent IS NOT NULL").join(single.where("n = 1").select("node", "child"), "node")
    steps = steps.select("node", "parent", "edge", F.col("child.node").alias("via"), plus("own", "child.edge").alias("own"), (F.col("child.kids") != 1).alias("ends"))
    steps = materialise(steps, "chains")
    done, open_ = [steps.where("ends")], steps.where("NOT ends")
    left = open_.count()
    while left:
        known = reduce(DataFrame.union, [*done, open_]).select(F.col("node").alias("via"), F.col("via").alias("next"), F.col("own").alias("further"), F.col("ends").alias("over"))
        doubled = open_.join(known, "via").select("node", "parent", "edge", F.col("next").alias("via"), plus("own", "further").alias("own"), F.col("over").alias("ends"))
        doubled = materialise(doubled, "chains")
        done.append(doubled.where("ends"))
        open_ = doubled.where("NOT ends")
        before, left = left, open_.count()
        if left == before:
            raise ValueError("parents form a circle")
    return reduce(DataFrame.union, done).drop("ends")


def _without(rest: DataFrame, chains: DataFrame, plus: Callable[..., Column]) -> DataFrame:
    """The forest without the chains' nodes; who hung below a chain hangs on
    to the node above it."""
    inner = chains.select(F.col("node").alias("parent"))
    tops = chains.join(inner, "parent", "left_anti")
    above = tops.select(F.col("via").alias("node"), F.col("parent").alias("above"), plus("edge", "own").alias("across"))
    kept = rest.where("NOT (kids = 1 AND parent IS NOT NULL)").join(above, "node", "left")
    return kept.select(
        "node", F.when(F.col("across").isNull(), F.col("parent")).otherwise(F.col("above")).alias("parent"), "kids", "own", F.coalesce("across", "edge").alias("edge")
    )


def _expanded(rounds: list[tuple[DataFrame, DataFrame | None]], none: DataFrame, plus: Callable[..., Column]) -> DataFrame:
    totals, tables = none, 0
    for leaves, chains in reversed(rounds):
        if chains is not None:
            known = totals.select(F.col("node").alias("via"), "total")
            back = chains.join(known, "via").select("node", plus("own", "total").alias("total"))
            totals = totals.union(materialise(back, "expanded"))
        totals, tables = totals.union(leaves), tables + 2
        if tables >= KEPT:
            totals, tables = materialise(totals, "totals"), 0
    return totals
