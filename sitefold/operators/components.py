"""Connected components of an edge table, by alternating large-star and small-star rounds.

Each round rewrites edges with two aggregations and joins, and ends in a written table, so that lineage
stays short and a lost executor repeats one round at most; the table before it is deleted. Rounds needed grow with the logarithm of the
components' diameters. Nothing is collected but two numbers for each round.

Rounds have a fixed cost, which a small table needn't pay: callers may name a number of links up to which one task
joins them in memory. The links, a written table, are counted first; the result is the same. Where there are more, nodes
are drawn together until no more than that number are left: each round's tables are a fraction of the one before, so all
rounds together cost little more than the first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from sitefold.plans.shared import materialise, release


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour larger than the node is tied to the smallest neighbour (or the node)."""
    both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them. Edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    tied = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.unionAll(least.select("a", F.col("m").alias("b"))).distinct()


def _in_one_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links (a, b) to every node with the smallest of its component."""
    up: dict = {}

    def find(x):
        root = x
        while (y := up.setdefault(root, root)) != root:
            root = y
        while up[x] != root:  # shorten the way for those that come later
            up[x], x = root, up[x]
        return root

    for batch in batches:
        for a, b in zip(batch["a"], batch["b"]):
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    if nodes := list(up):
        yield pd.DataFrame({"node": nodes, "component": [find(x) for x in nodes]})


def _drawn_together(links: DataFrame, turn: int, keep: Callable[[DataFrame, str], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(moved (node, to), the links that are left between what nodes have moved to).

    Each node goes to the first of itself and its neighbours, in an order by hash that is another one each turn: in the
    nodes' own order a path would lose one node a turn. Every other turn a node with one neighbour goes to it, so a star
    leaves one link at most; not every turn, as the two of a pair would change places for ever.
    """
    by_hash = lambda c: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), F.col(c).alias("to"))
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    found = both.groupBy("a").agg(F.min(by_hash("b")).alias("m"), F.count(F.lit(1)).alias("n"))
    to = F.when((F.col("n") == 1) & F.lit(turn % 2 == 0), F.col("m.to")).otherwise(F.least("m", by_hash("a"))["to"])
    moved = found.select(F.col("a").alias("node"), to.alias("to"))
    moved = keep(moved, "moved")
    left = links.join(moved.toDF("a", "x"), "a").join(moved.toDF("b", "y"), "b").where("x <> y")
    return moved, keep(left.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(), "links")


def _with_smallest(links: DataFrame, small: int, most_rounds: int, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """(node, component) of links (a, b), drawn together until one task can join the rest."""
    turns = []
    while links.count() > small:
        if len(turns) == most_rounds:
            raise RuntimeError(f"more than {small} links are left after {most_rounds} rounds")
        last = links
        moved, links = _drawn_together(last, len(turns), keep)
        release(last)
        turns.append(moved)
    kind = links.schema["a"].dataType.simpleString()
    ends = links.coalesce(1).mapInPandas(_in_one_task, f"node {kind}, component {kind}")
    if not turns:
        return ends
    for moved in reversed(turns):  # back to the nodes of the turn before
        ends = keep(moved.join(ends.toDF("to", "_end"), "to", "left").select("node", F.coalesce("_end", "to").alias("component")), "ends")
    least = ends.groupBy("component").agg(F.min("node").alias("least"))
    return ends.join(least, "component").select("node", F.col("least").alias("component"))


def components(edges: DataFrame, src: str = "src", dst: str = "dst", most_rounds: int = 60, keep: Callable[[DataFrame, str], DataFrame] = materialise, small: int = 0) -> DataFrame:
    """(node, component): component is the smallest node reachable. Only nodes with an edge are listed.

    Self-loops list their node. Null ends are dropped. Nodes may be of any type with an order. small: the number of
    links up to which one task joins them, 0 for none.
    """
    ends = edges.where(F.col(src).isNotNull() & F.col(dst).isNotNull())
    if small and ends.count() <= small:
        kind = ends.schema[src].dataType.simpleString()
        return ends.select(src, dst).toDF("a", "b").coalesce(1).mapInPandas(_in_one_task, f"node {kind}, component {kind}")
    nodes = ends.select(F.explode(F.array(src, dst)).alias("node")).distinct()
    links = ends.where(F.col(src) != F.col(dst)).select(F.greatest(src, dst).alias("a"), F.least(src, dst).alias("b")).distinct()
    links = keep(links, "links")
    if small:
        return nodes.join(_with_smallest(links, small, most_rounds, keep), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    before = None
    for _ in range(most_rounds):
        last, links = links, keep(_small_star(_large_star(links)), "links")
        release(last)
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components haven't settled after {most_rounds} rounds")
    return nodes.join(links.select(F.col("a").alias("node"), F.col("b").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
