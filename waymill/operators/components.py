"""Weak components by contraction: each node goes to its smallest neighbour, the edges follow."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymill.operators.shared import materialize, observed, release
from waymill.operators.skew import salted_lookup

MAX_ROUNDS = 60
DEEP = 1 / 8  # a share of nodes over which the trees are halved in depth once more


def _nodes(edges: DataFrame) -> tuple[DataFrame, dict]:
    """(u, m, n): each node, the smallest of it and its neighbours, its rows; written out, with the
    numbers of rows, of nodes and of nodes that are neither the middle of a star nor an end with one middle."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    seen = both.groupBy("u").agg(
        F.least(F.min("v"), F.col("u")).alias("m"), F.count(F.lit(1)).alias("n"), F.max("v").alias("high"), F.max(F.when(F.col("v") < F.col("u"), F.col("v"))).alias("low")
    )
    unsettled = F.expr("m < u and (high > u or low > m)")
    nodes, sums = observed(seen.withColumn("unsettled", unsettled), "nodes", rows=F.sum("n"), nodes=F.count(F.lit(1)), unsettled=F.count_if("unsettled"))
    return nodes.select("u", "m", "n"), sums | {"step": nodes}


def _trees(nodes: DataFrame, sums: dict) -> DataFrame:
    """(u, m, n) with m further up: halved in depth until few nodes are still on their way.

    A node has no more children than neighbours, so these say which keys to salt; what gathers at a
    node beyond that, as the trees get flat, is left to AQE's skew split."""
    trees = nodes
    for _ in range(MAX_ROUNDS):
        parents = trees.select(F.col("u").alias("m"), F.col("m").alias("top"), F.col("n").alias("size"))
        at = salted_lookup(trees.select("u", "m", "n"), parents, "m", "size", sums["rows"], F.col("u"))
        last = trees
        trees, seen = observed(at.select("u", F.col("top").alias("m"), "n", (F.col("top") != F.col("m")).alias("moved")), "trees", moved=F.count_if("moved"))
        if last is not nodes:
            release(last)
        if seen["moved"] <= sums["nodes"] * DEEP:
            break
    return trees


def _contracted(edges: DataFrame, trees: DataFrame, total: int) -> tuple[DataFrame, dict]:
    """The edges between what their ends have become, without loops."""
    for end, other in (("u", "v"), ("v", "u")):
        names = trees.select(F.col("u").alias(end), F.col("m").alias(f"{end}_m"), F.col("n"))
        edges = salted_lookup(edges, names, end, "n", total, F.col(other)).drop("n")
    left = edges.filter("u_m <> v_m").select(F.greatest("u_m", "v_m").alias("u"), F.least("u_m", "v_m").alias("v"))
    return observed(left, "edges", rows=F.count(F.lit(1)))


def _composed(steps: list[DataFrame]) -> DataFrame:
    """(node, component): the first step, carried through all later ones. They get smaller each time and
    hold one row a node; where many nodes have met in one, AQE splits the left side."""
    found = steps[0].select("u", "m")
    for step in steps[1:]:
        tops = step.select(F.col("u").alias("m"), F.col("m").alias("top"))
        found = found.join(tops, "m", "left").select("u", F.coalesce("top", "m").alias("m"))
    return found.select(F.col("u").alias("node"), F.col("m").alias("component"))


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, component) for every node that has an edge; component = its smallest node.

    A round sends each node to the smallest of it and its neighbours, shortens the trees that this
    makes, and keeps the edges between different trees. A tree of one node has a smaller neighbour
    in the next round, so two rounds at least halve the nodes, but for the few of ``DEEP``. A vertex
    of high degree is only ever pre-aggregated by ``min`` and joined in parts, never gathered. Self loops keep their node; null ends are ignored.

    What a round reads more than once is written first, so no plan holds a subplan twice, and the
    rounds end when no node is unsettled, without one more round to see that nothing changes.
    """
    ends = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).filter("a is not null and b is not null")
    left = materialize(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    steps: list[DataFrame] = []
    for _ in range(MAX_ROUNDS):
        nodes, sums = _nodes(left)
        if not sums["unsettled"]:
            release(left)
            return _composed([*steps, nodes])
        trees = _trees(nodes, sums)
        release(sums["step"])
        steps.append(trees)
        last = left
        left, seen = _contracted(last, trees, sums["rows"])
        release(last)
        if not seen["rows"]:
            release(left)
            return _composed(steps)
    raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
