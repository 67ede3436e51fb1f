"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from specloom.session import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of ``links`` (a, b).

    Each round hooks every node to its smallest smaller neighbour, follows the
    hooks to their roots by doubling, and contracts the links to the roots;
    nodes that hook at least halve, so rounds are few. Every table is written,
    so lost executors cost no earlier round. Nothing is collected.
    """
    named = materialise(
        links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links"
    )
    known = None
    while not named.isEmpty():
        hooks = named.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("root"))
        hooks = _roots(materialise(hooks, "hooks"))
        if known is None:
            known = hooks
        else:
            step = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
            moved = known.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            known = materialise(moved.unionByName(hooks).groupBy("node").agg(F.min("root").alias("root")), "roots")
        for end in ("a", "b"):
            to = hooks.select(F.col("node").alias(end), F.col("root").alias("to"))
            named = named.join(to, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
        named = materialise(
            named.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links"
        )
    if known is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    own = known.select(F.col("root").alias("node"), "root").distinct()
    return known.unionByName(own).select("node", F.col("root").alias("component")).distinct()


def _roots(hooks: DataFrame) -> DataFrame:
    """Every node's root: hooks of hooks, until nothing moves."""
    while True:
        step = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = hooks.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = materialise(moved, "hooks")
        hooks = moved.select("node", "root")
        if moved.filter("moved").isEmpty():
            return hooks
