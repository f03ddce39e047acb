"""Connected components of a table of links, by hooking and pointer jumping.

Each round hooks every node to its smallest neighbour, follows the hooks to their roots, and carries the
links over to the roots; links inside a component vanish. All steps are joins whose one side has one row per
node, so adaptive execution can split a hot node, and each result is a stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.common import store


def _roots(hooks: DataFrame) -> DataFrame:
    """(node, root) from (node, root) hooks to smaller nodes, followed to their ends."""
    while True:
        up = hooks.select(F.col("node").alias("root"), F.col("root").alias("next"))
        jumped = store(
            hooks.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
            "component-hooks",
        )
        hooks = jumped.drop("moved")
        if jumped.where("moved").isEmpty():
            return hooks


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the smallest node it is linked with.

    Null ends and links of a node with itself are ignored; repeated links do no harm.
    """
    ends = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    both = store(ends.select("a", "b").unionByName(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "component-links")
    labels = None
    while not both.isEmpty():
        hooks = both.groupBy("a").agg(F.min("b").alias("b")).where("b < a").select(F.col("a").alias("node"), F.col("b").alias("root"))
        roots = _roots(store(hooks, "component-hooks"))
        if labels is None:
            base = both.select(F.col("a").alias("node")).distinct().withColumn("component", F.col("node"))
        else:
            base = labels
        at = roots.select(F.col("node").alias("component"), "root")
        labels = store(base.join(at, "component", "left").select("node", F.coalesce("root", "component").alias("component")), "component-labels")
        ra = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        rb = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = both.join(ra, "a", "left").join(rb, "b", "left").select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
        both = store(moved.where("a != b").distinct(), "component-links")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    return labels
