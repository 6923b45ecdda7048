"""Connected components of links between documents, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumisift.llm.stored import stored


def components(edges: DataFrame) -> DataFrame:
    """The smallest node that each linked node can reach (`node, root`), for edges `a, b`.

    Each round every node takes the smallest root among its neighbours and then its root's root, so the rounds grow
    with the logarithm of a component's diameter in practice. Each round is a table of its own in the shared folder;
    only the number of changed nodes comes to the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct()
    both = stored(both, "edges")
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), "roots")
    while True:
        seen = both.join(roots, both.b == roots.node).groupBy("a").agg(F.min("root").alias("near"))
        closer = roots.join(seen, roots.node == seen.a).select("node", F.least("root", "near").alias("next"), F.col("root").alias("was"))
        jump = roots.select(F.col("node").alias("at"), F.col("root").alias("beyond"))
        closer = closer.join(jump, closer.next == jump["at"], "left")
        closer = stored(closer.select("node", F.least("next", F.coalesce("beyond", "next")).alias("root"), "was"), "roots")
        changed = closer.where("root <> was").limit(1).count()
        roots = closer.select("node", "root")
        if not changed:
            return roots
