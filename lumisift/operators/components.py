"""Connected components of links as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lumisift.session import shared_folder

SALTS = 8


def written(df: DataFrame, purpose: str) -> DataFrame:
    """A table of its own in the shared folder, which survives the executors that made it."""
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def looked_up(rows: DataFrame, key: str, spread: str, roots: DataFrame) -> DataFrame:
    """``rows`` with the root of ``key`` as ``found``. A node that many rows name is looked up in salted copies."""
    copies = roots.select(F.col("node").alias("__node"), F.col("root").alias("found"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int"))
    met = salted.join(copies, (F.col(key) == F.col("__node")) & (salted["__salt"] == copies["__salt"]))
    return met.drop("__salt", "__node")


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)``: the smallest node each linked node can reach, for edges ``(a, b)``.

    Every round a node takes the smallest root among its neighbours and then that root's own root, so the rounds grow with
    the logarithm of the longest path in practice. The driver sees one number a round.
    """
    links = edges.filter("a <> b")
    both = written(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")), "roots")
    while True:
        near = looked_up(both, "b", "a", roots).groupBy("a").agg(F.min("found").alias("near"))
        closer = roots.join(near, roots["node"] == near["a"]).select("node", "root", F.least("root", "near").alias("next"))
        jumped = written(looked_up(closer, "next", "node", roots).select("node", "root", F.least("next", "found").alias("next")), "roots")
        moved = jumped.filter("root <> next").limit(1).count()
        roots = jumped.select("node", F.col("next").alias("root"))
        if not moved:
            return roots
