"""Connected components of a link table, by random hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_written, written


def components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: long) -> (node, label): every linked node and one common label per component.

    Each round every node hooks onto its neighbour with the most links, ties in random
    order, if that one comes before it, and the links are contracted. A star is done in
    one round; among nodes with equally many links the expected number left falls by a
    constant factor. Counts are map-side combined, so a node with very many links is no
    hot spot.
    """
    nodes = links.select(F.col("a").alias("node")).union(links.select(F.col("b").alias("node"))).distinct()
    labels = written(nodes.withColumn("label", F.col("node")), "labels")
    edges = written(links.where("a <> b").distinct(), "edges")
    turn = 0
    while not edges.isEmpty():
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links_of = both.groupBy("a").agg(F.count("*").alias("n"))

        def rank(n, c):
            return F.struct((-F.col(n)).alias("n"), F.xxhash64(F.lit(turn), F.col(c)).alias("r"), F.col(c).alias("id"))

        ranked = both.join(links_of.select(F.col("a").alias("b"), "n"), "b").select("a", rank("n", "b").alias("to"))
        hooks = ranked.groupBy("a").agg(F.min("to").alias("to"), F.count("*").alias("n"))
        hooks = hooks.where(F.col("to") < rank("n", "a")).select("a", F.col("to.id").alias("to"))
        hooks = written(hooks, "hooks")
        old = [labels, edges, hooks]
        labels = written(
            labels.join(hooks, labels.label == hooks.a, "left").select("node", F.coalesce("to", "label").alias("label")),
            "labels",
        )
        left = hooks.select("a", F.col("to").alias("ta"))
        right = hooks.select(F.col("a").alias("b"), F.col("to").alias("tb"))
        moved = edges.join(left, "a", "left").join(right, "b", "left")
        moved = moved.select(F.coalesce("ta", "a").alias("a"), F.coalesce("tb", "b").alias("b")).where("a <> b")
        edges = written(moved.distinct(), "edges")
        drop_written(*old)
        turn += 1
    drop_written(edges)
    return labels
