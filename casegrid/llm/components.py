"""Connected components of an edge table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casegrid.llm.groups import SplitJoin
from casegrid.operators.storage import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all ends of the (a, b) edges: the least node that can be reached.

    Each round takes the least label among a node's neighbours and then the label of that label, so that
    labels travel twice as far in every round. Rounds are written to the shared folder; only whether
    anything has changed comes to the driver. A node with very many edges is dealt to several tasks.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct()
    both = stored(both)
    split = SplitJoin(stored(both.groupBy("b").agg(F.count("*").alias("n"))), "b")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "node"))
    dealt = both if split.large is None else stored(split.dealt(both))
    while True:
        beside = split.join(dealt, labels.withColumnRenamed("node", "b")).groupBy("a").agg(F.min("label").alias("near"))
        nearer = labels.join(beside, labels["node"] == beside["a"]).select(
            "node", "label", F.least("label", "near").alias("next")
        )
        roots = labels.select(F.col("node").alias("root"), F.col("label").alias("of_root"))
        moved = stored(
            nearer.join(roots, nearer["next"] == roots["root"], "left").select(
                "node", F.least("next", "of_root").alias("next"), "label"
            )
        )
        changed = moved.filter("next <> label").limit(1).count()
        labels = moved.select("node", F.col("next").alias("label"))
        if not changed:
            return labels.withColumnRenamed("label", "component")
