"""Connected components of an edge table, by contraction.

Each round points every node at its smallest neighbour if that is smaller,
follows the pointers to their roots, and relabels the edges by roots; edges
inside a component vanish.  All rounds run on Spark tables written to the
shared folder; the driver only learns how many edges are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiresight.llm.common import stage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long), root: the smallest node of its component."""
    edges = stage(edges.select("a", "b").where("a <> b").distinct(), "edges")
    labels = None
    while edges.limit(1).count():
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = stage(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                       .select("node", F.least("node", "m").alias("root")), "parents")
        while True:  # pointer jumping: the depth halves each time
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("top"))
            jumped = stage(parent.join(up, "root").select("node", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")), "jumped")
            parent = jumped.select("node", "root")
            if not jumped.where("moved").limit(1).count():
                break
        if labels is None:
            labels = parent
        else:
            up = parent.select(F.col("node").alias("root"), F.col("root").alias("top"))
            labels = stage(labels.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "labels")
        a = parent.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        b = parent.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = stage(edges.join(a, "a").join(b, "b").where("ra <> rb").select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct(), "edges")
    return labels if labels is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
