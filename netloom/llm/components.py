"""Connected components of a graph given as a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netloom.llm.common import discard, materialize


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every end of ``edges`` (columns a, b); a component is named by its smallest id.

    Each round takes the smallest label of the neighbours, for the node and for
    the node that is its label (the root is hooked), and then the label of that
    label, so chains shrink by a factor; rounds go on until no label moves.  Labels
    are written after each round and the ones before it removed.  All aggregations are minima, which shrink before the shuffle, so a node with
    very many edges is no burden.
    """
    both = edges.select("a", "b").where("a <> b")
    both = materialize(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("id"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.id).groupBy("a").agg(F.min("label").alias("near"))
        own = labels.join(near, labels.id == near.a)
        node = F.struct("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        root = F.struct(F.col("label").alias("id"), F.lit(None).cast(labels.schema["label"].dataType).alias("old"), F.least("label", "near").alias("label"))
        joined = own.select(F.inline(F.array(node, root))).groupBy("id").agg(F.max("old").alias("old"), F.min("label").alias("label"))
        target = labels.select(F.col("id").alias("via"), F.col("label").alias("beyond"))
        jumped = joined.join(target, joined.label == target.via, "left").select("id", "old", F.least("label", "beyond").alias("label"))
        step = materialize(jumped, "labels")
        discard(labels)
        labels = step.select("id", "label")
        if step.where("old <> label").isEmpty():
            discard(both)
            return labels.select("id", F.col("label").alias("component"))
