"""Connected components by label propagation with pointer jumping, all in joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from playstats.session import cut_lineage, remove_stage


def components(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(k, label): the smallest ``label`` reachable from each node that has a link.

    ``links`` has columns a and b; ``nodes`` has k and a ``label``, a struct
    that is unique, ordered, and holds k. Every round takes the smallest
    label of a node's neighbours, then that label's own label; the tables are
    as large as the links, and nothing is gathered by node.
    """
    both = cut_lineage(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "component-links")
    linked = both.select(F.col("a").alias("k")).distinct()
    labels = cut_lineage(nodes.join(linked, "k").select("k", "label"), "component-labels")
    while True:
        near = both.join(labels.select(F.col("k").alias("b"), "label"), "b").groupBy(F.col("a").alias("k")).agg(F.min("label").alias("near"))
        stepped = labels.join(near, "k").select("k", "label", F.least("label", "near").alias("new"))
        stepped = cut_lineage(stepped, "component-step")
        # jump: the label of the node that the label names
        named = stepped.select(F.col("k").alias("at"), F.col("new").alias("far"))
        jumped = stepped.join(named, F.col("new.k") == F.col("at"), "left")
        before, jumped = labels, cut_lineage(jumped.select("k", F.least("new", F.coalesce("far", "new")).alias("label"), (F.col("label") != F.col("new")).alias("moved")), "component-labels")
        remove_stage(before, stepped)
        labels = jumped
        if jumped.where("moved").isEmpty():
            remove_stage(both)
            return labels.select("k", "label")
