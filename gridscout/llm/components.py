"""Connected components of a graph given as a table of edges, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscout.llm.common import drop_stage, stage


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(id, comp) for every id in `links` (a, b) or in the earlier `labels`: comp is the smallest id
    of its component. A staged table.

    A round turns every link into one between components, lets each component follow its smallest
    neighbour, and shortens the chains that come of it by doubling. It leaves at most half of the
    components that still have neighbours. Repeated links and links of an id with itself do nothing;
    without links the labels stay as they are.
    """
    nodes = links.select(F.col("a").alias("id")).union(links.select("b")).distinct()
    if labels is None:
        labels = stage(nodes.select("id", F.col("id").alias("comp")))
    else:
        labels = stage(nodes.join(labels, "id", "left_anti").select("id", F.col("id").alias("comp")).unionByName(labels))
    while True:
        a, b = (labels.select(F.col("id").alias(x), F.col("comp").alias(f"c{x}")) for x in "ab")
        crossing = links.join(a, "a").join(b, "b").where("ca <> cb").select("ca", "cb")
        crossing = stage(crossing.select(F.greatest("ca", "cb").alias("u"), F.least("ca", "cb").alias("v")).distinct())
        if crossing.isEmpty():
            drop_stage(crossing)
            return labels
        parents = _flat(stage(crossing.groupBy("u").agg(F.min("v").alias("v"))))
        old = labels
        labels = stage(old.join(parents, old.comp == parents.u, "left").select("id", F.coalesce("v", "comp").alias("comp")))
        drop_stage(crossing, parents, old)


def _flat(parents: DataFrame) -> DataFrame:
    """(u, v) with v the root that u leads to."""
    while True:
        up = parents.select(F.col("u").alias("v"), F.col("v").alias("w"))
        nearer = stage(parents.join(up, "v", "left").select("u", F.coalesce("w", "v").alias("v"), F.col("w").isNotNull().alias("moved")))
        drop_stage(parents)
        if nearer.where("moved").isEmpty():
            return nearer.drop("moved")
        parents = nearer.drop("moved")
