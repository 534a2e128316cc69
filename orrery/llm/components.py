"""Connected components of a table of links, by least-neighbour labels and pointer jumping.

Each round a node takes the least label among its own and its neighbours', then the label of that label; rounds stop
when nothing changes. Every round is a pair of joins over written tables, so a hub's links are split by adaptive
execution, partial minima are taken before the shuffle, and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import discard, materialise


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label): label is the least node of the component. Links of nulls or to oneself are ignored."""
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    both = materialise(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "cc-links")
    labels = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "cc-labels")
    while True:
        now = labels.select("node", "label")
        near = both.join(now, both.v == now.node).groupBy("u").agg(F.min("label").alias("near"))
        low = now.join(near, now.node == near.u, "left").select("node", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label"))
        low = materialise(low, "cc-low")
        of = low.select(F.col("node").alias("n"), F.col("label").alias("further"))
        jumped = low.join(of, low.label == of.n, "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label"))
        after = materialise(jumped, "cc-labels")
        discard(low, labels)
        labels = after
        if labels.filter("label <> old").isEmpty():
            discard(both)
            return labels.select("node", "label")
