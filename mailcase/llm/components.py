"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailcase.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in (u, v) links; label: smallest node of its component.

    Each round takes the smallest label among a node's neighbours (combined
    before the shuffle) and then the label of that label, which halves the
    distance to the smallest node; rounds end when no label changes. Labels
    are written between rounds; only a count reaches the driver.
    """
    both = stored(links.select("u", "v").union(links.select("v", "u")).distinct(), "links")
    labels = stored(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
                    .select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(
            F.min("label").alias("m"))
        step = labels.join(near, labels["node"] == near["u"]).select(
            "node", "label", F.least("label", "m").alias("new"))
        up = step.select(F.col("node").alias("_n"), F.col("new").alias("_up"))
        jump = F.least("new", F.coalesce("_up", "new"))
        jumped = stored(step.join(up, step["new"] == up["_n"], "left").select(
            step["node"], jump.alias("label"), (F.col("label") != jump).alias("changed")), "labels")
        if jumped.where("changed").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
