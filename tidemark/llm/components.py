"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every end of a link (columns a, b; longs): the label is the least node that links reach.

    Each round takes the least label among the neighbours and then the label of the label, so a chain is halved per round.
    Minima are taken in each task before the shuffle. Links and labels stay in tables; the driver sees only counts.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("next")).unionByName(
        links.select(F.col("b").alias("node"), F.col("a").alias("next"))
    )
    both = stored(both.distinct(), "links")
    labels = stored(both.groupBy("node").agg(F.least(F.min("next"), F.col("node")).alias("label")), "labels")
    while True:
        near = both.join(labels, "node").groupBy(F.col("next").alias("node")).agg(F.min("label").alias("near"))
        least = stored(
            labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "near").alias("label")), "least"
        )
        roots = least.select(F.col("node").alias("label"), F.col("label").alias("root"))
        moved = stored(least.join(roots, "label").select("node", "was", F.col("root").alias("label")), "labels")
        labels = moved.select("node", "label")
        if not moved.filter("label <> was").limit(1).count():
            return labels
