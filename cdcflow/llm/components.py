"""Connected components of a set of links, as joins and sums that Spark spreads out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(links: DataFrame) -> DataFrame:
    """``node, label`` of every node of ``links`` (``a, b``): the smallest node that links reach.

    Each round a node takes the smallest label among its neighbours, then its label's label, until nothing changes; so
    long chains halve and stars take two rounds. No node's neighbours are gathered in one place. Nulls, loops and
    repeated links change nothing. No links give no rows.
    """
    links = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = stored(links.union(links.select("b", "a")).distinct(), "links")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")),
        "labels",
    )
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("label").alias("m"))
        )
        taken = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("label"), F.col("label").alias("further"))
        new = stored(
            taken.join(jump, "label", "left").select("node", "old", F.least("label", F.coalesce("further", "label")).alias("label")),
            "labels",
        )
        if new.filter("label <> old").isEmpty():
            return new.select("node", "label")
        labels = new.select("node", "label")
