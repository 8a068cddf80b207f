"""Connected components of links, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpus_engine.llm.common import settled


def components(links: DataFrame) -> DataFrame:
    """``v`` and ``label``, the smallest vertex reachable, for every vertex of ``links`` (``a``, ``b``).

    Each round takes the smallest label among the neighbours and then the label's own label, so the distance a label
    travels doubles; nothing but narrow rows is shuffled, and a round's labels are written before the next. A vertex with
    very many links is reduced in the tasks before the shuffle."""
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    both = settled(both.distinct(), "component-links")
    labels = both.groupBy("v").agg(F.least(F.min("u"), F.first("v")).alias("label"))
    labels = settled(labels, "component-labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("u"), "label"), "u").groupBy("v").agg(F.min("label").alias("near"))
        lower = labels.join(near, "v").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        lower = settled(lower, "component-near")
        jump = lower.select(F.col("v").alias("label"), F.col("label").alias("next"))
        after = settled(lower.join(jump, "label").select("v", "old", F.col("next").alias("label")), "component-labels")
        labels = after.select("v", "label")
        if after.where("old <> label").isEmpty():
            return labels
