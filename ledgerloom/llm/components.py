"""Connected components of a table of links, by smallest labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """vertex and component (the smallest vertex it reaches) for every vertex of ``links`` (a, b).

    Each round a vertex takes the smallest label among its own and its neighbours', then the label
    of that label, which doubles the distance that labels travel. It ends when nothing changes.
    Every round is written, so that a lost executor costs one round at most.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("vertex")).agg(F.min("b").alias("near")).select(
        "vertex", F.least("vertex", "near").alias("component")
    ), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["vertex"]).groupBy("a").agg(F.min("component").alias("near"))
        met = labels.join(near, labels["vertex"] == near["a"]).select(
            "vertex", F.col("component").alias("old"), F.least("component", "near").alias("met")
        )
        of = labels.select(F.col("vertex").alias("v"), F.col("component").alias("beyond"))
        jumped = met.join(of, F.col("met") == F.col("v")).select(
            "vertex", "old", F.least("met", "beyond").alias("component")
        )
        jumped = materialize(jumped, "labels")
        labels = jumped.select("vertex", "component")
        if jumped.where("old <> component").limit(1).count() == 0:
            return labels
