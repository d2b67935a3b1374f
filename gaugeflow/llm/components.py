"""Connected components of a graph of links, by spreading the smallest label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow import session


def components(links: DataFrame) -> DataFrame:
    """(v, c) for every end of the links (a, b): c is the smallest end in reach.

    In each round a vertex takes the smallest label around it and then the label of that
    label, so long chains shrink by half. Every round is written to the shared folder.
    """
    both = links.select(F.col("a").alias("v"), F.col("b").alias("to")).unionByName(
        links.select(F.col("b").alias("v"), F.col("a").alias("to"))
    )
    edges = session.stage(both.where("v <> to").distinct(), "edges")
    labels = session.stage(
        edges.groupBy("v").agg(F.least(F.col("v"), F.min("to")).alias("c"), F.lit(True).alias("changed")), "labels"
    )
    while True:
        around = edges.join(labels.select(F.col("v").alias("to"), F.col("c").alias("n")), "to").groupBy("v").agg(
            F.min("n").alias("n")
        )
        nearer = labels.join(around, "v").select("v", F.col("c").alias("old"), F.least("c", "n").alias("c"))
        nearer = session.stage(nearer, "nearer")
        jump = nearer.select(F.col("v").alias("c"), F.col("c").alias("j"))
        moved = nearer.join(jump, "c", "left").select(
            "v", F.least("c", F.coalesce("j", "c")).alias("c"), (F.least("c", F.coalesce("j", "c")) < F.col("old")).alias("changed")
        )
        labels = session.stage(moved, "labels")
        if labels.where("changed").isEmpty():
            return labels.select("v", "c")
