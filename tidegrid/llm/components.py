"""Connected components of a graph given as a table of links, with written tables in between."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid import session


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): for each node of a link the smallest node it can reach.

    Each round every node takes the smallest label around it, then the label of that label,
    so paths shorten by halves. Sums of labels only fall; the rounds end when none changes.
    Aggregates combine before the shuffle, so a node of very many links is no hot group.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v")
    edges = session.written(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = session.written(edges.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("label")), "labels")
    while True:
        around = edges.join(labels.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("label").alias("near"))
        hop = labels.select(F.col("u").alias("label"), F.col("label").alias("far"))
        step = labels.join(around, "u").join(hop, "label", "left")
        new = step.select("u", F.least("label", "near", F.coalesce("far", "label")).alias("new"), F.col("label").alias("old"))
        # labels that their old holders leave take the smaller one along
        pulled = new.filter("new < old").groupBy(F.col("old").alias("u")).agg(F.min("new").alias("pull"))
        moved = session.written(
            new.join(pulled, "u", "left").select("u", F.least("new", F.coalesce("pull", "new")).alias("label"), (F.col("new") < F.col("old")).alias("changed")), "labels"
        )
        done = moved.filter("changed").isEmpty()
        session.discard(labels)
        labels = moved.drop("changed")
        labels._tidegrid_path = moved._tidegrid_path
        if done:
            session.discard(edges)
            return labels.select(F.col("u").alias("node"), F.col("label").alias("component"))
