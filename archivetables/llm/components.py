"""Connected components of a table of links, as a few joins for each contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivetables.llm.common import written


def components(links: DataFrame, label: str) -> DataFrame:
    """``node, component`` of every node of ``links`` (``a, b``: numbers): the smallest number reachable.

    Each round, every node joins the neighbour (or itself) of the smallest hash, that one's choice
    included, and links between what has been joined go on. Hashes differ by round, so the number of
    nodes falls by a constant factor whatever the shape: long paths take as few rounds as stars.
    """
    edges = written(_between(links), label)
    nodes = edges.select(F.col("a").alias("node")).unionAll(edges.select("b")).distinct()
    labels = written(nodes.withColumn("at", F.col("node")), label)
    round_ = 0
    while not edges.isEmpty():
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

        def ranked(name: str, round_: int = round_):
            return F.struct(F.xxhash64(F.lit(round_), name).alias("h"), F.col(name).alias("n"))

        best = both.groupBy("a").agg(F.min(ranked("b")).alias("_other"))
        choice = best.select(
            F.col("a").alias("from"), F.least(F.col("_other"), ranked("a"))["n"].alias("to")
        )
        choice = written(choice, label)
        second = choice.select(F.col("from").alias("to"), F.col("to").alias("_far"))
        step = choice.join(second, "to", "left")
        step = written(step.select("from", F.coalesce("_far", "to").alias("to")), label)
        for end in ("a", "b"):
            edges = edges.join(step.withColumnRenamed("from", end), end).drop(end)
            edges = edges.withColumnRenamed("to", end)
        edges = written(_between(edges), label)
        labels = labels.join(step.withColumnRenamed("from", "at"), "at", "left")
        labels = written(labels.select("node", F.coalesce("to", "at").alias("at")), label)
        round_ += 1
    least = labels.groupBy("at").agg(F.min("node").alias("component"))
    return written(labels.join(written(least, label), "at").select("node", "component"), label)


def _between(links: DataFrame) -> DataFrame:
    """Links of two nodes, once each."""
    return links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter(
        "a < b"
    ).distinct()
