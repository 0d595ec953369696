"""Connected components of a link table, by rounds of joins; no links reach the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.session import store


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id it is linked with, over any way.

    Alternating star rounds: every node's larger neighbours, then its smaller ones, are hung on the smallest
    node around. The number of rounds grows with the logarithm of the longest chain, and each round's links
    are stored, so a lost executor costs one round at most. Nulls link nothing; an empty table gives none.
    """
    edges = store(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.union(low.where("low < a").select("a", F.col("low").alias("b"))).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).where("a <> b")
        new = store(small.union(low.select("a", F.col("low").alias("b"))).distinct(), "links")
        # Done when every node hangs on one that hangs on nothing.
        roots = new.select(F.col("b").alias("a")).distinct()
        if new.join(roots, "a", "left_semi").isEmpty() and new.groupBy("a").count().where("count > 1").isEmpty():
            return new.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
                new.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
        edges = new
