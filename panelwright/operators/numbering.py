"""Consecutive numbers over a whole table without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwright.session import cut_lineage


def numbered(df: DataFrame, by: list, out: str) -> DataFrame:
    """Adds ``out``: 1 for the first row in the order of ``by``, 2 for the next, and so on.

    Rows are dealt to partitions by ranges, sorted there and numbered; a partition's numbers start behind the sum of
    the row counts of those before it. Only these counts, one per partition, meet in one place. ``by``
    should be unique, else equal rows are numbered in any order.
    """
    rows = df.repartitionByRange(*by).sortWithinPartitions(*by)
    # Bounds of ranges are sampled, so the rows are fixed before they are counted.
    rows = cut_lineage(rows.withColumn("_range", F.spark_partition_id()).withColumn(
        "_place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) + 1))
    counts = rows.groupBy("_range").agg(F.count("*").alias("_rows"))
    upto = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_range", F.coalesce(F.sum("_rows").over(upto), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(starts), "_range").withColumn(out, F.col("_before") + F.col("_place")).drop(
        "_range", "_place", "_before", "_rows")
