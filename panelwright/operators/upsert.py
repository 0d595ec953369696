"""Keyed change-only upsert of a batch into a price table.

A batch has a sequence column: later records see earlier ones, so the last record of a key wins and
every change of value on the way counts as one update. Records that lack part of their natural key
can't be matched with anything; they are rejects and neither merged nor counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.operators.series import supervised
from panelwright.spec import CHILI, PanelSpec

INSERTED, UPDATED = "_inserted", "_updated"


def has_key(spec: PanelSpec = CHILI) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in spec.natural_key])


def keyless(batch: DataFrame, spec: PanelSpec = CHILI) -> DataFrame:
    """The records of a batch that have no whole natural key, with ``reason``."""
    return batch.filter(~has_key(spec)).withColumn("reason", F.lit("empty key"))


def merge_counted(target: DataFrame, batch: DataFrame, spec: PanelSpec = CHILI, order: str = "seq") -> DataFrame:
    """The table after the batch, and per row ``_inserted`` (0 or 1) and ``_updated``: changes by this batch.

    ``order`` is an integer that is unique within a natural key. A key repeated very often is compared in
    blocks of its sequence; the table meets one row per key of the batch.
    """
    events = PanelSpec(tuple(spec.natural_key), order, spec.value)
    steps = supervised(batch.filter(has_key(spec)).select(*spec.columns, order), 1, 1, events, drop_incomplete=False)
    change = ~F.col(spec.value).eqNullSafe(F.col("lag_1"))
    per_key = steps.groupBy(*spec.natural_key).agg(
        F.count_if(change).alias("_changes"),
        F.min_by(change, order).alias("_first_counted"),
        F.min_by(F.struct(spec.value), order).alias("_first"),
        F.max_by(F.struct(spec.value), order).alias("_new"))
    stored = target.select(*spec.natural_key, F.struct(spec.value).alias("_stored"))
    joined = stored.join(per_key, spec.natural_key, "full_outer")
    hit, known = F.col("_new").isNotNull(), F.col("_stored").isNotNull()
    later = F.col("_changes") - F.col("_first_counted").cast("bigint")
    first = (~F.col("_first")[spec.value].eqNullSafe(F.col("_stored")[spec.value])).cast("bigint")
    updated = F.when(hit, later + F.when(known, first).otherwise(F.lit(0))).otherwise(F.lit(0))
    value = F.when(hit, F.col("_new")[spec.value]).otherwise(F.col("_stored")[spec.value])
    return joined.select(*spec.natural_key, value.alias(spec.value),
                         (hit & ~known).cast("int").alias(INSERTED), updated.cast("bigint").alias(UPDATED))


def merge_batch(target: DataFrame, batch: DataFrame, spec: PanelSpec = CHILI, order: str = "seq") -> DataFrame:
    """The table after the batch: new keys added, changed values replaced, all else as it was."""
    return merge_counted(target, batch, spec, order).drop(INSERTED, UPDATED)


def change_counts(target: DataFrame, batch: DataFrame, spec: PanelSpec = CHILI, order: str = "seq") -> DataFrame:
    """One row (inserted, updated)."""
    return totals(merge_counted(target, batch, spec, order))


def totals(merged: DataFrame) -> DataFrame:
    return merged.agg(F.coalesce(F.sum(INSERTED), F.lit(0)).cast("bigint").alias("inserted"),
                      F.coalesce(F.sum(UPDATED), F.lit(0)).cast("bigint").alias("updated"))
