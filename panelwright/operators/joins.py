"""Joins of the panel with dimensions, days, substitutes, windows and forecasts.

No side is forced into memory: Spark broadcasts a side when its measured size is below
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both, splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators.quality import MIN_HISTORY_ROWS, first_reason
from panelwright.spec import CHILI, PanelSpec


def canonical_names(df: DataFrame, names: DataFrame, raw: str, out: str, column: str = "name",
                    how: str = "inner") -> DataFrame:
    """Adds ``out``, the official name whose normalised form equals that of ``raw``; unknown rows drop."""
    official = (names.select(S.normalize_name(F.col(column)).alias("_norm"), F.col(column).alias(out)))
    return df.withColumn("_norm", S.normalize_name(F.col(raw))).join(official, "_norm", how).drop("_norm")


def dims_by_days(provinces: DataFrame, items: DataFrame | Column, days: Column, spec: PanelSpec = CHILI) -> DataFrame:
    """Every province with every item on every day; ``days`` is an array, ``items`` a dimension or, for a few, an array.

    The result has as many rows by definition; no task holds a whole dimension.
    """
    province, item = spec.keys
    grid = provinces.select(province)
    if isinstance(items, DataFrame):
        grid = grid.crossJoin(items.select(item))
    else:
        grid = grid.withColumn(item, F.explode(items))
    return grid.withColumn(spec.time, F.explode(days))


def last_days(as_of: Column, days: int = 3) -> Column:
    """The ``days`` days that end with ``as_of``, as an array."""
    return F.sequence(F.date_sub(as_of, days - 1), as_of)


def requests_with_history(requests: DataFrame, windows: DataFrame, spec: PanelSpec = CHILI,
                          rows: int = MIN_HISTORY_ROWS) -> DataFrame:
    """Requests with their ``history``; ``reason`` is set where a series is too short or absent."""
    joined = requests.join(windows, list(spec.keys), "left")
    enough = F.size("history") >= rows
    reason = first_reason(("insufficient data", enough))
    if "reason" in requests.columns:
        reason = F.coalesce("reason", reason)
    return joined.withColumn("reason", reason)


def with_actual(forecast: DataFrame, panel: DataFrame, spec: PanelSpec = CHILI) -> DataFrame:
    """Forecast rows with ``aktual``, the observed value of the day, null while unknown."""
    actual = panel.select(*spec.natural_key, F.col(spec.value).alias("aktual"))
    return forecast.join(actual, spec.natural_key, "left")


def fill_from_substitute(df: DataFrame, pairs: DataFrame, spec: PanelSpec = CHILI,
                         item: str | None = None) -> DataFrame:
    """Adds ``filled``: the value, or the value of the item's substitute on the same day."""
    item = item or spec.keys[-1]
    others = [c for c in spec.natural_key if c != item]
    paired = df.join(pairs.select(F.col("item").alias(item), F.col("substitute").alias("_sub")), item, "left")
    other = df.select(*others, F.col(item).alias("_sub"), F.col(spec.value).alias("_other"))
    return (paired.join(other, [*others, "_sub"], "left")
            .withColumn("filled", F.coalesce(spec.value, "_other"))
            .drop("_sub", "_other"))
