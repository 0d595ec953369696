"""Series operators: latest rows, carry-forward, lags, splits and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators.blocks import (
    BLOCK, across_blocks, attach, blocked, group, in_block, neighbours, positions)
from panelwright.operators.quality import require_history_limit
from panelwright.schema import LAG, TRAIN_SHARE
from panelwright.spec import CHILI, PanelSpec


def unique_panel(df: DataFrame, spec: PanelSpec = CHILI, order: str | None = None) -> DataFrame:
    """One row per natural key: the last by ``order``, else the highest value.

    Aggregates before the shuffle, so a natural key with very many copies stays cheap.
    """
    value = F.max_by(spec.value, order) if order else F.max(spec.value)
    return df.groupBy(*spec.natural_key).agg(value.alias(spec.value))


def series_keys(df: DataFrame, spec: PanelSpec = CHILI) -> DataFrame:
    return df.select(*spec.keys).distinct()


def last_observation(df: DataFrame, spec: PanelSpec = CHILI) -> DataFrame:
    """Last date and the value on it, per series."""
    return df.groupBy(*spec.keys).agg(
        F.max(spec.time).alias("last_time"), F.max_by(spec.value, spec.time).alias("last_value"))


def latest_n(df: DataFrame, n: int = LAG, spec: PanelSpec = CHILI) -> DataFrame:
    """The latest ``n`` rows of every series.

    Up to its threshold, Spark limits each series to ``n`` rows inside every input partition before the
    shuffle. For longer windows rows get their place in the series block by block, so no task holds a series.
    """
    if n > int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        placed = positions(df, spec)
        return tidy(placed.filter(F.col("pos") > F.col("n") - n)).drop("pos", "n")
    newest = Window.partitionBy(*spec.keys).orderBy(F.col(spec.time).desc())
    return df.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n).drop("_rank")


def latest_windows(df: DataFrame, n: int = LAG, spec: PanelSpec = CHILI) -> DataFrame:
    """One row per series: ``history``, its latest ``n`` (time, value) pairs, oldest first."""
    pair = F.struct(F.col(spec.time).alias("time"), F.col(spec.value).alias("value"))
    return latest_n(df, n, spec).groupBy(*spec.keys).agg(F.sort_array(F.collect_list(pair)).alias("history"))


def carry_forward(windows: DataFrame, as_of: Column, n: int = LAG, max_gap: int = 7) -> DataFrame:
    """Last observation carried forward to ``as_of``, day by day, if the gap is 1 to ``max_gap`` days."""
    last = F.element_at("history", -1)
    gap = F.datediff(as_of, last["time"])
    copies = F.transform(
        F.sequence(F.lit(1), gap),
        lambda i: F.struct(F.date_add(last["time"], i).alias("time"), last["value"].alias("value")))
    filled = F.when(gap.between(1, max_gap), F.concat("history", copies)).otherwise(F.col("history"))
    kept = F.slice("_filled", F.greatest(F.size("_filled") - F.lit(n - 1), F.lit(1)), F.lit(n))
    return windows.withColumn("_filled", filled).withColumn("history", kept).drop("_filled")


def window_rows(windows: DataFrame, spec: PanelSpec = CHILI) -> DataFrame:
    """The rows of ``history`` again."""
    others = [c for c in windows.columns if c != "history"]
    return windows.select(*others, F.explode("history").alias("_pair")).select(
        *others, F.col("_pair.time").alias(spec.time), F.col("_pair.value").alias(spec.value))


def price_history(df: DataFrame, spec: PanelSpec = CHILI, limit: int = 10,
                  case_insensitive: bool = False, **filters: str | None) -> DataFrame:
    """Newest rows first, 1 to 100 of them, with optional equality filters on key columns; an empty filter is no filter."""
    require_history_limit(limit)
    for column, value in filters.items():
        if value:
            df = df.filter(S.same_text(F.col(column), value, case_insensitive))
    return df.orderBy(F.col(spec.time).desc(), *spec.keys).limit(limit)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("jumlah_data"))


def temporal_split(df: DataFrame, spec: PanelSpec = CHILI, share: float = TRAIN_SHARE) -> DataFrame:
    """Adds ``split``: the first ``floor(n * share)`` rows of a series are 'train', the others 'test'."""
    rows = df if "pos" in df.columns else positions(df, spec)
    train = F.col("pos") <= F.floor(F.col("n") * F.lit(float(share)))
    return rows.withColumn("split", F.when(train, "train").otherwise("test"))


def supervised(df: DataFrame, n_in: int = LAG, n_out: int = 1, spec: PanelSpec = CHILI,
               columns: Sequence[str] | None = None, drop_incomplete: bool = True) -> DataFrame:
    """Adds ``lag_n_in .. lag_1``, ``y`` and ``lead_1 ..``: a shift by rows, not by days.

    With several ``columns`` the names are prefixed by the column. A block borrows the rows it lacks
    from the tails and heads of its neighbour blocks; no block is empty, so ``n_in`` of them suffice.
    """
    columns = list(columns or [spec.value])
    ahead = n_out - 1
    size = F.count("*").over(Window.partitionBy(*group(spec)))
    rows = (blocked(df, spec)
            .withColumn("_rank", F.row_number().over(in_block(spec)))
            .withColumn("_left", size - F.col("_rank") + 1))
    pair = F.struct(F.col(spec.time).alias("_time"), *columns)
    summary = rows.groupBy(*group(spec)).agg(
        F.sort_array(F.collect_list(F.when(F.col("_left") <= n_in, pair)), False).alias("_tail"),
        F.sort_array(F.collect_list(F.when(F.col("_rank") <= ahead, pair))).alias("_head"))
    before = across_blocks(spec, newest_first=True).rowsBetween(1, max(n_in, 1))
    after = across_blocks(spec).rowsBetween(1, max(ahead, 1))
    carry = summary.select(
        *group(spec),
        F.slice(F.flatten(F.collect_list("_tail").over(before)), 1, max(n_in, 1)).alias("_past"),
        F.slice(F.flatten(F.collect_list("_head").over(after)), 1, max(ahead, 1)).alias("_future"))
    carry = carry.filter((F.size("_past") > 0) | (F.size("_future") > 0))
    # Only the first and last rows of a block look outside it; the others need not carry the arrays.
    rows = (attach(rows, carry, spec, "left")
            .withColumn("_past", F.when(F.col("_rank") <= n_in, F.col("_past")))
            .withColumn("_future", F.when(F.col("_left") <= ahead, F.col("_future"))))

    made: dict[str, Column] = {}
    for column in columns:
        prefix = f"{column}_" if len(columns) > 1 else ""
        for i in range(n_in, 0, -1):
            inside = F.lag(column, i).over(in_block(spec))
            outside = F.get("_past", F.lit(i) - F.col("_rank"))[column]
            made[f"{prefix}lag_{i}"] = F.when(F.col("_rank") > i, inside).otherwise(outside)
        made[f"{prefix}y"] = F.col(column)
        for i in range(1, n_out):
            inside = F.lead(column, i).over(in_block(spec))
            outside = F.get("_future", (F.lit(i) - F.col("_left")).cast("int"))[column]
            made[f"{prefix}lead_{i}"] = F.when(F.col("_left") > i, inside).otherwise(outside)
    out = rows.withColumns(made).drop("_rank", "_left", "_past", "_future")
    return out.dropna(how="any", subset=list(made)) if drop_incomplete else out


def with_neighbours(df: DataFrame, spec: PanelSpec, part: str | None = None,
                    extra: tuple[str, ...] = ()) -> DataFrame:
    """Adds the known points around a row; points in another ``part`` of the series do not count."""
    rows = df if "pos" in df.columns else positions(df, spec)
    names = ["pos", *extra, *([part] if part else [])]
    load = F.struct(*names, F.col(spec.value).cast("double").alias("value"))
    rows = neighbours(rows, spec, F.when(F.col(spec.value).isNotNull(), load))
    if part:
        for side in ("_prev", "_next"):
            rows = rows.withColumn(side, F.when(F.col(side)[part] == F.col(part), F.col(side)))
    return rows


def linear_value() -> Column:
    """Value on the line through the known points around a row, by row position."""
    before, after = F.col("_prev"), F.col("_next")
    share = (F.col("pos") - before["pos"]) / (after["pos"] - before["pos"])
    return before["value"] + (after["value"] - before["value"]) * share


def fill_linear(df: DataFrame, spec: PanelSpec = CHILI, part: str | None = None,
                step: int | None = None) -> DataFrame:
    """Fills gaps of ``value``: linear inside, nearest known value at the edges, null if none is known.

    ``part`` keeps the parts of a temporal split apart; ``step`` rounds the result.
    """
    rows = with_neighbours(df, spec, part)
    value = F.coalesce(F.col(spec.value).cast("double"), linear_value(), F.col("_prev")["value"],
                       F.col("_next")["value"])
    if step:
        value = S.round_to(value, step)
    return rows.withColumn(spec.value, value).drop("_prev", "_next")


def tidy(df: DataFrame) -> DataFrame:
    """Drops the working column of the blocked operators."""
    return df.drop(BLOCK)
