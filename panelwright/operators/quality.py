"""Validation. Rejects are kept with a reason instead of being lost or stopping the load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.schema import LAG
from panelwright.spec import CHILI, PanelSpec

# Shortest usable series of the trainer, the file loader, the split and the forecast.
MIN_TRAIN_ROWS = LAG + 10
MIN_FILE_ROWS = LAG + 20
MIN_SPLIT_TRAIN_ROWS = LAG + 5
MIN_SPLIT_TEST_ROWS = 2
MIN_HISTORY_ROWS = LAG
# Longest horizon of a posted request and highest limit of a history request.
MAX_HORIZON = 30
MAX_HISTORY_LIMIT = 100


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def require_history_limit(limit: int) -> int:
    if not 1 <= limit <= MAX_HISTORY_LIMIT:
        raise ValueError(f"limit must be 1 to {MAX_HISTORY_LIMIT}")
    return limit


def first_reason(*checks: tuple[str, Column]) -> Column:
    """Name of the first failed check, null if all hold; an unknown outcome counts as failed."""
    reasons = [F.when(~F.coalesce(holds, F.lit(False)), F.lit(name)) for name, holds in checks]
    return F.coalesce(*reasons) if reasons else F.lit(None).cast("string")


def passed(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNull()).drop("reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col("reason").isNotNull())


def count_reasons(df: DataFrame) -> DataFrame:
    """Rows per outcome; rows without a reason count as 'ok'."""
    return df.groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(F.count("*").alias("n_rows"))


def check_records(df: DataFrame, spec: PanelSpec = CHILI, raw: str = "harga_raw") -> DataFrame:
    """Scraped records: cleans the price text ``raw`` into ``value`` and adds ``reason``."""
    value = S.clean_price_string(F.col(raw))
    checks = []
    for name in [spec.time, *spec.keys]:
        filled = F.col(name).isNotNull()
        if dict(df.dtypes)[name] == "string":
            filled = filled & (F.col(name) != "")
        checks.append((f"empty {name}", filled))
    checks.append(("unreadable price", F.col(spec.value).isNotNull()))
    checks.append(("price not positive", F.col(spec.value) > 0))
    return df.withColumn(spec.value, value).withColumn("reason", first_reason(*checks))


def check_members(df: DataFrame, dims: dict[str, DataFrame], column: str = "name") -> DataFrame:
    """Adds ``reason`` for rows whose value in a key column is not in that key's dimension frame."""
    checks = []
    for key, dim in dims.items():
        flag = f"_known_{key}"
        known = dim.select(F.col(column).alias(key)).distinct().withColumn(flag, F.lit(True))
        df = df.join(known, key, "left")
        checks.append((f"unknown {key}", F.col(flag)))
    return df.withColumn("reason", first_reason(*checks)).drop(*[f"_known_{key}" for key in dims])


def check_requests(df: DataFrame, dims: dict[str, DataFrame], horizon: str = "durasi",
                   bounded: bool = True, column: str = "name") -> DataFrame:
    """Forecast requests: known keys and, if ``bounded``, a horizon of 1 to 30 days."""
    df = check_members(df, dims, column)
    if not bounded:
        return df
    within = F.col(horizon).between(1, MAX_HORIZON)
    return df.withColumn("reason", F.coalesce("reason", first_reason(("horizon out of range", within))))


def long_enough(df: DataFrame, rows: int, spec: PanelSpec = CHILI) -> DataFrame:
    """Only series of at least ``rows`` rows. Lengths are counted before the shuffle."""
    lengths = df.groupBy(*spec.keys).agg(F.count("*").alias("_n")).filter(F.col("_n") >= rows)
    return df.join(lengths.select(*spec.keys), list(spec.keys), "left_semi")


def split_long_enough(df: DataFrame, spec: PanelSpec = CHILI, train: int = MIN_SPLIT_TRAIN_ROWS,
                      test: int = MIN_SPLIT_TEST_ROWS) -> DataFrame:
    """Only series whose train and test parts both have enough rows."""
    lengths = df.groupBy(*spec.keys).agg(
        F.count_if(F.col("split") == "train").alias("_train"),
        F.count_if(F.col("split") == "test").alias("_test"))
    enough = lengths.filter((F.col("_train") >= train) & (F.col("_test") >= test))
    return df.join(enough.select(*spec.keys), list(spec.keys), "left_semi")


def with_date(df: DataFrame, spec: PanelSpec = CHILI) -> DataFrame:
    return df.filter(F.col(spec.time).isNotNull())
