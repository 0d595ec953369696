"""Scans of stored tables, the shop list, simulated prices and the emptiness gate."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators.joins import dims_by_days, last_days
from panelwright.operators.quality import first_reason, require_columns
from panelwright.schema import DEFAULT_PRICE_RANGE, PRICE_RANGES, SHOP_FILE_COLUMNS, SHOP_SCHEMA
from panelwright.spec import CHILI, PanelSpec


def scan_panel(spark: SparkSession, path: str, spec: PanelSpec = CHILI) -> DataFrame:
    return spark.read.parquet(path).select(*spec.columns)


def clean_shops(raw: DataFrame) -> DataFrame:
    """Shop rows as stored, with a ``reason`` where the price is unreadable."""
    raw = raw.toDF(*[c.strip() for c in raw.columns])
    require_columns(raw, SHOP_FILE_COLUMNS)
    numbers = {
        "harga": S.clean_shop_price(F.col("harga")).try_cast("int"),
        "rating": S.clean_rating(F.col("rating")).cast("float"),
    }
    texts = {c: S.blank_if_null(F.col(c)) for c in SHOP_FILE_COLUMNS if c not in numbers}
    shops = raw.select(*SHOP_FILE_COLUMNS).withColumns({**texts, **numbers})
    shops = shops.withColumnRenamed("gambar_produk", "gambar_toko").select(*SHOP_SCHEMA.fieldNames())
    return shops.withColumn("reason", first_reason(("unreadable price", F.col("harga").isNotNull())))


def shop_listing(shops: DataFrame) -> DataFrame:
    """The shop list as it is served."""
    names = [c for c in SHOP_SCHEMA.fieldNames() if c != "gambar_toko"]
    return shops.select(*names, F.col("gambar_toko").alias("gambar_produk"))


def is_empty(df: DataFrame) -> DataFrame:
    """One row (is_empty); at most one row of the input is read."""
    return df.limit(1).agg((F.count("*") == 0).alias("is_empty"))


def seed_if_empty(df: DataFrame, seed: Callable[[], DataFrame]) -> DataFrame:
    return seed() if df.isEmpty() else df


def price_range(item: Column, ranges: dict[str, tuple[int, int]] = PRICE_RANGES,
                default: tuple[int, int] = DEFAULT_PRICE_RANGE) -> tuple[Column, Column]:
    low, high = F.lit(default[0]), F.lit(default[1])
    for name, (least, most) in ranges.items():
        low = F.when(item == name, least).otherwise(low)
        high = F.when(item == name, most).otherwise(high)
    return low, high


def simulated_panel(provinces: DataFrame, items: DataFrame | Column, as_of: Column, days: int = 3, seed: int = 42,
                    spec: PanelSpec = CHILI, ranges: dict[str, tuple[int, int]] = PRICE_RANGES) -> DataFrame:
    """Prices for the last days of every province and item, uniform in the item's range, marked as simulated.

    The price is drawn from a hash of seed, day and keys, so a rerun of a lost task draws the same one.
    """
    grid = dims_by_days(provinces, items, last_days(as_of, days), spec)
    low, high = price_range(F.col(spec.keys[-1]), ranges)
    ticket = F.concat_ws("|", F.lit(str(seed)), S.iso_date(F.col(spec.time)), *spec.keys)
    draw = F.conv(F.substr(F.md5(ticket), F.lit(1), F.lit(8)), 16, 10).cast("bigint")
    price = (low + draw % (high - low + 1)).cast("bigint")
    return grid.withColumn(spec.value, price).withColumn("is_synthetic", F.lit(True))
