"""Price panels derived from the order and event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators.series import unique_panel
from panelwright.session import store
from panelwright.spec import PanelSpec

ORDERS = PanelSpec(("region", "priority"), "day", "price")
EVENTS = PanelSpec(("event_type",), "ts", "value")


# The columns of the driver's tables; stated, so that no job has to read file footers first.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their region; both tables have one row per country or continent."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", F.col("r_name").alias("region"))


def order_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean order price per region, priority and day, formed from whole cents so that it is exact."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = nations(spark, sf_dir)
    home = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select("c_custkey", "region")
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey", F.col("o_orderpriority").alias("priority"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.bround(F.col("o_totalprice") * 100, 0).cast("bigint").alias("cents"))
    mean = F.sum("cents") / (F.lit(100.0) * F.count("*"))
    return (orders.join(home, orders.o_custkey == home.c_custkey)
            .groupBy("region", "priority", "day")
            .agg(F.bround(mean, 0).cast("bigint").alias("price")))


def stored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order panel as a table, for operators that read it more than once: one join of the orders."""
    return store(order_panel(spark, sf_dir), "order_panel")


def gappy_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored order panel with the price of every fourth day of a month unknown."""
    return stored_panel(spark, sf_dir).withColumn("price", F.when(F.day("day") % 4 != 0, F.col("price")))


def event_panel(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, PanelSpec]:
    """Raw events, one series per event type, and their spec with a block width that fits them.

    A handful of types share all events, so each series is a large part of the table.
    """
    events = table(spark, sf_dir, "events")
    panel = store(unique_panel(events, EVENTS, order="event_id"), "event_panel")
    return panel, EVENTS.fitted(panel)


def priorities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("name")).distinct()


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(F.col("r_name").alias("name"))


def perturbed(panel: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A first load and a later batch of the order panel: new keys, changed and unchanged prices.

    The batch names some keys three times; ``seq`` tells the order.
    """
    late = F.dayofyear("day") % 3 == 0
    first = panel.filter(~late)
    batch = panel.filter(late | (F.day("day") % 2 == 0))
    versions = F.array(
        F.struct(F.lit(1).alias("seq"), (F.col("price") + F.lit(100)).alias("price")),
        F.struct(F.lit(2).alias("seq"), (F.col("price") + F.lit(100)).alias("price")),
        F.struct(F.lit(3).alias("seq"), (F.col("price") + F.day("day") % 3).alias("price")))
    kept = F.when(F.day("day") % 5 == 0, versions).otherwise(F.slice(versions, 3, 1))
    return first, batch.select("region", "priority", "day", F.inline(kept))


def order_pages(panel: DataFrame) -> DataFrame:
    """The order panel as report pages: one per priority and month, one row per region.

    A page holds at most one cell per region and day of a month, so no group grows with the data.
    """
    month = F.trunc("day", "month")
    days = F.sequence(F.col("month"), F.last_day("month"))
    text = F.translate(F.format_number("price", 0), ",", ".")
    rows = panel.groupBy("priority", month.alias("month"), "region").agg(
        F.map_from_entries(F.collect_list(F.struct("day", text))).alias("_prices"))
    cell: Column = F.array_join(F.transform(days, lambda d: F.concat(
        F.lit("<td>"), F.coalesce(F.try_element_at("_prices", d), F.lit("-")), F.lit("</td>"))), "")
    name = F.replace(F.lower("region"), F.lit(" "), F.lit("&nbsp;"))
    rows = rows.withColumn("_row", F.concat(F.lit("<tr><td>1</td><td> "), name, F.lit(" </td>"), cell, F.lit("</tr>")))
    heads = F.array_join(F.transform(days, lambda d: F.concat(
        F.lit("<th>"), F.date_format(d, "dd/ MM/yyyy"), F.lit("</th>"))), "")
    pages = rows.groupBy("priority", "month").agg(F.array_join(F.collect_list("_row"), "\n").alias("_rows"))
    return pages.select("priority", F.concat(
        F.lit("<html><table class='r'>\n<tr><th>No</th><th>Komoditas (Rp)</th>"), heads,
        F.lit("<th>x</th></tr>\n<tr><td></td><td>Semua Provinsi</td><td>44.000</td></tr>\n"),
        F.col("_rows"), F.lit("</table></html>")).alias("html"))
