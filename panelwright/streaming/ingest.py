"""Incremental ingest: a stream of snapshot files is upserted into a price table, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from panelwright.operators.numbering import numbered
from panelwright.operators.quality import passed
from panelwright.session import cut_lineage
from panelwright.sources.html import report_rows
from panelwright.sources.price_table import PriceTable

ARRIVAL = "_arrival"


def snapshot_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                    files_per_batch: int | None = None) -> DataFrame:
    """The files of a folder as a stream, each row with where and when it arrived (``ARRIVAL``)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    at = "_metadata.file_modification_time as at, _metadata.file_path as path, _metadata.file_block_start as start"
    return reader.load(folder).selectExpr("*", f"struct({at}) as {ARRIVAL}")


def in_arrival_order(batch: DataFrame, order: str) -> DataFrame:
    """Adds ``order``: by ``fetched_at`` where records have it, then by the time of their file, its name and
    their place in it. Never by the order of reading, as Spark packs files by size.

    The records are numbered by ranges of that order, in as many tasks as there are ranges.
    """
    if ARRIVAL not in batch.columns:
        raise ValueError(f"records need a column {order} or the arrival that snapshot_stream adds")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    at = F.coalesce("fetched_at", f"{ARRIVAL}.at") if "fetched_at" in batch.columns else F.col(f"{ARRIVAL}.at")
    batch = batch.withColumns({"_at": at, "_path": F.col(f"{ARRIVAL}.path"), "_start": F.col(f"{ARRIVAL}.start"), "_seat": place})
    by = ["_at", "_path", "_start", "_seat"]
    return numbered(batch, [F.col(c).asc_nulls_first() for c in by], order).drop(*by, ARRIVAL)


def page_records(pages: DataFrame, names: DataFrame, table: PriceTable, column: str = "name") -> DataFrame:
    """Valid price records of report pages; a ``seq`` of the pages stays with them."""
    keep = [c for c in ("seq",) if c in pages.columns]
    return passed(report_rows(pages, names, table.spec, column=column, keep=keep))


def ingest(stream: DataFrame, table: PriceTable, checkpoint: str, source: str,
           prepare: Callable[[DataFrame], DataFrame] | None = None, order: str = "seq",
           fallback: tuple[PriceTable, Callable[[], DataFrame]] | None = None) -> StreamingQuery:
    """Starts the upsert of everything that is there now; late and corrected prices update their key.

    ``source`` names the stream in the table's run log: a repeated micro-batch is applied once. A new
    checkpoint folder counts from zero again and needs a new name. Records without an ``order`` column
    are taken in the order they arrived, and ``prepare`` gets it. If a micro-batch holds no usable record, simulated rows go to
    the ``fallback`` table, never among the real prices.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        if order not in batch.columns:
            batch = in_arrival_order(batch, order)
        records = cut_lineage(prepare(batch) if prepare else batch)
        if fallback and records.isEmpty():
            other, simulate = fallback
            rows = simulate().withColumn(order, F.monotonically_increasing_id())
            other.upsert(rows, batch_id, order, source)
            return
        table.upsert(records, batch_id, order, source)

    return (stream.writeStream.foreachBatch(apply)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start())
