"""Writers: plain tables, split export, reports, metrics and scalers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.spec import CHILI, PanelSpec

BUCKET = "_bucket"


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def replace(df: DataFrame, path: str) -> None:
    """Empty the table and load it; readers see the rows only after the whole write has succeeded."""
    df.write.mode("overwrite").parquet(path)


def _by_series(df: DataFrame, spec: PanelSpec, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*spec.keys), F.lit(buckets)))


def export_splits(df: DataFrame, path: str, spec: PanelSpec = CHILI, buckets: int = 64) -> None:
    """The raw train and test rows of every series as delimited files, with their keys.

    A folder holds one part of all series of a bucket, so the number of folders doesn't grow with the
    series. The write is rebalanced: a long series is spread over several files, short ones share one.
    """
    out = _by_series(df.select(*spec.columns, "split"), spec, buckets)
    by = ["split", BUCKET]
    out.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).option("header", True).csv(path)


def write_report(report: DataFrame, path: str, spec: PanelSpec = CHILI, buckets: int = 64) -> None:
    out = _by_series(report, spec, buckets)
    out.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def append_metrics(metrics: DataFrame, path: str, run_id: str) -> None:
    """One-row metrics, one column each, as rows (run_id, logged_at, name, value)."""
    names = [f.name for f in metrics.schema if isinstance(f.dataType, T.NumericType)]
    long = metrics.select(*[F.col(n).cast("double").alias(n) for n in names])
    long = long.unpivot([], names, "name", "value")
    long.select(F.lit(run_id).alias("run_id"), F.current_timestamp().alias("logged_at"), "name",
                "value").write.mode("append").parquet(path)


def append_params(spark: SparkSession, params: dict[str, object], path: str, run_id: str) -> None:
    rows = [(run_id, name, str(value)) for name, value in params.items()]
    spark.createDataFrame(rows, "run_id string, name string, value string").write.mode("append").parquet(path)


def save_scaler(scaler: DataFrame, path: str) -> None:
    scaler.write.mode("overwrite").parquet(path)


def load_scaler(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
