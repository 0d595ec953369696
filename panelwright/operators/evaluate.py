"""Global scaling and error metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.spec import CHILI, PanelSpec


def fit_scaler(df: DataFrame, value: str = CHILI.value) -> DataFrame:
    """One row (vmin, vmax) over all series; pass the train rows only."""
    return df.agg(F.min(F.col(value).cast("double")).alias("vmin"),
                  F.max(F.col(value).cast("double")).alias("vmax"))


def bounds(scaler: DataFrame) -> tuple[Column, Column]:
    """The two numbers of a scaler as scalar subqueries: no join and nothing on the driver."""
    pair = scaler.select(F.struct("vmin", "vmax")).scalar()
    return pair["vmin"], pair["vmax"]


def scaled(df: DataFrame, scaler: DataFrame, value: str = CHILI.value, out: str | None = None) -> DataFrame:
    low, high = bounds(scaler)
    return df.withColumn(out or value, S.scale(F.col(value), low, high))


def error_metrics(df: DataFrame, actual: str, predicted: str, by: tuple[str, ...] = ()) -> DataFrame:
    """MAPE in percent (true zeros left out), RMSE and MAE, over everything or per series."""
    error = F.col(actual).cast("double") - F.col(predicted).cast("double")
    share = F.when(F.col(actual) != 0, F.abs(error / F.col(actual).cast("double")))
    return df.groupBy(*by).agg(
        F.count("*").alias("n"),
        (F.avg(share) * 100.0).alias("mape"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"))


def residuals(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


def naive_forecast(df: DataFrame, spec: PanelSpec = CHILI) -> DataFrame:
    """The previous row's value as prediction, the yardstick for a fitted model."""
    from panelwright.operators.series import supervised, tidy

    lagged = supervised(df, 1, 1, spec)
    return tidy(lagged.withColumn("prediction", F.col("lag_1")).drop("lag_1", "y"))
