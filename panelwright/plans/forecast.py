"""Forecasts for many requests, or for every series, in one job, and their report tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators.joins import requests_with_history
from panelwright.operators.model import BoundedModel, forecast_rows, rollout
from panelwright.operators.quality import passed, rejected
from panelwright.operators.series import carry_forward, latest_windows, series_keys
from panelwright.schema import LAG
from panelwright.spec import CHILI, PanelSpec


def every_series(panel: DataFrame, horizon: int, spec: PanelSpec = CHILI, **filters: str | None) -> DataFrame:
    """Requests for all series of the panel, optionally of one key value only."""
    for column, value in filters.items():
        if value:
            panel = panel.filter(F.col(column) == value)
    return series_keys(panel, spec).withColumn("durasi", F.lit(horizon))


def request_windows(panel: DataFrame, requests: DataFrame, as_of: Column | None = None, lag: int = LAG,
                    spec: PanelSpec = CHILI) -> DataFrame:
    """Requests with the latest window of their series, carried forward to ``as_of`` if given."""
    windows = latest_windows(panel, lag, spec)
    if as_of is not None:
        windows = carry_forward(windows, as_of, lag)
    return requests_with_history(requests, windows, spec, lag)


def forecast(panel: DataFrame, requests: DataFrame, weights: Sequence[float], scaler: DataFrame,
             as_of: Column | None = None, spec: PanelSpec = CHILI, link: str = "identity",
             intercept: float = 0.0) -> DataFrame:
    """Rolled-out requests for given coefficients, oldest lag first."""
    ready = passed(request_windows(panel, requests, as_of, len(weights), spec))
    return rollout(ready, weights, scaler, F.col("durasi"), F.lit(float(intercept)), link)


def forecast_with(model: BoundedModel, panel: DataFrame, requests: DataFrame, scaler: DataFrame,
                  as_of: Column | None = None, spec: PanelSpec = CHILI) -> DataFrame:
    """Rolled-out requests of a fitted model; ``rejects`` has those that can't be."""
    ready = passed(_known(model, request_windows(panel, requests, as_of, len(model.lags), spec)))
    return rollout(ready, model.lags, scaler, F.col("durasi"), F.col("_bias"), "logit")


def _known(model: BoundedModel, requests: DataFrame) -> DataFrame:
    unknown = F.when(F.col("_bias").isNull(), F.lit("unknown series"))
    return model.with_bias(requests).withColumn("reason", F.coalesce("reason", unknown))


def rejects(panel: DataFrame, requests: DataFrame, as_of: Column | None = None, lag: int = LAG,
            spec: PanelSpec = CHILI, model: BoundedModel | None = None) -> DataFrame:
    """Requests that get no forecast, each with its ``reason``: too little data, or, with a ``model``, a series
    that wasn't in its training."""
    windows = request_windows(panel, requests, as_of, len(model.lags) if model else lag, spec)
    if model:
        windows = _known(model, windows).drop("_bias")
    return rejected(windows).drop("history")


def report(rolled: DataFrame, spec: PanelSpec = CHILI, made_at: Column | None = None) -> DataFrame:
    """Report rows: title fields, date and formatted price."""
    rows = forecast_rows(rolled, spec)
    columns = [*spec.keys,
               F.concat(F.col("durasi").cast("string"), F.lit(" Hari")).alias("durasi"),
               "step",
               S.iso_date(F.col(spec.time)).alias("tanggal_prediksi"),
               S.rupiah(F.col(spec.value)).alias("harga_prediksi")]
    if made_at is not None:
        columns.append(F.date_format(made_at, "yyyy-MM-dd HH:mm:ss").alias("dibuat_pada"))
    return rows.select(*columns)
