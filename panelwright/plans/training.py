"""Training from a price panel: clean, split, fill, scale, window, fit, evaluate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators.evaluate import error_metrics, fit_scaler, scaled
from panelwright.operators.model import BoundedModel, evaluation_frame, fit_bounded, lag_names, predict_one_step
from panelwright.operators.blocks import positions
from panelwright.operators.quality import MIN_TRAIN_ROWS
from panelwright.operators.series import fill_linear, supervised, temporal_split, tidy
from panelwright.operators.spline import fill_spline
from panelwright.schema import LAG, TRAIN_SHARE
from panelwright.session import cut_lineage
from panelwright.sources.registry import RunRegistry
from panelwright.spec import CHILI, PanelSpec


@dataclass(frozen=True)
class TrainingRun:
    model: BoundedModel
    scaler: DataFrame
    scored: DataFrame
    metrics: DataFrame
    metrics_by_series: DataFrame
    train_loss: DataFrame
    unscored: DataFrame
    fitted: DataFrame


def split_parts(panel: DataFrame, spec: PanelSpec = CHILI, min_rows: int = MIN_TRAIN_ROWS,
                share: float = TRAIN_SHARE) -> DataFrame:
    """Price-cleaned rows of the long enough series with their split, before any filling."""
    value = S.clean_price(F.col(spec.value), panel.schema[spec.value].dataType)
    rows = positions(panel.select(*spec.columns).withColumn(spec.value, value), spec)
    return temporal_split(rows.filter(F.col("n") >= min_rows), spec, share)


def prepared_panel(panel: DataFrame, spec: PanelSpec = CHILI, spline: bool = True,
                   min_rows: int = MIN_TRAIN_ROWS, share: float = TRAIN_SHARE) -> DataFrame:
    """Split rows with gaps filled inside each part and prices rounded to hundreds."""
    fill = fill_spline if spline else fill_linear
    return fill(split_parts(panel, spec, min_rows, share), spec, part="split", step=100)


def training_windows(prepared: DataFrame, spec: PanelSpec = CHILI, lag: int = LAG) -> tuple[DataFrame, DataFrame]:
    """Scaled windows with their split, and the scaler fitted on the train rows.

    Lags run over the whole series and a window belongs to the split of its target, so the first test
    windows begin in the train part.
    """
    scaler = fit_scaler(prepared.filter(F.col("split") == "train"), spec.value)
    windows = supervised(scaled(prepared, scaler, spec.value), lag, 1, spec)
    return tidy(windows.select(*spec.natural_key, "split", *lag_names(lag), "y")), scaler


def train(panel: DataFrame, spec: PanelSpec = CHILI, spline: bool = True, lag: int = LAG,
          min_rows: int = MIN_TRAIN_ROWS, share: float = TRAIN_SHARE) -> TrainingRun:
    """The whole run. The filled panel and the windows are cut from their lineage, as the scaler, the
    iterative fit and the evaluation all read them."""
    prepared = cut_lineage(prepared_panel(panel, spec, spline, min_rows, share))
    windows, scaler = training_windows(prepared, spec, lag)
    windows = cut_lineage(windows)
    model = fit_bounded(windows.filter(F.col("split") == "train"), spec, lag)
    predicted = predict_one_step(model, windows)
    missing = F.col("prediction").isNull()
    scored = evaluation_frame(predicted.filter((F.col("split") == "test") & ~missing), scaler)
    unscored = predicted.filter(missing).select(*spec.natural_key, F.lit("unknown series").alias("reason"))
    miss = F.col("y") - F.col("prediction")
    fitted = predicted.filter(F.col("split") == "train")
    loss = fitted.agg(F.avg(miss * miss).alias("final_train_loss_mse"))
    return TrainingRun(model, scaler, scored, error_metrics(scored, "aktual", "prediksi"),
                       error_metrics(scored, "aktual", "prediksi", spec.keys), loss, unscored, fitted)


def log_run(run: TrainingRun, registry: RunRegistry, run_id: str, share: float = TRAIN_SHARE) -> bool:
    """Logs metrics, parameters, scaler and model of the run together and makes it the current one; False if its name is taken."""
    names = {"mape": "global_mape", "rmse": "global_rmse", "mae": "global_mae"}
    found = run.metrics.select(*[F.col(c).alias(name) for c, name in names.items()])
    levels = run.model.effects.count()
    params = {"lag": len(run.model.lags), "split_ratio": share, "total_features": len(run.model.lags) + levels}
    new = registry.log(run_id, [run.train_loss, found], params, run.scaler, run.model)
    if new:
        registry.promote(run_id)
    return new
