"""Rollout, model fit and the training and forecast plans."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PCA, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelwright.operators import evaluate as E
from panelwright.operators import model as M
from panelwright.operators.series import latest_windows, tidy
from panelwright.plans import forecast as forecasts
from panelwright.plans import training
from panelwright.session import cut_lineage
from panelwright.sources import sinks
from panelwright.sources.registry import RunRegistry
from panelwright.spec import PanelSpec

SPEC = PanelSpec(("shop", "item"), "d", "v")
DAY = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def prices(spark):
    rows = []
    for s, shop in enumerate("ab"):
        for i, item in enumerate("xy"):
            for t in range(120):
                value = 20000 + 3000 * s + 1500 * i + 800 * math.sin(t / 6 + s) + 40 * ((t * 7) % 11)
                rows.append((shop, item, DAY + dt.timedelta(days=t), None if t % 13 == 5 else round(value)))
    return spark.createDataFrame(rows, "shop string, item string, d date, v int").repartition(3)


@pytest.fixture(scope="module")
def run(prices):
    return training.train(prices, SPEC)


@pytest.fixture(scope="module")
def windows(prices):
    return cut_lineage(training.training_windows(training.prepared_panel(prices, SPEC), SPEC)[0])


def identity_scaler(spark):
    return spark.createDataFrame([(0.0, 1.0)], "vmin double, vmax double")


def window(spark, values):
    rows = [("a", "x", DAY + dt.timedelta(days=i), float(v)) for i, v in enumerate(values)]
    return latest_windows(spark.createDataFrame(rows, "shop string, item string, d date, v double"), 7, SPEC)


def rolled(spark, horizon, values=range(1, 8)):
    return M.rollout(window(spark, values), [0.125] * 7, identity_scaler(spark), F.lit(horizon), link="identity")


def test_rollout_feeds_on_itself(spark):
    assert rolled(spark, 2).first().predictions == [3.5, 3.8125]


def test_longer_horizon_extends_the_shorter(spark):
    short, long = rolled(spark, 4).first().predictions, rolled(spark, 5).first().predictions
    assert long[:4] == short


def test_no_horizon_or_short_window_gives_no_rows(spark):
    for df in (rolled(spark, 0), rolled(spark, -3), rolled(spark, 5, range(6))):
        assert M.forecast_rows(df.withColumn("durasi", F.lit(1)), SPEC).count() == 0


def test_forecast_rows_and_nested(spark):
    df = rolled(spark, 3).withColumn("durasi", F.lit(3))
    rows = M.forecast_rows(df, SPEC).orderBy("step").collect()
    assert [(r.step, r.d, r.v) for r in rows] == [
        (i + 1, DAY + dt.timedelta(days=7 + i), round(p)) for i, p in enumerate(df.first().predictions)]
    nested = M.forecast_nested(df, SPEC).first()
    assert [(x.d, x.v) for x in nested.data] == [(r.d.isoformat(), r.v) for r in rows]
    assert nested.tanggal_terakhir == "2024-01-07" and nested.harga_terakhir == 7.0


def test_windows_do_not_leak(windows):
    counts = {(r.shop, r.item, r.split): r["count"] for r in windows.groupBy("shop", "item", "split").count().collect()}
    assert set(counts.values()) == {84 - 7, 36} and len(counts) == 8
    train = windows.filter("split = 'train'").agg(F.min("y"), F.max("y")).first()
    assert 0.0 <= train[0] and train[1] <= 1.0


def test_split_parts_leave_values_unfilled(prices):
    parts = tidy(training.split_parts(prices, SPEC))
    assert parts.filter(F.col("v").isNull()).count() == prices.filter(F.col("v").isNull()).count()
    assert tidy(training.split_parts(prices, SPEC, min_rows=121)).count() == 0


def test_model_beats_a_constant(run):
    row = run.metrics.first()
    assert row.n == 4 * 36 and row.mape < 5
    assert run.metrics_by_series.count() == 4


def test_fit_equals_that_of_spark_ml(run, windows):
    """The same likelihood by MLlib, whose indicators and coefficients are all on the driver."""
    train = windows.filter("split = 'train'")
    inputs = Pipeline(stages=[
        VectorAssembler(inputCols=M.lag_names(), outputCol="_lags"), PCA(k=7, inputCol="_lags", outputCol="_parts"),
        StringIndexer(inputCols=["shop", "item"], outputCols=["_s", "_i"]),
        OneHotEncoder(inputCols=["_s", "_i"], outputCols=["_sh", "_ih"]),
        VectorAssembler(inputCols=["_parts", "_sh", "_ih"], outputCol="features")]).fit(train)
    both = F.array(F.struct(F.lit(1.0).alias("label"), F.col("y").alias("weight")),
                   F.struct(F.lit(0.0).alias("label"), (1.0 - F.col("y")).alias("weight")))
    ready = inputs.transform(train).select("features", F.inline(both)).filter("weight > 0")
    fitted = LogisticRegression(weightCol="weight", maxIter=300, tol=1e-12).fit(ready)
    theirs = fitted.transform(inputs.transform(M.predict_one_step(run.model, windows).withColumnRenamed("prediction", "ours")))
    apart = F.abs(F.col("ours") - vector_to_array("probability")[1])
    assert theirs.agg(F.max(apart)).first()[0] < 1e-4


def test_fit_is_the_optimum(windows, run):
    """A dense Newton solve of the same likelihood; the levels' redundancy is taken out by a tiny penalty."""
    rows = M.predict_one_step(run.model, windows.filter("split = 'train'")).collect()
    y, ours = np.array([r.y for r in rows]), np.array([r.prediction for r in rows])
    x = np.array([[1.0, r.shop == "b", r.item == "y", *(r[n] for n in M.lag_names())] for r in rows])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ w))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-10 * np.eye(len(w)), x.T @ (y - p))
    assert np.abs(1 / (1 + np.exp(-x @ w)) - ours).max() < 1e-7


def test_fit_meets_its_score_equations(windows, run):
    """Per key level and per lag, predictions sum to what the targets sum to."""
    rows = M.predict_one_step(run.model, windows.filter("split = 'train'"))
    miss = F.col("y") - F.col("prediction")
    sums = [F.sum(miss), *(F.sum(miss * F.col(n)) for n in M.lag_names())]
    for key in SPEC.keys:
        for r in rows.groupBy(key).agg(F.sum(miss).alias("s"), F.count("*").alias("n")).collect():
            assert abs(r.s) / r.n < 1e-8
    assert max(abs(v) for v in rows.agg(*sums).first()) / rows.count() < 1e-8


def test_unbalanced_keys_and_many_levels(spark):
    """Levels that meet few others, a key of integers, and more levels than a list in the plan could hold."""
    rng = np.random.default_rng(2)
    n, shops = 6000, 1500
    shop, item = rng.integers(0, shops, n), rng.integers(0, 4, n)
    item = np.where(shop % 5 == 0, 0, item)
    x = rng.random((n, 2)) * 0.5 + 0.1 * (shop % 7)[:, None] / 7
    y = 1 / (1 + np.exp(-(x @ [1.0, 2.0] - 1.5 + 0.3 * np.sin(shop) + 0.2 * item + rng.normal(0, 0.3, n))))
    rows = [(f"s{a}", int(b), DAY + dt.timedelta(days=i), float(p), float(q), float(t))
            for i, (a, b, (p, q), t) in enumerate(zip(shop, item, x, y))]
    df = spark.createDataFrame(rows, "shop string, item int, d date, lag_2 double, lag_1 double, y double")
    model = M.fit_bounded(df, SPEC, 2)
    assert model.effects.count() == len(set(shop)) + 4
    sums = M.score_sums(M.predict_one_step(model, df), SPEC, 2)
    assert sums.agg(F.max(F.abs(F.col("target") - F.col("predicted")))).first()[0] < 1e-4
    levels, where = np.unique(shop, return_inverse=True)
    dense = np.hstack([x, np.eye(len(levels))[where], np.eye(4)[item][:, 1:]])
    w = np.zeros(dense.shape[1])
    for _ in range(20):
        p = 1 / (1 + np.exp(-dense @ w))
        w += np.linalg.solve((dense * (p * (1 - p))[:, None]).T @ dense + 1e-10 * np.eye(len(w)), dense.T @ (y - p))
    assert np.abs(np.array(model.lags) - w[:2]).max() < 1e-4


def test_the_driver_gets_no_levels(spark, monkeypatch):
    """What comes back from each pass is one row of sums, whatever the number of levels."""
    sizes = []
    collect = type(spark.range(0)).collect

    def counted(df):
        rows = collect(df)
        sizes.append((len(rows), len(df.columns)))
        return rows
    rows = [(f"s{i % 300}", "x", DAY + dt.timedelta(days=i), (i % 7) / 7, (i % 13) / 13) for i in range(900)]
    df = spark.createDataFrame(rows, "shop string, item string, d date, lag_1 double, y double")
    monkeypatch.setattr(type(df), "collect", counted)
    M.fit_bounded(df, SPEC, 1, max_iter=3)
    assert sizes and set(sizes) == {(1, 4)}


def test_a_series_that_was_not_in_training_is_rejected(spark, run, prices):
    more = prices.filter("v is not null").union(
        prices.filter("shop = 'a' and v is not null").withColumn("shop", F.lit("new")))
    requests = forecasts.every_series(more, 2, SPEC)
    rolled = forecasts.forecast_with(run.model, more, requests, run.scaler, spec=SPEC)
    assert {r.shop for r in rolled.collect()} == {"a", "b"}
    lost = forecasts.rejects(more, requests, spec=SPEC, model=run.model).collect()
    assert sorted((r.shop, r.item, r.reason) for r in lost) == [("new", i, "unknown series") for i in "xy"]
    assert run.unscored.count() == 0


def test_saved_model_forecasts_the_same(spark, run, prices, tmp_path):
    run.model.save(str(tmp_path / "m"))
    loaded = M.load_model(spark, str(tmp_path / "m"))
    requests = forecasts.every_series(prices, 5, SPEC, shop="a")
    out = []
    for model in (run.model, loaded):
        df = forecasts.forecast_with(model, prices.filter("v is not null"), requests, run.scaler, spec=SPEC)
        out.append(sorted(tuple(r) for r in M.forecast_rows(df, SPEC).collect()))
    assert out[0] == out[1] and len(out[0]) == 2 * 5
    assert all(15000 < r[-1] < 30000 for r in out[0])


def test_report_is_written_by_series(spark, prices, tmp_path):
    known = prices.filter("v is not null")
    requests = forecasts.every_series(known, 2, SPEC)
    df = forecasts.forecast(known, requests, [1 / 7] * 7, E.fit_scaler(known, "v"),
                            as_of=F.lit(DAY + dt.timedelta(days=122)), spec=SPEC)
    report = forecasts.report(df, SPEC, F.lit("2024-05-05 01:02:03").cast("timestamp"))
    sinks.write_report(report, str(tmp_path / "r"), SPEC)
    rows = spark.read.parquet(str(tmp_path / "r")).filter("shop = 'a' and item = 'x'").orderBy("step").collect()
    assert [r.tanggal_prediksi for r in rows] == ["2024-05-03", "2024-05-04"]
    assert rows[0].durasi == "2 Hari" and rows[0].harga_prediksi.startswith("Rp ") and "." in rows[0].harga_prediksi
    assert rows[0].dibuat_pada == "2024-05-05 01:02:03"


def test_run_is_logged(spark, run, prices, windows, tmp_path):
    registry = RunRegistry(spark, str(tmp_path))
    assert registry.current() is None and registry.metrics().count() == 0
    assert training.log_run(run, registry, "r1")
    found = registry.current()
    metrics = {r.name: r.value for r in found.metrics.collect()}
    assert set(metrics) == {"final_train_loss_mse", "global_mape", "global_rmse", "global_mae"}
    assert 0 < metrics["final_train_loss_mse"] < 0.05
    assert {r.name: r.value for r in found.params.collect()} == {"lag": "7", "split_ratio": "0.7", "total_features": "11"}
    assert found.scaler.collect() == run.scaler.collect()
    both = M.predict_one_step(found.model, M.predict_one_step(run.model, windows).withColumnRenamed("prediction", "a"), "b")
    assert both.where("a <> b").count() == 0 and both.where("a = b").count() > 0


def test_a_broken_off_run_is_invisible(spark, run, tmp_path, monkeypatch):
    registry = RunRegistry(spark, str(tmp_path))
    training.log_run(run, registry, "r1")
    with monkeypatch.context() as m:
        m.setattr(M.BoundedModel, "save", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            training.log_run(run, registry, "r2")
    assert registry.run_ids() == ["r1"] and registry.current().run_id == "r1"
    assert {r.run_id for r in registry.metrics().collect()} == {r.run_id for r in registry.params().collect()} == {"r1"}
    assert not training.log_run(run, registry, "r1")  # the first one counts
    assert registry.metrics().count() == 4
    assert training.log_run(run, registry, "r2") and registry.current().run_id == "r2"
    registry.promote("r1")
    assert registry.current().run_id == "r1" and registry.metrics().count() == 8
    with pytest.raises(KeyError):
        registry.promote("r3")
