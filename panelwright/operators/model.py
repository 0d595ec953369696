"""One global regressor with an output in (0, 1) over all series, and its multi-step rollout.

Inputs are the scaled lags and one effect per level of every key column; the fit is the maximum of the binomial likelihood
of the targets' shares (logistic regression). Newton's method on tables: only the weights of the lags, and sums as many as their
pairs, are on the driver. Effects are columns of a table of series, so their number has no bound there.

* A pass over the rows gives every series its gradient, its curvature and its curvature with each lag. Rows are partitioned
  by series and time block once; passes send them no more than a number per block.
* The Newton equations of the effects are solved on the series alone, for the gradient and for each lag at once: per key, the
  sums of each level, taking turns until ``sweeps`` is reached. With a complete panel two rounds are all but exact, and what
  is left is made up for by the next step.
* What remains is a system as small as the number of lags.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.functions import scalars as S
from panelwright.operators.blocks import attach, group, tag
from panelwright.operators.evaluate import bounds
from panelwright.schema import LAG
from panelwright.session import store
from panelwright.sources.storage import Folder
from panelwright.spec import CHILI, PanelSpec


def lag_names(lag: int = LAG) -> list[str]:
    """Oldest lag first, the order of the window and of every sum over it."""
    return [f"lag_{i}" for i in range(lag, 0, -1)]


@dataclass(frozen=True)
class BoundedModel:
    """Coefficients of a fitted model; ``effects`` has one row (key, level, effect) per key level."""

    lags: tuple[float, ...]
    intercept: float
    effects: DataFrame
    keys: tuple[str, ...]

    def with_bias(self, df: DataFrame, out: str = "_bias") -> DataFrame:
        """Adds the part of the linear score that is constant in a series; null where a level wasn't in training.

        Effects are looked up once per series, and rows then join their series.
        """
        series = df.select(*self.keys).distinct()
        bias = F.lit(self.intercept)
        for i, key in enumerate(self.keys):
            level = (self.effects.filter(F.col("key") == key)
                     .select(F.col("level").alias("_level"), F.col("effect").alias(f"_effect{i}")))
            series = series.join(level, F.col(key).cast("string") == F.col("_level"), "left").drop("_level")
            bias = bias + F.col(f"_effect{i}")
        series = series.select(*[F.col(k).alias(f"_key_{k}") for k in self.keys], bias.alias(out))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in self.keys])
        return df.join(series, same, "left").drop(*[f"_key_{k}" for k in self.keys])

    def save(self, path: str) -> None:
        """Effects as a table, the other coefficients as one file, which comes last."""
        self.effects.write.mode("overwrite").parquet(f"{path}/effects")
        folder = Folder(self.effects.sparkSession, path)
        folder.remove("weights.json")
        folder.create("weights.json", json.dumps({"lags": self.lags, "intercept": self.intercept, "keys": self.keys}))


def load_model(spark: SparkSession, path: str) -> BoundedModel:
    found = json.loads(Folder(spark, path).read("weights.json"))
    effects = spark.read.schema("key string, level string, effect double").parquet(f"{path}/effects")
    return BoundedModel(tuple(found["lags"]), found["intercept"], effects, tuple(found["keys"]))


def _row_sums(rows: DataFrame, weights: np.ndarray, names: list[str]) -> list[Column]:
    """Sums of a pass: loss, gradient and curvature, alone and with the lags."""
    score = reduce(lambda a, b: a + b, [F.lit(float(w)) * F.col(n) for w, n in zip(weights, names)], F.col("_bias"))
    share = 1.0 / (1.0 + F.exp(-score))
    miss, bend = F.col("y") - share, share * (1.0 - share)
    loss = F.log1p(F.exp(-F.abs(score))) + F.greatest(score, F.lit(0.0)) - F.col("y") * score
    out = [F.sum(loss).alias("_loss"), F.sum(miss).alias("_r0"), F.sum(bend).alias("_h"), F.count("*").alias("_n")]
    for i, a in enumerate(names):
        out += [F.sum(miss * F.col(a)).alias(f"_g{i}"), F.sum(bend * F.col(a)).alias(f"_r{i + 1}")]
        out += [F.sum(bend * F.col(a) * F.col(b)).alias(f"_a{i}_{j}") for j, b in enumerate(names) if j <= i]
    return out


def _solved(stats: DataFrame, keys: Sequence[str], sides: int, sweeps: int) -> DataFrame:
    """Adds ``_c{key}_{side}``: the effects that answer right side ``_r{side}``, by turns over the keys."""
    made = {f"_c{k}_{c}": F.lit(0.0) for k in range(len(keys)) for c in range(sides)}
    stats = stats.withColumns(made)
    turns = [k for _ in range(sweeps if len(keys) > 1 else 1) for k in range(len(keys))]
    for k in turns:
        left = [F.col(f"_r{c}") - F.col("_h") * reduce(lambda a, b: a + b, [F.col(f"_c{i}_{c}") for i in range(len(keys))])
                for c in range(sides)]
        level = stats.groupBy(keys[k]).agg(*[(F.sum(x) / F.greatest(F.sum("_h"), F.lit(1e-300))).alias(f"_d{c}")
                                             for c, x in enumerate(left)])
        stats = stats.join(level, keys[k]).withColumns(
            {f"_c{k}_{c}": F.col(f"_c{k}_{c}") + F.col(f"_d{c}") for c in range(sides)}).drop(
            *[f"_d{c}" for c in range(sides)])
    return stats


def fit_bounded(train: DataFrame, spec: PanelSpec = CHILI, lag: int = LAG, max_iter: int = 60,
                tol: float = 1e-12, sweeps: int = 2) -> BoundedModel:
    """Fits the model on rows with keys, time, scaled ``lag_*`` and a scaled target ``y`` in [0, 1].

    Iterates until the loss changes by less than ``tol`` of itself; a step that makes it worse is halved.
    """
    spark, keys, names = train.sparkSession, list(spec.keys), lag_names(lag)
    rows = tag(train.select(*spec.natural_key, *names, "y"), spec).drop(spec.time)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Every pass reads the rows where they are; those of a lost executor are made again from the train rows.
    rows = rows.repartition(parts, *group(spec)).persist(StorageLevel.MEMORY_AND_DISK)
    blocks = store(rows.select(*group(spec)).distinct(), "blocks")
    weights, step = np.zeros(lag), np.zeros(lag)
    at = blocks.select(*keys).distinct().withColumns({f"_e{k}": F.lit(0.0) for k in range(len(keys))})
    best, share, halved, before = math.inf, 1.0, 0, None
    effect = [F.col(f"_e{k}") for k in range(len(keys))]
    for _ in range(max_iter):
        now = weights + share * step
        if before is not None:
            # The last solution's effects, moved along with the weights.
            effect = [F.col(f"_e{k}") + share * (F.col(f"_c{k}_0") - reduce(lambda a, b: a + b, [
                F.lit(float(d)) * F.col(f"_c{k}_{j + 1}") for j, d in enumerate(step)])) for k in range(len(keys))]
        moved = at.select(*keys, *[e.alias(f"_e{k}") for k, e in enumerate(effect)])
        bias = reduce(lambda a, b: a + b, [F.col(f"_e{k}") for k in range(len(keys))])
        sent = blocks.join(moved.select(*keys, bias.alias("_bias")), keys)
        sums = _row_sums(rows, now, names)
        passed = attach(rows, sent, spec).groupBy(*group(spec)).agg(*sums)
        added = [c for c in passed.columns if c.startswith("_") and c not in group(spec)]
        stats = passed.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in added])
        stats = store(stats.join(moved, keys), "model_stats")
        solved = store(_solved(stats, keys, lag + 1, sweeps), "model_solved")
        total = [reduce(lambda a, b: a + b, [F.col(f"_c{k}_{c}") for k in range(len(keys))]) for c in range(lag + 1)]
        row = solved.agg(
            F.sum("_loss"), F.sum("_n"),
            F.array(*[F.sum(F.col(f"_g{i}") - F.col(f"_r{i + 1}") * total[0]) for i in range(lag)]),
            F.array(*[F.sum(F.col(f"_a{max(i, j)}_{min(i, j)}") - F.col(f"_r{i + 1}") * total[j + 1])
                      for i in range(lag) for j in range(lag)])).first()
        loss = row[0]
        if loss is None:
            raise ValueError("no training rows")
        if loss > best and halved < 20 and best - loss < -tol * abs(best):
            share, halved = share / 2, halved + 1
            continue
        done = abs(best - loss) <= tol * abs(loss)
        weights, best, share, halved, before, at = now, loss, 1.0, 0, solved, solved
        if done:
            break
        bend = np.array(row[3]).reshape(lag, lag)
        step = np.linalg.lstsq((bend + bend.T) / 2, np.array(row[2]), rcond=1e-14)[0]
    rows.unpersist()
    levels = [at.groupBy(F.col(key).cast("string").alias("level")).agg(F.first(f"_e{k}").alias("effect"))
              .select(F.lit(key).alias("key"), "level", "effect") for k, key in enumerate(keys)]
    effects = store(reduce(DataFrame.unionByName, levels), "effects")
    return BoundedModel(tuple(float(w) for w in weights), 0.0, effects, tuple(keys))


def score_sums(scored: DataFrame, spec: PanelSpec = CHILI, lag: int = LAG) -> DataFrame:
    """(term, level, n, target, predicted) of training rows with ``prediction``: at the optimum, targets and predictions have the
    same sum at every key level, and the same sum with every lag."""
    parts = [scored.groupBy(F.col(key).cast("string").alias("level")).agg(
        F.count("*").alias("n"), F.sum("y").alias("target"), F.sum("prediction").alias("predicted"))
        .select(F.lit(key).alias("term"), "level", "n", "target", "predicted") for key in spec.keys]
    sums = [F.struct(F.lit(n).alias("term"), F.lit(None).cast("string").alias("level"), F.count("*").alias("n"),
                     F.sum(F.col("y") * F.col(n)).alias("target"), F.sum(F.col("prediction") * F.col(n)).alias("predicted"))
            for n in lag_names(lag)]
    return reduce(DataFrame.unionByName, [*parts, scored.agg(F.array(*sums).alias("_all")).select(F.inline("_all"))])


def link_value(score: Column, link: str) -> Column:
    if link == "logit":
        return 1.0 / (1.0 + F.exp(-score))
    if link == "identity":
        return score
    raise ValueError(f"unknown link: {link}")


def weighted_sum(bias: Column, weights: Sequence[float], values: Sequence[Column]) -> Column:
    score = bias
    for weight, value in zip(weights, values):
        score = score + F.lit(float(weight)) * value
    return score


def predict_one_step(model: BoundedModel, df: DataFrame, out: str = "prediction") -> DataFrame:
    """Adds the scaled prediction of every row with scaled lags; null for levels that weren't in training."""
    lags = [F.col(name) for name in lag_names(len(model.lags))]
    score = weighted_sum(F.col("_bias"), model.lags, lags)
    return model.with_bias(df).withColumn(out, link_value(score, "logit")).drop("_bias")


def evaluation_frame(scored: DataFrame, scaler: DataFrame, actual: str = "y",
                     predicted: str = "prediction") -> DataFrame:
    """Adds ``aktual`` and ``prediksi`` in prices; predictions are limited to the scaler's range."""
    low, high = bounds(scaler)
    return (scored.withColumn("aktual", S.unscale(F.col(actual), low, high))
            .withColumn("prediksi", S.unscale(S.clip01(F.col(predicted)), low, high)))


def rollout(windows: DataFrame, weights: Sequence[float], scaler: DataFrame, horizon: Column,
            bias: Column | None = None, link: str = "logit") -> DataFrame:
    """Adds ``predictions``, the scaled outputs of ``horizon`` steps that feed on each other.

    Each step appends the unrounded output to the window and drops the oldest value. All series run at
    once, inside the JVM. A horizon below 1 gives an empty array.
    """
    lag = len(weights)
    low, high = bounds(scaler)
    df = windows.withColumn("_low", low).withColumn("_high", high)
    df = df.withColumn("_bias", bias if bias is not None else F.lit(0.0))
    start = F.transform(
        F.slice("history", F.size("history") - F.lit(lag - 1), lag),
        lambda p: S.scale(p["value"].cast("double"), F.col("_low"), F.col("_high")))
    df = df.withColumn("_start", start)

    def step(state: Column, _: Column) -> Column:
        values = [F.get(state["window"], F.lit(i)) for i in range(lag)]
        made = F.array(link_value(weighted_sum(F.col("_bias"), weights, values), link))
        window = F.slice(F.concat(state["window"], made), 2, lag)
        return F.struct(window.alias("window"), F.concat(state["made"], made).alias("made"))

    empty = F.array().cast("array<double>")
    run = F.aggregate(F.sequence(F.lit(1), horizon),
                      F.struct(F.col("_start").alias("window"), empty.alias("made")),
                      step, lambda state: state["made"])
    usable = (horizon >= 1) & (F.size("history") >= lag)
    df = df.withColumn("predictions", F.when(usable, run).otherwise(empty))
    price = F.transform("predictions", lambda p: S.round_int(S.unscale(p, F.col("_low"), F.col("_high"))))
    last = F.element_at("history", -1)
    return (df.withColumn("prices", price)
            .withColumn("tanggal_terakhir", F.when(F.size("history") > 0, last["time"]))
            .withColumn("harga_terakhir", F.when(F.size("history") > 0, last["value"].cast("double")))
            .drop("_low", "_high", "_bias", "_start"))


def forecast_rows(rolled: DataFrame, spec: PanelSpec = CHILI, horizon: str = "durasi") -> DataFrame:
    """One row per forecast day."""
    head = [*spec.keys, horizon, "tanggal_terakhir", "harga_terakhir"]
    return (rolled.select(*head, F.posexplode("prices").alias("_at", spec.value))
            .withColumn("step", F.col("_at") + 1)
            .select(*head, "step", F.date_add("tanggal_terakhir", F.col("step")).alias(spec.time), spec.value))


def forecast_nested(rolled: DataFrame, spec: PanelSpec = CHILI, horizon: str = "durasi") -> DataFrame:
    """One row per request with the forecast days as ``data``, an array of (date text, price)."""
    days = F.transform("prices", lambda p, i: F.struct(
        S.iso_date(F.date_add("tanggal_terakhir", i + 1)).alias(spec.time), p.alias(spec.value)))
    return rolled.select(*spec.keys, horizon, "harga_terakhir",
                         S.iso_date(F.col("tanggal_terakhir")).alias("tanggal_terakhir"), days.alias("data"))
