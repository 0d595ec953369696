"""Training runs on shared storage: metrics, parameters, scaler and model of a run become visible together.

A run's parts are written into a folder of their own; then one small file, named by the run, says where they are. It is created
exclusively, so a broken-off run is invisible and of two drivers that log one run the first counts. Which run
is in use is the last of a row of numbered files, each created once.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwright.operators.model import BoundedModel, load_model
from panelwright.sources.sinks import append_metrics, append_params, load_scaler, save_scaler
from panelwright.sources.storage import Folder


@dataclass(frozen=True)
class LoggedRun:
    run_id: str
    metrics: DataFrame
    params: DataFrame
    scaler: DataFrame
    model: BoundedModel


class RunRegistry:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._runs, self._current = Folder(spark, f"{path}/runs"), Folder(spark, f"{path}/current")

    def log(self, run_id: str, metrics: list[DataFrame], params: dict[str, object], scaler: DataFrame,
            model: BoundedModel) -> bool:
        """Stores the run and makes it visible; False if there is a run of that name already. ``metrics`` have one row each."""
        folder = f"parts/{uuid.uuid4().hex}"
        for found in metrics:
            append_metrics(found, f"{self.path}/{folder}/metrics", run_id)
        append_params(self.spark, params, f"{self.path}/{folder}/params", run_id)
        save_scaler(scaler, f"{self.path}/{folder}/scaler")
        model.save(f"{self.path}/{folder}/model")
        return self._runs.create(f"{run_id}.json", json.dumps({"run_id": run_id, "folder": folder}))

    def run_ids(self) -> list[str]:
        return [name.removesuffix(".json") for name in self._runs.names()]

    def get(self, run_id: str) -> LoggedRun:
        if run_id not in self.run_ids():
            raise KeyError(run_id)
        at = f"{self.path}/{json.loads(self._runs.read(f'{run_id}.json'))['folder']}"
        read = self.spark.read.parquet
        return LoggedRun(run_id, read(f"{at}/metrics"), read(f"{at}/params"), load_scaler(self.spark, f"{at}/scaler"),
                         load_model(self.spark, f"{at}/model"))

    def metrics(self) -> DataFrame:
        """(run_id, logged_at, name, value) of all visible runs."""
        return self._all("metrics", "run_id string, logged_at timestamp, name string, value double")

    def params(self) -> DataFrame:
        """(run_id, name, value) of all visible runs."""
        return self._all("params", "run_id string, name string, value string")

    def _all(self, part: str, schema: str) -> DataFrame:
        listed = self.spark.read.schema("run_id string, folder string").json(self._runs.path)
        rows = self.spark.read.schema(schema).option("recursiveFileLookup", True).option(
            "pathGlobFilter", "*.parquet").parquet(f"{self.path}/parts/*/{part}") if self.run_ids() else (
            self.spark.createDataFrame([], schema))
        folder = F.regexp_extract("_metadata.file_path", "/(parts/[0-9a-f]+)/", 1) if self.run_ids() else F.lit("")
        return rows.withColumn("_folder", folder).join(
            listed.select(F.col("folder").alias("_folder")), "_folder", "left_semi").drop("_folder")

    def promote(self, run_id: str) -> None:
        """Makes a visible run the current one."""
        if run_id not in self.run_ids():
            raise KeyError(run_id)
        number = len(self._current.names()) + 1
        while not self._current.create(f"{number:020d}.json", json.dumps({"run_id": run_id})):
            number += 1

    def current(self) -> LoggedRun | None:
        names = self._current.names()
        return self.get(json.loads(self._current.read(names[-1]))["run_id"]) if names else None
