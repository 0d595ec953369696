"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Paths of the tables stored since ``store_alone`` began, if it is at work.
_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def build_session(name: str = "panelwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are planned for.

    Sizes (shuffle partitions, split bytes) stay with the caller: on a cluster AQE coalesces from
    the configured ``spark.sql.shuffle.partitions`` down to ``advisoryPartitionSizeInBytes``.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, or what ``setCheckpointDir`` was given.

    Only a session in one process without either gets a temporary folder of its own, one for the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there, so a lost executor costs no rerun."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def work_dir(spark: SparkSession) -> str:
    """Where this application keeps intermediate tables on the shared storage, until ``release``."""
    return f"{shared_dir(spark)}/panelwright/{spark.sparkContext.applicationId}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it from there.

    For frames that several branches of a plan read: each branch then scans just its columns. The table
    lives until ``release``.
    """
    path = f"{work_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    if _made.get() is not None:
        _made.get().append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_dealt(df: DataFrame, name: str, column: str) -> DataFrame:
    """As ``store``, in buckets by ``column``, as many as shuffles have partitions.

    Joins and groups by that column read the buckets as they lie; only the other side of a join is dealt out.
    """
    spark, table = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    path = f"{work_dir(spark)}/{table}"
    if _made.get() is not None:
        _made.get().append(path)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, column).option("path", path).saveAsTable(table, format="parquet")
    try:
        return spark.table(table)
    finally:
        # The frame knows the files and their buckets by now; the name isn't needed, the files stay.
        spark.sql(f"DROP TABLE {table}")


def store_alone(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """Stores what ``make`` returns and removes the tables that were stored on the way, also if it fails."""
    spark, found, token = SparkSession.getActiveSession(), [], _made.set([])
    try:
        result = store(make(), name)
        found = _made.get()[-1:]
        return result
    finally:
        inner = [path for path in _made.get() if path not in found]
        _made.reset(token)
        if _made.get() is not None:
            _made.get().extend(found)
        for path in inner:
            _delete(spark, path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Removes the application's intermediate tables; frames that still read them are no longer usable."""
    _delete(spark, work_dir(spark))
