"""Session access and the shared work folder.

Operators never build their own session: they take the one a frame belongs to, or the active one.
Scratch output (staging tables, exported files, checkpoints) goes under the folder the cluster
names in ``spark.checkpoint.dir``; a default is set only when the session has none (local tests).
"""

from __future__ import annotations

import os
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_SCRATCH_DB = "lakeworks_scratch"
#: per thread, the folders that each open :func:`scratch_scope` has to remove
_scopes = threading.local()


def local_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "lakeworks") -> SparkSession:
    """Session for tests and local runs; a cluster passes its own session instead."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def work_dir(spark: SparkSession) -> str:
    """Shared scratch folder: ``spark.checkpoint.dir`` when the cluster sets it.

    When unset, a folder in the warehouse is registered as the checkpoint dir, its URI as it is, so
    ``DataFrame.checkpoint()`` and staging writes use one place. A plain local path will do for a local
    session only; a cluster without any shared location gets an error.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir", "spark-warehouse").rstrip("/")
    if "://" not in warehouse and not warehouse.startswith("file:"):
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset and the warehouse is no shared location")
        warehouse = os.path.abspath(warehouse)
    sc.setCheckpointDir(f"{warehouse}/_lakeworks_checkpoints")
    return sc.getCheckpointDir().rstrip("/")


def run_folder(spark: SparkSession, run_id: str | None = None) -> str:
    """The folder in the work dir that holds all scratch output of a run, by default this application's."""
    return f"{work_dir(spark)}/lakeworks-{run_id or spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder of this run. The innermost open :func:`scratch_scope` removes it; without one it stays
    until :func:`sweep`."""
    path = f"{run_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    for paths in getattr(_scopes, "open", [])[-1:]:
        paths.append(path)
    return path


def remove_path(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    """Delete a folder or file through the cluster's file system; says whether there was one."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(conf)
    return bool(fs.exists(at) and fs.delete(at, recursive))


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Remove at its end what was stored on the way: operators keep histograms, signatures, staged rows and the like in
    scratch folders, which their results read. So build, and read or write, the result inside::

        with scratch_scope(spark):
            performance_report(...).write.parquet(target)

    Scopes nest; folders of other threads are not touched. Scratch tables are dropped by name, not here."""
    stack = _scopes.__dict__.setdefault("open", [])
    stack.append([])
    try:
        yield stack[-1]
    finally:
        for path in stack.pop():
            remove_path(spark, path)


def sweep(spark: SparkSession, run_id: str | None = None) -> bool:
    """Remove all scratch folders of a run that has ended (by its application id), or of this one, once its results are
    read; says whether there were any. A scheduler calls it for runs that were lost."""
    return remove_path(spark, run_folder(spark, run_id))


def scratch_database(spark: SparkSession) -> str:
    """Database for staging and demo tables, located in the shared work folder."""
    if not spark.catalog.databaseExists(_SCRATCH_DB):
        loc = f"{work_dir(spark)}/{_SCRATCH_DB}.db"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_SCRATCH_DB} LOCATION '{loc}'")
    return _SCRATCH_DB


def scratch_table(spark: SparkSession, label: str) -> str:
    """A unique qualified table name in the scratch database."""
    return f"{scratch_database(spark)}.{label}_{uuid.uuid4().hex[:10]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss, unlike a local one)."""
    work_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared work folder and read back: it is computed once, its
    lineage is cut, and its size is known to the planner."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
