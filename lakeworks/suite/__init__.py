"""Registered queries over the driver tables, each paired (where SQL can say it) with an
independent DuckDB oracle. Every query reads whole tables; nothing is capped or sampled."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Register a ``(spark, sf_dir) -> DataFrame`` query and its oracle SQL (None -> rows-only)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def _reach_local_workers(spark: SparkSession) -> None:
    """Let the Python workers of a local session import this package wherever the session was started from (a cluster has
    it installed, or shipped with ``--py-files``)."""
    context = spark.sparkContext
    root = str(Path(__file__).resolve().parents[2])
    known = context.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if context.master.startswith("local") and root not in known.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(p for p in (root, known) if p)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    _reach_local_workers(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def round6(df: DataFrame) -> DataFrame:
    """Round DOUBLE/FLOAT columns to 6 digits so both engines hash the same values."""
    return df.select(
        *[
            F.round(F.col(f.name), 6).alias(f.name) if f.dataType.typeName() in ("double", "float") else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def load_all() -> None:
    """Import every suite module so its queries register."""
    from lakeworks.suite import (  # noqa: F401
        evaluation,
        io_tables,
        modeling,
        sql_surface,
    )
