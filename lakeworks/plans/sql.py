"""Running SQL on the session: single statements, scripts, named frames, ordered pipelines.

Everything stays lazy: a row-returning last statement comes back as a DataFrame; earlier
statements (DDL/DML, temp views) run in order. Pipelines resolve an ordered list of ``.sql``
files (YAML ``steps`` or alphabetical) and can save each step as a table.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from lakeworks.functions.sqltext import resolve_query, spark_dialect, split_statements

log = logging.getLogger(__name__)


def run_sql(spark: SparkSession, query: str, base_dir: str | Path | None = None, **params) -> DataFrame | None:
    """Run inline SQL or a ``.sql`` file; all statements but the last run first.

    Returns the last statement's frame when it has columns (SELECT, VALUES, SHOW, DESCRIBE, ...), else None.
    """
    text = resolve_query(query, base_dir=base_dir, **params)
    statements = split_statements(text)
    if not statements:
        return None
    for stmt in statements[:-1]:
        spark.sql(spark_dialect(stmt))
    result = spark.sql(spark_dialect(statements[-1]))
    return result if result.columns else None


def fetch(df: DataFrame, fetch_one: bool = False, fetch_all: bool = False):
    """Small results only - all rows wins over one; neither -> None."""
    if fetch_all:
        return df.collect()
    if fetch_one:
        return df.first()
    return None


class FrameSession:
    """Named frames queried together with tables and files.

    Persistent mode registers frames as temp views on the session (they stay until
    unregistered); isolated mode drops them again once the query is analysed and brings back a
    registered frame whose name it used.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.registered: dict[str, DataFrame] = {}

    def register(self, name: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(name)
        self.registered[name] = df

    def unregister(self, name: str) -> bool:
        self.registered.pop(name, None)
        return self.spark.catalog.dropTempView(name)

    def query(
        self, sql: str, frames: Mapping[str, DataFrame] | None = None, use_persistent: bool = True, **params
    ) -> DataFrame | None:
        if use_persistent:
            for name, df in (frames or {}).items():
                self.register(name, df)
            return run_sql(self.spark, sql, **params)
        # isolated: views live only while the query is analysed (the plan keeps what it resolved)
        previous = {n for n in (frames or {}) if self.spark.catalog.tableExists(n) and n not in self.registered}
        if previous:
            raise ValueError(f"frame names shadow existing tables or views: {sorted(previous)}")
        for name, df in (frames or {}).items():
            df.createOrReplaceTempView(name)
        try:
            return run_sql(self.spark, sql, **params)
        finally:
            for name in frames or {}:
                if name in self.registered:
                    self.registered[name].createOrReplaceTempView(name)
                else:
                    self.spark.catalog.dropTempView(name)


# ------------------------------------------------------------------------------- pipelines


def _read_yaml(path: Path):
    import yaml

    with open(path) as fh:
        return yaml.safe_load(fh)


def _declared_steps(entry) -> list[str]:
    """The step names of a YAML mapping; an unusable or empty list counts as none."""
    steps = entry.get("steps") if isinstance(entry, dict) else None
    return [str(x) for x in steps] if isinstance(steps, list) else []


def _named_entries(section) -> list[tuple[str, object]]:
    """``pipelines`` as a mapping or as a list of entries with a ``name``."""
    if isinstance(section, dict):
        return list(section.items())
    return [(x.get("name"), x) for x in section if isinstance(x, dict)] if isinstance(section, list) else []


def pipeline_steps(folder: str | Path, pipeline: str | None = None) -> list[str] | None:
    """D8 YAML rule: without a name the steps of the folder's only YAML file; with one the steps of
    ``<name>.yaml``, else of the first ``pipelines`` section that names it; None means alphabetical."""
    documents = {}
    for path in sorted(Path(folder).glob("*.yaml")):
        try:
            documents[path.stem] = _read_yaml(path)
        except Exception as exc:  # noqa: BLE001 - an unreadable file declares nothing
            log.warning("%s cannot be read: %s", path, exc)
            documents[path.stem] = None
    if pipeline is None:
        if len(documents) > 1:
            log.warning("several YAML files in %s; using alphabetical order", folder)
        found = [_declared_steps(d) for d in documents.values()] if len(documents) == 1 else []
    else:
        sections = [e for d in documents.values() if isinstance(d, dict) for e in _named_entries(d.get("pipelines"))]
        found = [_declared_steps(documents.get(pipeline)), *(_declared_steps(e) for name, e in sections if name == pipeline)]
    steps = next(filter(None, found), None)
    if pipeline is not None and steps is None:
        log.warning("pipeline %s not found in %s; using alphabetical order", pipeline, folder)
    return steps


def sql_files(folder: str | Path, pipeline: str | None = None) -> dict[str, Path]:
    """Ordered ``name -> path`` of the folder's ``.sql`` files; missing step files skipped."""
    folder = Path(folder)
    steps = pipeline_steps(folder, pipeline)
    if steps is not None:
        out = {}
        for step in steps:
            path = folder / f"{step}.sql"
            if path.exists():
                out[step] = path
            else:
                log.warning("step %s has no file %s; skipped", step, path)
        return out
    return {p.stem: p for p in sorted(folder.glob("*.sql"))}


def resolve_query_paths(
    query_paths: str | Path | Sequence[str | Path] | Mapping[str, str | Path], pipeline: str | None = None
) -> dict[str, Path]:
    """A folder, one file, a list or a dict -> ordered ``name -> path``."""
    if isinstance(query_paths, Mapping):
        return {str(k): Path(v) for k, v in query_paths.items()}
    if isinstance(query_paths, (str, Path)):
        p = Path(query_paths)
        if p.is_dir():
            return sql_files(p, pipeline)
        return {p.stem: p}
    return {Path(p).stem: Path(p) for p in query_paths}


def run_scripts(
    spark: SparkSession,
    query_paths,
    pipeline: str | None = None,
    **params,
) -> DataFrame | None:
    """Run scripts in order; the first failure raises naming script and statement.

    If the very last statement returns rows, its frame is returned, else None.
    """
    paths = resolve_query_paths(query_paths, pipeline)
    plan: list[tuple[str, int, str]] = []
    for name, path in paths.items():
        text = resolve_query(str(path), **params)
        for i, stmt in enumerate(split_statements(text), start=1):
            plan.append((name, i, stmt))
    if not plan:
        return None
    result = None
    for idx, (name, i, stmt) in enumerate(plan):
        try:
            df = spark.sql(spark_dialect(stmt))
        except Exception as exc:
            raise RuntimeError(f"script {name!r} statement {i} failed: {exc}") from exc
        if idx == len(plan) - 1 and df.columns:
            result = df
    return result


def pipeline_to_tables(
    spark: SparkSession,
    query_paths,
    pipeline: str | None = None,
    *,
    schema: str | None = None,
    table_prefix: str = "",
    table_suffix: str = "",
    table_names: Mapping[str, str] | None = None,
    modes: Mapping[str, str] | None = None,
    cluster_by: Mapping[str, Sequence[str]] | None = None,
    comments: Mapping[str, str] | None = None,
    default_mode: str = "overwrite",
    return_all: bool = False,
    **params,
):
    """Run each step and save its result as a table; later steps may read earlier tables.

    Table name per step: an explicit override, else ``prefix + step + suffix``; qualified with
    ``schema`` when given. Returns the last step's table frame, or ``{step: frame}``.
    """
    from lakeworks.plans.tables import save_table

    paths = resolve_query_paths(query_paths, pipeline)
    frames: dict[str, DataFrame] = {}
    for step, path in paths.items():
        name = (table_names or {}).get(step) or f"{table_prefix}{step}{table_suffix}"
        if schema and "." not in name:
            name = f"{schema}.{name}"
        df = run_sql(spark, str(path), **params)
        if df is None:
            raise ValueError(f"step {step!r} does not end in a row-returning statement")
        frames[step] = save_table(
            df,
            name,
            mode=(modes or {}).get(step, default_mode),
            zorder_by=(cluster_by or {}).get(step),
            comment=(comments or {}).get(step),
        )
    if return_all:
        return frames
    return frames[list(frames)[-1]] if frames else None
