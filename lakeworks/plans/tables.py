"""Managed and external tables: write, swap, append with schema merge, upsert, compact, export,
load, partitions, identity numbering and the small catalog operations around them.

Parquet tables have no atomic replace, so every replacing write goes through a **staged swap**:
write a staging table, rename the old table away, rename the staging table in, drop the old one.
A frame that reads its own target is therefore safe (the old data is still there while the
staging table is written). All writes are Spark jobs; the driver only issues catalog DDL.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeworks.functions import types as TY
from lakeworks.functions.sqltext import resolve_query, returns_rows, split_statements, spark_dialect
from lakeworks.operators.common import join_keys, running_totals
from lakeworks.session import remove_path, scratch_path, stored
from lakeworks.sources.files import first_parquet_schema, has_files, list_partition_paths, normalize_path

log = logging.getLogger(__name__)

FORMATS = ("parquet", "csv", "json")


# ------------------------------------------------------------------------------ B20, B3, B4


def table_exists(spark: SparkSession, table: str) -> bool:
    """B20."""
    return spark.catalog.tableExists(table)


def drop_table(spark: SparkSession, table: str) -> None:
    """B3."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def set_comment(spark: SparkSession, table: str, comment: str) -> None:
    """Quotes in the comment are doubled."""
    text = comment.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"COMMENT ON TABLE {table} IS '{text}'")


def table_comment(spark: SparkSession, table: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Comment").collect()
    return rows[0]["data_type"] if rows else None


def _split_name(table: str) -> tuple[str, str]:
    if "." in table:
        db, name = table.rsplit(".", 1)
        return db, name
    return "", table


def _sibling(table: str, tag: str) -> str:
    db, name = _split_name(table)
    sib = f"{name}__lw_{tag}_{uuid.uuid4().hex[:8]}"
    return f"{db}.{sib}" if db else sib


def _text(value: str) -> str:
    """``value`` as the inside of a SQL string literal."""
    return str(value).replace("\\", "\\\\").replace("'", "\\'")


#: table properties that the catalog writes itself
_OWN_PROPERTIES = ("transient_lastDdlTime", "numFiles", "totalSize", "spark.sql.")


def _described(spark: SparkSession, table: str) -> dict[str, str]:
    """The table's own part of its description (not the columns, which may have any name)."""
    rows = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()]
    begin = next((i for i, (name, _) in enumerate(rows) if name.startswith("# Detailed")), len(rows))
    return dict(rows[begin + 1 :])


def _names(listed: str | None) -> list[str]:
    """``[`a`, `b`]`` as names."""
    return [n.strip().strip("`") for n in (listed or "").strip("[]").split(",") if n.strip()]


def table_layout(spark: SparkSession, table: str) -> dict:
    """What a replacing write must carry over: provider, partition columns, buckets, comments and properties; and where
    an external table lies."""
    known = _described(spark, table)
    columns = spark.catalog.listColumns(table)
    own = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    properties = {k: v for k, v in own.items() if not k.startswith(_OWN_PROPERTIES) and k != "comment"}
    buckets = int(known.get("Num Buckets") or 0)
    return {
        "provider": known.get("Provider", "parquet").lower(),
        "partition_by": [c.name for c in columns if c.isPartition],
        "comment": table_comment(spark, table),
        "properties": properties,
        "column_comments": {c.name: c.description for c in columns if c.description},
        "buckets": (buckets, _names(known.get("Bucket Columns")), _names(known.get("Sort Columns"))) if buckets > 0 else None,
        "location": known.get("Location") if known.get("Type") == "EXTERNAL" else None,
    }


def _follow_rename(spark: SparkSession, table: str) -> None:
    """Some catalogs keep the old paths of a renamed table's partitions: point them to its folder. Left as they
    are, dropping the renamed-away table would delete the new table's partitions."""
    if not any(c.isPartition for c in spark.catalog.listColumns(table)):
        return
    rows = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    root = rows["Location"].rstrip("/")
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():  # catalog metadata, one row per partition
        pairs = [kv.split("=", 1) for kv in row["partition"].split("/")]
        spec = ", ".join(
            f"{TY.quote(k)} = " + ("NULL" if v == "__HIVE_DEFAULT_PARTITION__" else f"'{_text(unquote(v))}'") for k, v in pairs
        )
        at = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({spec})").where(F.col("col_name") == "Location").first()
        if at is not None and at["data_type"].rstrip("/") == f"{root}/{row['partition']}":
            return  # this catalog follows renames
        spark.sql(f"ALTER TABLE {table} PARTITION ({spec}) SET LOCATION '{_text(root + '/' + row['partition'])}'")
    spark.catalog.refreshTable(table)


def swap_in(spark: SparkSession, staging: str, table: str) -> None:
    """Rename staging over ``table``: old away, staging in, old dropped (never drop first)."""
    if table_exists(spark, table):
        old = _sibling(table, "old")
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
        _follow_rename(spark, old)
        try:
            spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
        except Exception:
            spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
            _follow_rename(spark, table)
            raise
        _follow_rename(spark, table)
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    else:
        spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
        _follow_rename(spark, table)


def replace_table(df: DataFrame, table: str, tag: str = "stage", **layout) -> None:
    """Write ``df`` to a staging table and swap it in for ``table``, which keeps its provider, partitioning, buckets,
    comments and properties unless ``layout`` says otherwise. A failed write leaves no staging table. An external table
    stays where it is: see :func:`overwrite_external`."""
    spark = df.sparkSession
    kept = table_layout(spark, table) if table_exists(spark, table) else {}
    if kept.get("location"):
        overwrite_external(df, table)
        return
    kept = {**kept, **{k: v for k, v in layout.items() if v is not None}}
    have = {c.lower() for c in df.columns}
    partition_by = [c for c in kept.get("partition_by") or [] if c.lower() in have]
    said = {k.lower(): v for k, v in (kept.get("column_comments") or {}).items()}
    if said:
        df = df.select(*[F.col(TY.quote(c)).alias(c, metadata=_with_comment(df, c, said.get(c.lower()))) for c in df.columns])
    staging = _sibling(table, tag)
    try:
        _write_new(df, staging, partition_by=partition_by, provider=kept.get("provider") or "parquet", buckets=kept.get("buckets"))
        if kept.get("comment"):
            set_comment(spark, staging, kept["comment"])
        if kept.get("properties"):
            pairs = ", ".join(f"'{_text(k)}' = '{_text(v)}'" for k, v in kept["properties"].items())
            spark.sql(f"ALTER TABLE {staging} SET TBLPROPERTIES ({pairs})")
        swap_in(spark, staging, table)
    except Exception:
        drop_table(spark, staging)
        raise


def _with_comment(df: DataFrame, column: str, comment: str | None) -> dict:
    return {**df.schema[column].metadata, **({"comment": comment} if comment else {})}


def overwrite_external(df: DataFrame, table: str) -> None:
    """Replace the rows of an external table in its place: it stays external, its location and files' owner stay theirs.

    The new rows are written in whole to the work folder first, so a query that reads the table itself, or fails, does no
    harm; then they are copied in. Should that copy fail, the error names the folder that holds all rows. The columns must
    be those of the table, and values that do not fit raise."""
    spark = df.sparkSession
    schema = spark.table(table).schema
    if {c.lower() for c in df.columns} != {f.name.lower() for f in schema.fields}:
        raise ValueError(f"{table} is external: its files are shared, so its columns cannot be changed by an overwrite")
    path = scratch_path(spark, "external")
    TY.align_to(df, schema, strict=True).write.parquet(path)
    rows = spark.read.schema(schema).parquet(path)
    try:
        rows.write.mode("overwrite").insertInto(table)
    except Exception as failure:
        raise RuntimeError(f"{table} could not be overwritten; its new rows are all in {path}") from failure


# ------------------------------------------------------------------------------ B2


def save_table(
    df: DataFrame,
    table: str,
    schema: str | None = None,
    catalog: str | None = None,
    mode: str = "overwrite",
    *,
    optimize: bool = False,
    zorder_by: str | Sequence[str] | None = None,
    merge_schema: bool = False,
    comment: str | None = None,
    drop_existing: bool = False,
    overwrite_schema: bool = False,
    provider: str | None = None,
    partition_by: Sequence[str] | None = None,
) -> DataFrame:
    """B2: write a managed table and return a frame reading the written table.

    Modes: ``overwrite`` (staged swap; partitioning, comment and properties stay unless given anew; a value
    that does not fit a column raises on append), ``append`` (creates when missing; ``merge_schema`` adds
    new columns first, then inserts by name), ``ignore`` and ``error``. ``overwrite_schema`` and
    ``merge_schema`` exclude each other; ``drop_existing`` with ``append`` is refused.
    """
    spark = df.sparkSession
    from lakeworks.sources.files import qualified_name

    name = qualified_name(table, schema, catalog)
    mode = mode.lower()
    if mode not in ("overwrite", "append", "ignore", "error", "errorifexists"):
        raise ValueError(f"unknown mode {mode!r}")
    if overwrite_schema and merge_schema:
        raise ValueError("overwrite_schema and merge_schema exclude each other")
    if drop_existing and mode == "append":
        raise ValueError("drop_existing with mode='append' would drop the table on every call")
    exists = table_exists(spark, name)
    if mode in ("error", "errorifexists") and exists:
        raise ValueError(f"table {name} already exists")
    if mode == "ignore" and exists:
        return spark.table(name)
    if mode == "append" and exists:
        _append(df, name, merge_schema)
    elif exists:
        replace_table(df, name, partition_by=partition_by, provider=provider, comment=comment)
    else:
        _write_new(df, name, partition_by=partition_by, provider=provider or "parquet")
    if comment:
        set_comment(spark, name, comment)
    if optimize or zorder_by:
        optimize_table(spark, name, zorder_by)
    return spark.table(name)


def _write_new(df: DataFrame, name: str, partition_by=None, provider: str = "parquet", buckets=None) -> None:
    w = df.write.format(provider).mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if buckets and {c.lower() for c in [*buckets[1], *buckets[2]]} <= {c.lower() for c in df.columns}:
        w = w.bucketBy(buckets[0], *buckets[1])
        w = w.sortBy(*buckets[2]) if buckets[2] else w
    w.saveAsTable(name)


def _append(df: DataFrame, name: str, merge_schema: bool) -> None:
    spark = df.sparkSession
    existing = spark.table(name).schema
    have = {f.name.lower() for f in existing.fields}
    new = [f for f in df.schema.fields if f.name.lower() not in have]
    if new and not merge_schema:
        raise ValueError(f"columns {[f.name for f in new]} are not in {name}; pass merge_schema=True")
    if new:
        cols = ", ".join(f"{TY.quote(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({cols})")
        existing = spark.table(name).schema
    TY.align_to(df, existing, strict=True).write.mode("append").insertInto(name)


# ------------------------------------------------------------------------------ B5


def _zorder_columns(zorder_by: str | Sequence[str] | None) -> list[str]:
    if zorder_by is None:
        return []
    items = zorder_by.split(",") if isinstance(zorder_by, str) else list(zorder_by)
    return [c.strip() for c in items if c and c.strip()]


def clustered(df: DataFrame, columns: Sequence[str], partitions: int | None = None, bits: int = 10) -> DataFrame:
    """Range-cluster rows: one column -> range partition + sort; several -> Morton (Z) order of
    per-column quantile buckets (``bits`` bits each), range-partitioned on the Z value. Without
    ``partitions`` the adaptive reader sizes the files."""
    cols = list(columns)
    if not cols:
        return df
    n = [partitions] if partitions else []
    if len(cols) == 1:
        return df.repartitionByRange(*n, cols[0]).sortWithinPartitions(cols[0])
    levels = 1 << bits
    fr = [i / levels for i in range(1, levels)]
    values = [_rankable(df, c) for c in cols]
    # one small row of bucket bounds per column; used as literals (no join needed)
    row = df.agg(
        *[F.percentile_approx(v, F.array(*[F.lit(f) for f in fr]), 1000).alias(f"_b{i}") for i, v in enumerate(values)]
    ).first()
    z = F.lit(0).cast("long")
    codes = [_bucket_code(row[f"_b{i}"] or [], v, bits) for i, v in enumerate(values)]
    tagged = df.select("*", *[c.alias(f"_lw_c{j}") for j, c in enumerate(codes)])
    for bit in range(bits):
        for j in range(len(cols)):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(f"_lw_c{j}", bit).bitwiseAND(F.lit(1)).cast("long"), bit * len(cols) + j))
    out = tagged.withColumn("_lw_z", z).drop(*[f"_lw_c{j}" for j in range(len(cols))])
    return out.repartitionByRange(*n, "_lw_z").sortWithinPartitions("_lw_z").drop("_lw_z")


def _rankable(df: DataFrame, col: str):
    """A column as something that quantile sketches take: text by its first bytes, in their order."""
    if df.schema[col].dataType.typeName() not in ("string", "char", "varchar", "binary"):
        return F.col(TY.quote(col))
    head = F.substring(F.rpad(F.col(TY.quote(col)).cast("binary"), 6, b"\0"), 1, 6)
    return F.conv(F.hex(head), 16, 10).cast("double")


def _bucket_code(bounds: Sequence, value, bits: int):
    """How many sorted bounds are below the value: a binary search of ``bits`` steps over one literal array."""
    known = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(bits))])
    below = lambda n: F.coalesce(F.get(known, n - 1) < value, F.lit(False))
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(below(n + step), n + step).otherwise(n))


def partition_files(spark: SparkSession, table: str, target_bytes: int) -> DataFrame:
    """Per partition (one row for a table without): ``files, bytes`` and ``bins``, the files of ``target_bytes`` that would
    do. Read from the files' footers only."""
    parts = table_layout(spark, table)["partition_by"]
    at = F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).alias("_lw_file")
    rows = spark.table(table).select(*parts, at).groupBy(*parts, "_lw_file").agg(F.count(F.lit(1)).alias("_lw_n"))
    per = rows.groupBy(*parts).agg(F.count(F.lit(1)).alias("files"), F.sum("_lw_file.bytes").alias("bytes"))
    return per.withColumn("bins", F.greatest(F.lit(1), F.ceil(F.col("bytes") / target_bytes)).cast("int"))


def optimize_table(
    spark: SparkSession, table: str, zorder_by: str | Sequence[str] | None = None, target_mb: float = 128.0
) -> DataFrame:
    """Compact a table into files of about ``target_mb``; content and layout are unchanged.

    Only what has more files than it needs is rewritten: of a partitioned table those partitions, in one commit (the
    others' files are not read or written), another table as a whole, or not at all. With ``zorder_by`` all rows are
    clustered anew by these columns, and file sizes follow the session's advisory partition size."""
    cols = _zorder_columns(zorder_by)
    df = spark.table(table)
    if cols:
        replace_table(clustered(df, cols), table, tag="opt")
        return spark.table(table)
    parts = table_layout(spark, table)["partition_by"]
    wasteful = stored(partition_files(spark, table, int(target_mb * 1024 * 1024)).where("files > bins"), "compact")
    if wasteful.isEmpty():
        return df
    if not parts:
        replace_table(df.repartition(wasteful.first()["bins"]), table, tag="opt")
        return spark.table(table)
    rows = join_keys(_near_partitions(df, wasteful, parts), wasteful.select(*parts, F.col("bins").alias("_lw_bins")), parts)
    dealt = rows.withColumn("_lw_bin", F.floor(F.rand(0) * F.col("_lw_bins"))).repartition(*parts, "_lw_bin")
    _replace_partitions(spark, table, dealt.select(*df.columns))
    return spark.table(table)


def _near_partitions(df: DataFrame, touched: DataFrame, parts: Sequence[str]) -> DataFrame:
    """``df`` pruned to partitions that share their first value with a touched one (a filter on catalog metadata: as many
    values as partitions at most); a join with ``touched`` decides."""
    values = [r[0] for r in touched.select(parts[0]).distinct().collect()]
    lead = F.col(TY.quote(parts[0]))
    near = lead.isin([v for v in values if v is not None])
    return df.where(near | lead.isNull() if None in values else near)


def _replace_partitions(spark: SparkSession, table: str, rows: DataFrame) -> DataFrame:
    """Replace the partitions that ``rows`` fall into by them, in one commit; returns the stored rows. They are stored
    first, as they may come from the table itself."""
    schema = spark.table(table).schema
    path = scratch_path(spark, "partitions")
    rows.write.parquet(path)
    # the mode is a setting of the session, which other writes must not see: a session of its own
    own = spark.newSession()
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    for conf in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        own.conf.set(conf, str(1 << 30))  # a stored file each: as they are dealt, so they are written
    own.read.schema(schema).parquet(path).write.mode("overwrite").insertInto(table)
    spark.catalog.refreshTable(table)
    return spark.read.schema(schema).parquet(path)


# ------------------------------------------------------------------------------ B1, B6, B16


def save_files(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    *,
    single_file: bool = False,
    mode: str = "overwrite",
    compression: str = "snappy",
    allow_empty: bool = False,
    partition_by: Sequence[str] | None = None,
    max_records_per_file: int | None = None,
) -> str:
    """B1: write Parquet (snappy) / CSV (with header) / JSON; unknown format, missing path and an
    empty frame are refused. A duplicated extension on the path is stripped."""
    fmt = fmt.lower()
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}")
    if not path:
        raise ValueError("a target path is required")
    for ext in (".parquet", ".csv", ".json"):
        while path.endswith(ext + ext):
            path = path[: -len(ext)]
    if not allow_empty and df.isEmpty():
        raise ValueError("refusing to write an empty frame")
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode)
    if partition_by:
        if fmt != "parquet":
            raise ValueError("partition_by is only supported for Parquet")
        w = w.partitionBy(*partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    if fmt == "parquet":
        w.option("compression", compression).parquet(path)
    elif fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.json(path)
    return path


def delete_files(spark: SparkSession, paths: Sequence[str], recursive: bool = True) -> int:
    """Delete files/directories; a missing one only logs a warning. Returns deletions."""
    n = 0
    for p in paths:
        if remove_path(spark, p, recursive):
            n += 1
        else:
            log.warning("nothing to delete at %s", p)
    return n


def _query_frame(spark: SparkSession, query: str, **params) -> DataFrame:
    """SELECT/WITH/``(`` text, a bare table name, a ``.sql`` path or several statements (all but
    the last run first)."""
    text = resolve_query(query, **params)
    stmts = split_statements(text)
    if len(stmts) == 1 and " " not in stmts[0].strip() and not stmts[0].strip().startswith("("):
        return spark.table(stmts[0].strip())
    for s in stmts[:-1]:
        spark.sql(spark_dialect(s))
    last = stmts[-1]
    if not returns_rows(last):
        raise ValueError("the last statement of an export must return rows")
    return spark.sql(last)


def mean_row_bytes(df: DataFrame, fmt: str) -> float:
    """Mean bytes a row takes in ``fmt``, over all rows of a stored frame: what its Parquet files hold, or the
    length of the text written for the text formats."""
    if fmt == "parquet":
        files = df.groupBy("_metadata.file_path").agg(F.max("_metadata.file_size").alias("b"), F.count(F.lit(1)).alias("n"))
        row = files.agg((F.sum("b") / F.sum("n")).alias("mean")).first()
    else:
        text = F.to_json if fmt == "json" else F.to_csv
        row = df.agg(F.avg(F.octet_length(text(F.struct(*[F.col(TY.quote(c)) for c in df.columns]))) + 1).alias("mean")).first()
    return float(row["mean"] or 1.0)


def export_query(
    spark: SparkSession,
    query: str,
    path: str,
    *,
    file_prefix: str | None = None,
    fmt: str = "parquet",
    parallel: bool = True,
    overwrite: bool = True,
    drop_existing_files: bool = False,
    max_file_size_mb: float | None = None,
    partition_by: Sequence[str] | None = None,
    **params,
) -> str:
    """Run a query and write its result as files. ``file_prefix`` gets its own directory so
    replacing it never touches siblings sharing the prefix; ``parallel=False`` writes one file."""
    df = _query_frame(spark, query, **params)
    target = normalize_path(path.rstrip("/") + (f"/{file_prefix}" if file_prefix else ""))
    if drop_existing_files:
        delete_files(spark, [target])
    per_file = None
    if max_file_size_mb:
        df = stored(df, "export")  # the query runs once, and its rows can be measured
        per_file = max(1, int(max_file_size_mb * 1024 * 1024 / mean_row_bytes(df, fmt.lower())))
    return save_files(
        df,
        target,
        fmt,
        single_file=not parallel,
        mode="overwrite" if overwrite else "errorifexists",
        allow_empty=True,
        partition_by=partition_by,
        max_records_per_file=per_file,
    )


# ------------------------------------------------------------------------------ B15 identity


def with_identity(
    df: DataFrame, name: str = "id", order_by: str | None = None, start: int = 0, first: bool = True
) -> DataFrame:
    """Dense ids ``start + 1, start + 2, ...`` as a BIGINT column (first by default).

    With ``order_by`` (a unique numeric/date column) ids follow that order via bucketed running
    totals; without it, ids follow the scan order from per-partition counts and prefix offsets
    (a table of one row per partition) of the rows, which are stored once. A name already present (any case) is left alone.
    """
    if name.lower() in (c.lower() for c in df.columns):
        log.warning("identity column %s already exists; skipped", name)
        return df
    if order_by is not None:
        run = running_totals(df.withColumn("_lw_one", F.lit(1).cast("long")), [], order_by, ["_lw_one"])
        ided = run.withColumn(name, (F.col("cum__lw_one") + F.lit(start)).cast("long")).drop("_lw_one", "cum__lw_one")
    else:
        # stored once: counts and rows must come from one evaluation, as a second one may be dealt otherwise
        place = {"_lw_p": F.spark_partition_id(), "_lw_m": F.monotonically_increasing_id()}
        tagged = stored(df.withColumns(place), "identity")
        counts = tagged.groupBy("_lw_p").agg(F.count(F.lit(1)).alias("_lw_c"), F.min("_lw_m").alias("_lw_m0"))
        w = Window.orderBy("_lw_p").rowsBetween(Window.unboundedPreceding, -1)
        offs = counts.select(
            F.col("_lw_p").alias("_lw_q"), "_lw_m0", F.coalesce(F.sum("_lw_c").over(w), F.lit(0)).alias("_lw_off")
        )
        ided = tagged.join(stored(offs, "identity-offsets"), F.col("_lw_p") == F.col("_lw_q")).withColumn(
            name, (F.col("_lw_off") + F.col("_lw_m") - F.col("_lw_m0") + F.lit(start + 1)).cast("long")
        )
    cols = [name, *df.columns] if first else [*df.columns, name]
    return ided.select(*[TY.quote(c) for c in cols])


def next_identity_start(spark: SparkSession, table: str, name: str) -> int:
    """Largest identity value in a table (0 when empty or missing): appends continue after it."""
    if not table_exists(spark, table):
        return 0
    v = spark.table(table).agg(F.max(name)).first()[0]
    return int(v or 0)


# ------------------------------------------------------------------------------ B7, B8, B13


def create_table_like(
    spark: SparkSession,
    table: str,
    columns: Sequence[tuple[str, str]],
    identity: str | None = None,
    reserved: Sequence[str] = (),
) -> None:
    """CREATE TABLE from declared columns (identity column first, BIGINT); C7: names in ``reserved`` raise."""
    cols = list(columns)
    TY.check_reserved([c for c, _ in cols], reserved)
    if identity and identity.lower() not in (c.lower() for c, _ in cols):
        cols = [(identity, "BIGINT"), *cols]
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({TY.ddl_of(cols)}) USING parquet")


def truncate_table(spark: SparkSession, table: str) -> None:
    """B13."""
    spark.sql(f"TRUNCATE TABLE {table}")


def load_files_to_table(
    spark: SparkSession,
    table: str,
    path: str,
    fmt: str = "parquet",
    *,
    column_types: Mapping[str, str] | None = None,
    truncate_before_load: bool = False,
    drop_existing_table: bool = False,
    column_list: Sequence[str] | None = None,
    identity: str | None = None,
    identity_order_by: str | None = None,
    csv_options: Mapping | None = None,
    reserved: Sequence[str] = (),
) -> DataFrame:
    """Load files into a table, creating it from the Parquet schema or declared types when
    missing (non-Parquet input needs declared types). An identity column is never loaded from
    files; it continues from the table's current maximum. ``truncate_before_load`` and
    ``drop_existing_table`` replace the table in a staged swap: whatever fails, the old one is still there."""
    from lakeworks.sources.files import load_csv, load_files, read_parquet

    fmt = fmt.lower()
    if fmt == "csv":
        if not column_types:
            raise ValueError("CSV loads need declared column types")
        df = load_csv(spark, path, column_types, **(csv_options or {}))
    elif fmt == "parquet":
        df = read_parquet(spark, path)
    else:
        df = load_files(spark, path, fmt)
    if column_types:
        df = TY.cast_declared(df, column_types)
    if column_list:
        df = df.select(*[TY.quote(c) for c in column_list])
    TY.check_reserved(df.columns, reserved)
    exists = table_exists(spark, table)
    into = table
    if drop_existing_table or not exists:
        if column_types:
            cols = [(c, column_types.get(c, TY.declared_type_of(df.schema[c].dataType) or TY.DEFAULT_VARCHAR)) for c in df.columns]
        elif fmt == "parquet":
            cols = TY.schema_to_columns(first_parquet_schema(spark, path) if not path.endswith(".parquet") else df.schema)
            cols = [(c, t) for c, t in cols if c in df.columns]
        else:
            raise ValueError("a non-Parquet load cannot create the table without declared types")
        into = _sibling(table, "load")  # a new table too is built aside: a failed load leaves none
        create_table_like(spark, into, cols, identity)
    # a value that does not fit raises, but for declared loads, whose types say what to make of it
    strict = not column_types
    try:
        target = spark.table(into).schema
        if identity:
            fresh = truncate_before_load or into != table
            start = 0 if fresh else next_identity_start(spark, table, identity)
            aligned = TY.align_to(df, target, exclude=[identity], strict=strict)
            df = with_identity(aligned, identity, order_by=identity_order_by, start=start)
        rows = TY.align_to(df, target, strict=strict)
        if truncate_before_load and into == table and exists:
            replace_table(rows, table, tag="load")
        else:
            rows.write.mode("append").insertInto(into)
            if into != table:
                swap_in(spark, into, table)
    except Exception:
        if into != table:
            drop_table(spark, into)
        raise
    return spark.table(table)


def create_table_from_frame(
    df: DataFrame,
    table: str,
    *,
    column_types: Mapping[str, str] | None = None,
    identity: str | None = None,
    mode: str = "append",
    decimal_as: str = "double",
    reserved: Sequence[str] = (),
) -> DataFrame:
    """Type all-null columns, match an existing table (its types win; missing columns added
    as NULL, extras dropped), DECIMAL -> DOUBLE, then write. Creates the table when missing."""
    spark = df.sparkSession
    TY.check_reserved(df.columns, reserved)
    out = TY.type_null_columns(df, column_types)
    if column_types:
        out = TY.cast_declared(out, column_types, decimal_as)
    if decimal_as == "double":
        out = TY.decimals_to_double(out)
    if table_exists(spark, table) and mode == "append":
        target = spark.table(table).schema
        if identity:
            start = next_identity_start(spark, table, identity)
            out = with_identity(TY.align_to(out, target, exclude=[identity], strict=not column_types), identity, start=start)
        TY.align_to(out, target, strict=not column_types).write.mode("append").insertInto(table)
        return spark.table(table)
    if identity:
        out = with_identity(out, identity)
    return save_table(out, table, mode="overwrite")


# ------------------------------------------------------------------------------ B9-B11


def external_table(
    spark: SparkSession,
    table: str,
    location: str,
    partitions: Sequence[tuple[str, str]] = (),
    *,
    column_types: Mapping[str, str] | None = None,
    force: bool = False,
    sync_partitions: bool = True,
    return_query: bool = False,
):
    """External Parquet table over files with declared partition columns; an existing table
    is kept unless ``force``; no files -> error; partitions synced on creation by default."""
    if not has_files(spark, location, glob="*.parquet"):
        raise FileNotFoundError(f"no Parquet files under {location}")
    schema = first_parquet_schema(spark, location)
    part_names = [p for p, _ in partitions]
    # the files' own types (a DECIMAL stays one), unless declared otherwise
    declared = {k.lower(): v for k, v in (column_types or {}).items()}
    skip = {p.lower() for p in part_names}
    own = [f for f in schema.fields if f.name.lower() not in skip]
    cols = [
        f"{TY.quote(f.name)} {(TY.spark_type(declared[f.name.lower()]) if f.name.lower() in declared else f.dataType).simpleString()}"
        for f in own
    ]
    cols += [TY.ddl_of([p]) for p in partitions]
    exists = table_exists(spark, table)
    into = _sibling(table, "ext") if exists and force and not return_query else table
    ddl = f"CREATE TABLE {into} ({', '.join(cols)}) USING parquet"
    if partitions:
        ddl += f" PARTITIONED BY ({', '.join(TY.quote(p) for p in part_names)})"
    ddl += f" LOCATION '{_text(location)}'"
    if return_query:
        return ddl
    if exists and not force:
        return spark.table(table)
    try:
        spark.sql(ddl)
        if partitions and sync_partitions:
            failed = sync_partitions_from_files(spark, into, location, part_names)["failed"]
            if failed:
                raise RuntimeError(f"{len(failed)} partitions of {table} could not be added: {failed[:3]}")
    except Exception:
        drop_table(spark, into)  # its files stay, as those of any external table
        raise
    if into != table:  # the new table is whole: it takes the name
        drop_table(spark, table)
        spark.sql(f"ALTER TABLE {into} RENAME TO {table}")
    return spark.table(table)


def _partition_spec(values: Mapping[str, str]) -> str:
    return ", ".join(f"{TY.quote(k)} = '{_text(v)}'" for k, v in values.items())


def add_partition(spark: SparkSession, table: str, values: Mapping[str, str], location: str) -> None:
    """Register one partition; its directory must hold files."""
    if not has_files(spark, location):
        raise FileNotFoundError(f"partition directory {location} holds no files")
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({_partition_spec(values)}) LOCATION '{_text(location)}'")


def sync_partitions_from_files(
    spark: SparkSession, table: str, location: str, partition_columns: Sequence[str], batch: int = 100
) -> dict:
    """Add every discovered partition whose keys equal the declared names in order; others
    are skipped. Failures are collected, not fatal. The partition list is catalog metadata."""
    found = list_partition_paths(spark, location, depth=len(partition_columns)).collect()
    added, skipped, failed = 0, 0, []
    specs = []
    for row in found:
        vals = {kv["key"]: kv["value"] for kv in row["partition_values"]}
        keys = [kv["key"] for kv in row["partition_values"]]
        if keys != list(partition_columns):
            skipped += 1
            continue
        specs.append(f"PARTITION ({_partition_spec(vals)}) LOCATION '{_text(row['partition_path'])}'")
    for i in range(0, len(specs), batch):
        chunk = specs[i : i + batch]
        try:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(chunk))
            added += len(chunk)
        except Exception:  # noqa: BLE001 - one bad partition fails its batch: add them one by one
            for spec in chunk:
                try:
                    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec}")
                    added += 1
                except Exception as exc:  # noqa: BLE001
                    failed.append(f"{spec}: {str(exc)[:200]}")
    return {"added": added, "skipped": skipped, "failed": failed}


# ------------------------------------------------------------------------------ B12, B14, B19


def copy_table(spark: SparkSession, source: str, target: str, replace: bool = True) -> DataFrame:
    """Replace the target with the source's rows (staged), or insert into the existing one.
    Both names must be schema-qualified and differ."""
    if "." not in source or "." not in target:
        raise ValueError("source and target need a schema")
    if source.lower() == target.lower():
        raise ValueError("source and target are the same table")
    if not replace and table_exists(spark, target):
        spark.sql(f"INSERT INTO {target} SELECT * FROM {source}")
    elif table_exists(spark, target):
        replace_table(spark.table(source), target, **{k: v or None for k, v in table_layout(spark, source).items()})
    else:
        layout = table_layout(spark, source)
        _write_new(spark.table(source), target, partition_by=layout["partition_by"], provider=layout["provider"])
        if layout["comment"]:
            set_comment(spark, target, layout["comment"])
    return spark.table(target)


def analyze_table(spark: SparkSession, table: str) -> DataFrame:
    """Refresh column statistics (the cost-based optimizer reads them)."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR ALL COLUMNS")
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}")


def column_stats(spark: SparkSession, table: str, column: str) -> dict:
    """Catalog statistics of one column (after ``analyze_table``): min, max, num_nulls, ..."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {TY.quote(column)}").collect()
    return {r["info_name"]: r["info_value"] for r in rows}


def table_row_count(spark: SparkSession, table: str) -> int | None:
    """Row count recorded in the catalog statistics (None before ``analyze_table``)."""
    import re

    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Statistics").collect()
    m = re.search(r"(\d+) rows", rows[0]["data_type"]) if rows else None
    return int(m.group(1)) if m else None


def upsert(target_df: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """B19 as a frame: source rows plus the target rows whose keys the source does not have."""
    keys = list(keys)
    kept = target_df.join(source.select(*keys).distinct(), keys, "left_anti")
    return source.unionByName(TY.align_to(kept, source.schema).select(*source.columns))


def upsert_table(spark: SparkSession, table: str, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """MERGE-like upsert into a Parquet table. A partitioned table has its touched partitions replaced, and the files of
    the others are not read or written; another one is rewritten via the staged swap, which keeps its layout. Like MERGE
    it refuses a source that holds a key twice; a NULL key matches no row."""
    source = stored(source, "upsert-source")  # evaluated once, though it is read for its keys and its rows
    twice = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_lw_n")).where("_lw_n > 1")
    if not twice.isEmpty():
        raise ValueError(f"the source of the upsert holds a key of {list(keys)} more than once")
    if not table_exists(spark, table):
        return save_table(source, table)
    target = spark.table(table)
    source = TY.align_to(source, target.schema, strict=True)
    parts = table_layout(spark, table)["partition_by"]
    if parts:
        return _upsert_partitions(spark, table, target, source, list(keys), parts)
    return save_table(upsert(target, source, keys), table, mode="overwrite")


def touched_partitions(target: DataFrame, source: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """The partitions that an upsert changes: those of the source's rows, and those that hold a key of the source now (none
    other where the partition columns belong to the key)."""
    mine = source.select(*parts)
    if not {p.lower() for p in parts} <= {k.lower() for k in keys}:
        mine = mine.unionByName(target.select(*{k: None for k in [*keys, *parts]}).join(source.select(*keys), list(keys), "left_semi").select(*parts))
    return mine.distinct()


def _upsert_partitions(
    spark: SparkSession, table: str, target: DataFrame, source: DataFrame, keys: list[str], parts: list[str]
) -> DataFrame:
    """Rewrite the touched partitions only. Their new rows are stored first; then they replace these partitions' files in
    one commit (dynamic partition overwrite), and partitions left without rows go."""
    touched = stored(touched_partitions(target, source, keys, parts), "upsert-partitions")
    old = join_keys(_near_partitions(target, touched, parts), touched, parts, "left_semi")
    merged = _replace_partitions(spark, table, upsert(old, source, keys).select(*target.columns))
    left = merged.select(*parts).distinct()
    for row in join_keys(touched, left, parts, "left_anti").collect():  # at most the touched partitions
        spec = ", ".join(f"{TY.quote(p)} = " + ("NULL" if row[p] is None else f"'{_text(row[p])}'") for p in parts)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(table)
    return spark.table(table)


# ------------------------------------------------------------------------------ B17, B18


def write_cells(cells: DataFrame, table: str, mode: str = "overwrite") -> DataFrame:
    """B18 on tables: overwrite / append / clear a sheet-shaped (all-text) table."""
    spark = cells.sparkSession
    if mode == "clear":
        if table_exists(spark, table):
            truncate_table(spark, table)
        return spark.table(table)
    return save_table(cells, table, mode=mode)
